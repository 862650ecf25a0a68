"""Queries of joins, summaries, lifecycle and reviews over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import evaluate, joins, lifecycle, reports, rules
from ..sources.tables import observations, table
from .registry import registry

QUERIES, ORACLE_SQL, query = registry()


def r(col, n=4):
    return F.round(col, n)


# --- columns ----------------------------------------------------------------


@query("""SELECT o_orderkey, coalesce(dayofyear(CASE WHEN o_orderkey % 7 > 0 THEN o_orderdate END), 0)::INT AS doy, 'r' || lpad((o_orderkey // 1600)::VARCHAR, 3, '0') || 'c' || lpad((o_orderkey % 100 // 16)::VARCHAR, 3, '0') AS chunk, o_orderstatus || '__' || substr(o_orderpriority, 1, 1) AS task,
1000 + (o_orderkey % 100 + 0.5) * 10 AS x, 9000 - (o_orderkey // 100 + 0.5) * 10 AS y, strftime(o_orderdate, '%Y-%m') || ' w' || least((day(o_orderdate) - 1) // 7 + 1, 4) || ' (' || lpad(((least((day(o_orderdate) - 1) // 7 + 1, 4) - 1) * 7 + 1)::VARCHAR, 2, '0') || '-' || lpad((CASE WHEN day(o_orderdate) > 21 THEN day(last_day(o_orderdate)) ELSE ((day(o_orderdate) - 1) // 7 + 1) * 7 END)::VARCHAR, 2, '0') || ')' AS week,
'RO' || lpad((o_custkey % 175)::VARCHAR, 3, '0') || CASE WHEN o_orderkey % 2 = 0 THEN '_ASC' ELSE '_DSC' END AS track, (o_orderkey & 5) <> 0 AS bits, floor(o_totalprice / 1e5)::BIGINT || '_' || floor(o_custkey / 10)::BIGINT AS cell, (o_orderkey // 100 * 100 + o_orderkey % 100)::BIGINT AS pid FROM orders""")
def derived_names(spark, d):
    """Names, places and dates derived for every order."""
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    row, col = F.floor(key / 100), key % 100
    return o.select(
        "o_orderkey", c.day_of_year(F.when(key % 7 > 0, F.col("o_orderdate"))).alias("doy"), c.chunk_name(F.floor(row / 16), F.floor(col / 16)).alias("chunk"), c.task_key(F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)).alias("task"),
        c.pixel_x(col, 1000, 10).alias("x"), c.pixel_y(row, 9000, 10).alias("y"), c.month_week(F.to_date("o_orderdate")).alias("week"), c.track_name(F.col("o_custkey") % 175, key % 2 == 0).alias("track"),
        c.bits_set(key, 5).alias("bits"), c.cell_of(F.col("o_totalprice"), F.col("o_custkey") * 10000.0, 1e5).alias("cell"), c.pixel_id(row, col, 100).alias("pid"),
    )


@query("""WITH g AS (SELECT p_partkey AS k, 25.0 + p_size / 5.0 AS th, p_partkey % 23 - 10.0 AS sl, p_partkey % 360 * 1.0 AS asp, p_partkey % 9 - 4.0 AS dx, p_partkey % 7 - 3.0 AS dy FROM part)
SELECT k, round(degrees(atan(tan(radians(sl)) * cos(radians(asp - 100)))), 6) AS toward, round(tan(radians(th - sl)) / tan(radians(th)), 6) AS volume, round(cos(radians(5)) * sin(radians(th - sl)) / sin(radians(th)), 6) AS direct, (sl < th AND sl > th - 90) AS ok,
round(CASE WHEN degrees(atan2(-dx, -dy)) < 0 THEN degrees(atan2(-dx, -dy)) + 360 ELSE degrees(atan2(-dx, -dy)) END, 6) AS azimuth, least(60.0, 2.0 ** (k % 8)) AS wait, greatest(floor(k * 0.8) - 30, 0)::BIGINT AS free FROM g""")
def terrain_factors(spark, d):
    g = table(spark, d, "part").select(F.col("p_partkey").alias("k"), (25.0 + F.col("p_size") / 5.0).alias("th"), (F.col("p_partkey") % 23 - 10.0).alias("sl"), (F.col("p_partkey") % 360 * 1.0).alias("asp"), (F.col("p_partkey") % 9 - 4.0).alias("dx"), (F.col("p_partkey") % 7 - 3.0).alias("dy"))
    th, sl = F.col("th"), F.col("sl")
    return g.select("k", r(c.slope_toward(sl, F.col("asp"), F.lit(100.0)), 6).alias("toward"), r(c.volume_factor(th, sl), 6).alias("volume"), r(c.direct_factor(th, sl, F.lit(5.0)), 6).alias("direct"), c.geometry_ok(th, sl).alias("ok"), r(c.steepest_fall(F.col("dx"), F.col("dy")), 6).alias("azimuth"), c.backoff(F.col("k") % 8).alias("wait"), c.headroom(F.col("k"), F.lit(30), 0.8).cast("long").alias("free"))


@query("""SELECT count(*) AS n, count(*) FILTER (l_discount > 0 AND isfinite(ln(l_discount)) AND l_tax > 0) AS kept FROM lineitem""")
def finite_rows(spark, d):
    """Rows whose features are all finite."""
    x = table(spark, d, "lineitem").withColumns({"a": F.log("l_discount"), "b": F.log("l_tax")})
    return x.agg(F.count("*").alias("n"), F.count(F.when(c.finite(F.col("a"), F.col("b")), 1)).alias("kept"))


# --- joins ------------------------------------------------------------------

GRID = "g AS (SELECT (o_orderkey // 100)::INT AS \"row\", (o_orderkey % 100)::INT AS col, o_totalprice AS v FROM orders)"


def _grid(spark, d):
    return table(spark, d, "orders").select(F.floor(F.col("o_orderkey") / 100).cast("int").alias("row"), (F.col("o_orderkey") % 100).cast("int").alias("col"), F.col("o_totalprice").alias("v"))


@query(f"""WITH {GRID}, p AS (SELECT c_custkey AS k, c_custkey % 130 * 1.0 AS x, c_custkey % 17 * 1.0 + 0.25 AS y FROM customer) SELECT k, v FROM p LEFT JOIN g ON "row" = floor(10 - y) AND col = floor(x)""")
def sample_grid(spark, d):
    """The value of the cell that holds each point."""
    p = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 130 * 1.0).alias("x"), (F.col("c_custkey") % 17 * 1.0 + 0.25).alias("y"))
    return joins.sample_grid(p, _grid(spark, d), "x", "y", 0.0, 10.0, 1.0, "v").select("k", "v")


@query("""SELECT c_custkey, coalesce(a.v, b.v) AS v FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) a ON a.o_custkey = c_custkey LEFT JOIN (SELECT o_custkey, min(o_totalprice) AS v FROM orders GROUP BY 1) b ON b.o_custkey = c_custkey""")
def sample_tiles(spark, d):
    """The first source with a value wins."""
    o = table(spark, d, "orders")
    tile = lambda x, f: x.groupBy(F.col("o_custkey").alias("c_custkey")).agg(f("o_totalprice").alias("v"))
    return joins.sample_tiles(table(spark, d, "customer").select("c_custkey"), [tile(o.where("o_orderstatus = 'P'"), F.max), tile(o, F.min)], ["c_custkey"], "v")


@query(f"WITH {GRID}, s AS (SELECT a::INT AS \"row\", b::INT AS col FROM (SELECT unnest(range(0, 20)) AS a), (SELECT unnest(range(0, 110)) AS b)) SELECT s.\"row\", s.col, coalesce(g.v > 150000, NULL)::INT AS raw, coalesce((g.v > 150000)::INT, 255) AS v FROM s LEFT JOIN g USING (\"row\", col)")
def scattered_classes(spark, d):
    """A class grid whose cells without a row hold the missing code."""
    s = spark.range(20).select(F.col("id").cast("int").alias("row")).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(109))))
    values = _grid(spark, d).withColumn("v", (F.col("v") > 150000).cast("int"))
    return joins.scatter(s, values, ["row", "col"], "v", 255).withColumn("raw", F.nullif("v", F.lit(255)))


@query("SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS gcp_id FROM customer")
def stable_ids(spark, d):
    """Numbers in a definite order, without one ordering task."""
    return joins.row_ids(table(spark, d, "customer"), ["c_acctbal", "c_custkey"], "gcp_id", 4).select("c_custkey", "c_name", "gcp_id")


RECTS = """a AS (SELECT s_suppkey AS chunk, s_suppkey % 37 * 10.0 AS xmin, s_suppkey % 11 * 10.0 AS ymin, s_suppkey % 37 * 10.0 + 10 AS xmax, s_suppkey % 11 * 10.0 + 10 AS ymax FROM supplier),
b AS (SELECT p_partkey AS print, p_partkey % 29 * 12.0 AS xmin, p_partkey % 13 * 7.0 AS ymin, p_partkey % 29 * 12.0 + 5 + p_size AS xmax, p_partkey % 13 * 7.0 + 4 + p_size / 2.0 AS ymax, p_brand AS track FROM part)"""


@query(f"""WITH {RECTS}, m AS (SELECT chunk, track, greatest(0, least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * greatest(0, least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin)) / 100 AS share FROM a, b)
SELECT chunk, track, count(*) AS touch, count(*) FILTER (share >= 0.99) AS whole FROM m WHERE share > 0 GROUP BY ALL""")
def chunk_coverage(spark, d):
    """How many footprints of each track touch a chunk and cover it whole."""
    n = lambda x: F.col(x).cast("double")
    a = table(spark, d, "supplier").select(F.col("s_suppkey").alias("chunk"), (n("s_suppkey") % 37 * 10).alias("xmin"), (n("s_suppkey") % 11 * 10).alias("ymin"))
    a = a.withColumns({"xmax": F.col("xmin") + 10, "ymax": F.col("ymin") + 10})
    b = table(spark, d, "part").select((n("p_partkey") % 29 * 12).alias("xmin"), (n("p_partkey") % 13 * 7).alias("ymin"), "p_size", F.col("p_brand").alias("track"))
    b = b.withColumns({"xmax": F.col("xmin") + 5 + F.col("p_size"), "ymax": F.col("ymin") + 4 + F.col("p_size") / 2.0})
    return joins.coverage_by_box(a, b, "chunk", ["track"], 25.0)


@query("""WITH a AS (SELECT l_suppkey AS f, sum(l_quantity) AS x FROM lineitem WHERE l_linenumber <= 3 AND l_suppkey % 5 <> 0 GROUP BY 1), b AS (SELECT l_suppkey AS f, sum(l_quantity) AS y, count(DISTINCT l_returnflag) AS parts FROM lineitem WHERE l_linenumber <= 3 AND l_suppkey % 7 <> 0 AND (l_suppkey % 3 = 0 OR l_returnflag = 'A') GROUP BY 1)
SELECT coalesce(a.f, b.f) AS field, CASE WHEN x IS NULL THEN 'new' WHEN y IS NULL THEN 'deleted' WHEN parts > 1 THEN 'split' WHEN abs(y - x) >= 20 THEN 'reshaped' ELSE 'kept' END AS fate FROM a FULL JOIN b ON a.f = b.f""")
def layer_fates(spark, d):
    """What became of each shape between two deliveries."""
    x = table(spark, d, "lineitem").where("l_linenumber <= 3").select(F.col("l_suppkey").alias("field"), "l_quantity", "l_returnflag")
    after = x.where("field % 7 <> 0 and (field % 3 = 0 or l_returnflag = 'A')").groupBy("field", "l_returnflag").agg(F.sum("l_quantity").alias("l_quantity"))
    return joins.compare_layers(x.where("field % 5 <> 0"), after, "field", "l_quantity", 20.0).select("field", "fate")


@query("""WITH p AS (SELECT n_nationkey AS k, n_nationkey * 7 % 11 * 1.0 AS x, n_nationkey * 5 % 13 * 1.0 AS y FROM nation), q AS (SELECT a.k, b.k AS place, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6) AS distance FROM p a JOIN p b ON a.k <> b.k)
SELECT k, place, distance, rank FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY distance, place) AS rank FROM q) WHERE rank <= 3""")
def nearest_places(spark, d):
    p = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), (F.col("n_nationkey") * 7 % 11 * 1.0).alias("x"), (F.col("n_nationkey") * 5 % 13 * 1.0).alias("y"))
    return joins.by_distance(p, p, "k", "x", "y", 3).withColumn("rank", F.col("rank").cast("long"))


@query("""WITH f AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), m AS (SELECT o_custkey, avg(l_quantity) AS q FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT c_custkey, coalesce(CASE WHEN c_acctbal < 0 THEN 'reject' END, 'ok') AS status, n, round(q, 4) AS q FROM customer JOIN f ON f.o_custkey = c_custkey LEFT JOIN m ON m.o_custkey = c_custkey""")
def joined_reviews(spark, d):
    """Inner join of what must be there, left joins of what may be missing; an unlisted status is ok."""
    cust, o = table(spark, d, "customer"), table(spark, d, "orders")
    f = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    m = o.join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.avg("l_quantity").alias("q"))
    review = cust.where("c_acctbal < 0").select("c_custkey", F.lit("reject").alias("status"))
    return cust.select("c_custkey").join(f, "c_custkey").join(review, "c_custkey", "left").join(m, "c_custkey", "left").select("c_custkey", F.coalesce("status", F.lit("ok")).alias("status"), "n", r("q").alias("q"))


@query("""{obs}, n AS (SELECT k, day, count(*) AS n, round(100.0 * count(*) FILTER (v > 20) / count(*), 4) AS valid_pct FROM obs GROUP BY ALL), x AS (SELECT *, day - lag(day) OVER (PARTITION BY k ORDER BY day) AS gap FROM n)
SELECT k, day, n, valid_pct, gap, concat_ws(';', CASE WHEN gap > 3 THEN 'gap' END, CASE WHEN valid_pct < 50 THEN 'low' END, CASE WHEN n > 3 THEN 'many' END) AS flags FROM x""")
def dates_table(spark, d):
    """Days of a series with their valid share, the gap before and flags."""
    n = observations(spark, d).groupBy("k", "day").agg(F.count("*").alias("n"), r(100.0 * F.count(F.when(F.col("v") > 20, 1)) / F.count("*")).alias("valid_pct"))
    x = n.withColumn("gap", F.col("day") - F.lag("day").over(W.partitionBy("k").orderBy("day")))
    return x.withColumn("flags", F.concat_ws(";", F.when(F.col("gap") > 3, "gap"), F.when(F.col("valid_pct") < 50, "low"), F.when(F.col("n") > 3, "many")))


# --- summaries --------------------------------------------------------------


@query("{obs} SELECT k, track, min(v) AS low, max(v) AS high, round(avg(v), 6) AS mean, round(max(v) - min(v), 6) AS span, round(stddev_pop(v), 6) AS std, round(var_pop(v) + 1e-9, 4) AS var FROM obs GROUP BY ALL")
def series_profile(spark, d):
    x = reports.series_profile(observations(spark, d), ["k", "track"], "v")
    return x.withColumns({"mean": r("mean", 6), "span": r("span", 6), "std": r("std", 6), "var": r(F.col("var") + 1e-9)})


@query("SELECT c_nationkey AS field, date_trunc('month', o_orderdate)::DATE AS month, round(avg(o_totalprice) + 1e-9, 4) AS mean, count(o_totalprice) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'P' GROUP BY ALL")
def field_means(spark, d):
    """Mean over each field's cells at each time, under a mask."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("cell"), F.trunc("o_orderdate", "month").alias("month"), "o_totalprice", "o_orderstatus")
    bridge = table(spark, d, "customer").select(F.col("c_custkey").alias("cell"), F.col("c_nationkey").alias("field"))
    return reports.field_means(o, bridge, "cell", "field", "month", "o_totalprice", F.col("o_orderstatus") != "P").withColumn("mean", r(F.col("mean") + 1e-9))


@query("""{obs}, x AS (SELECT k % 5 AS field, day, v, v > 12 AS ok FROM obs) SELECT field, day, round(quantile_cont(v, 0.5) FILTER (ok), 6) AS median, round(avg(ok::INT), 6) AS clear FROM x GROUP BY ALL HAVING avg(ok::INT) >= 0.5""")
def field_curves(spark, d):
    """Median of each field's clear cells; a day counts where half of them are clear."""
    obs = observations(spark, d)
    bridge = obs.select("k").distinct().withColumn("field", F.col("k") % 5)
    x = reports.field_curve(obs, bridge, "k", "field", "day", "v", F.col("v") > 12)
    return x.select("field", "day", r("median", 6).alias("median"), r("clear", 6).alias("clear"))


@query("""SELECT l_returnflag, CASE WHEN l_discount > 0.08 THEN 'water_now' WHEN l_quantity < 10 THEN 'never_canopy' WHEN l_tax > 0.06 THEN 'evergreen' ELSE 'other' END AS part, count(*) AS n FROM lineitem GROUP BY ALL""")
def parts_of_class(spark, d):
    parts = [("water_now", F.col("l_discount") > 0.08), ("never_canopy", F.col("l_quantity") < 10), ("evergreen", F.col("l_tax") > 0.06)]
    return reports.parts_of(table(spark, d, "lineitem"), ["l_returnflag"], parts)


@query("SELECT l_returnflag, count(*) AS n, round(avg((l_discount > 0.05)::INT), 6) AS deep, round(avg((l_quantity > 25)::INT), 6) AS lasting, round(avg((l_tax < 0.02)::INT), 6) AS canopy FROM lineitem GROUP BY 1")
def diagnosis_shares(spark, d):
    x = reports.shares_of(table(spark, d, "lineitem"), "l_returnflag", {"deep": F.col("l_discount") > 0.05, "lasting": F.col("l_quantity") > 25, "canopy": F.col("l_tax") < 0.02})
    return x.withColumns({n: r(n, 6) for n in ("deep", "lasting", "canopy")})


@query("SELECT o_orderstatus, date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS platforms, count(DISTINCT o_orderdate::DATE) AS days FROM orders GROUP BY ALL")
def availability(spark, d):
    return reports.availability(table(spark, d, "orders"), ["o_orderstatus"], "o_orderdate", "o_orderpriority")


@query("WITH x AS (SELECT l_extendedprice / l_quantity / 5000 AS r FROM lineitem WHERE l_quantity > 0), m AS (SELECT quantile_cont(r, 0.5) AS ratio FROM x) SELECT round(ratio, 6) AS ratio, round(max(100 * abs(r / ratio - 1)), 4) AS worst_pct, round(avg(100 * abs(r / ratio - 1)), 4) AS mean_pct, CASE WHEN abs(ratio - 1) < 0.2 THEN 'square metres' WHEN abs(ratio / 1e-4 - 1) < 0.2 THEN 'hectares' WHEN abs(ratio * 4046.8564224 - 1) < 0.2 THEN 'acres' ELSE 'unknown' END AS unit FROM x, m GROUP BY ratio")
def area_check(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("a"), (F.col("l_quantity") * 5000).alias("b"))
    return reports.area_check(x, "a", "b").select(r("ratio", 6).alias("ratio"), r("worst_pct").alias("worst_pct"), r("mean_pct").alias("mean_pct"), "unit")


@query("{obs} SELECT k, track, CASE WHEN count(v) >= 5 THEN round(quantile_cont(v, 0.5), 6) END AS median, count(v) AS n FROM obs GROUP BY ALL")
def median_if_enough(spark, d):
    return reports.least_count(observations(spark, d), ["k", "track"], "v", 5).withColumn("median", r("median", 6))


@query("WITH s AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS month, o_orderdate::DATE AS day, max(o_totalprice) AS share FROM orders GROUP BY ALL) SELECT o_custkey, month, arg_max(day, struct_pack(s := share, d := day)) AS day, max(share) AS share FROM s GROUP BY ALL")
def clearest_day(spark, d):
    s = table(spark, d, "orders").groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("month"), F.to_date("o_orderdate").alias("day")).agg(F.max("o_totalprice").alias("share"))
    return reports.best_day(s, ["o_custkey", "month"], "day", "share")


@query("""WITH f AS (SELECT 'n_chars' AS feature, n_chars::DOUBLE AS x, quality = 0 AS f FROM documents JOIN labels USING (doc_id) UNION ALL SELECT 'lines', len(string_split(text, chr(10)))::DOUBLE, quality = 0 FROM documents JOIN labels USING (doc_id)),
k AS (SELECT feature, f, rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / 2 AS rk FROM f), a AS (SELECT feature, sum(rk) FILTER (f) AS s, count(*) FILTER (f) AS np, count(*) FILTER (NOT f) AS nn FROM k GROUP BY 1)
SELECT feature, round((s - np * (np + 1) / 2) / (np * nn), 6) AS auc, (SELECT quantile_cont(x, 0.5) FROM f WHERE f.feature = a.feature AND f) AS median_in, (SELECT quantile_cont(x, 0.5) FROM f WHERE f.feature = a.feature AND NOT f) AS median_out FROM a""")
def separation(spark, d):
    """How well each feature parts the deleted from the kept."""
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").withColumn("lines", F.size(F.split("text", "\n")))
    return reports.separation(x, ["n_chars", "lines"], F.col("quality") == 0, 5).select("feature", r("auc", 6).alias("auc"), "median_in", "median_out")


@query("{obs} SELECT k, min(day) FILTER (v >= 80) AS first FROM obs GROUP BY k")
def earliest_call(spark, d):
    return reports.earliest(observations(spark, d), ["k"], "day", "v", 80.0)


@query("""{obs}, a AS (SELECT track, day, quantile_cont(v, 0.5) AS level FROM obs GROUP BY ALL), j AS (SELECT track, day, level, CASE WHEN lag(level, 2) OVER w IS NOT NULL AND lead(level, 2) OVER w IS NOT NULL THEN level - (lag(level) OVER w + lag(level, 2) OVER w + lead(level) OVER w + lead(level, 2) OVER w) / 4 END AS jump FROM a WINDOW w AS (PARTITION BY track ORDER BY day))
SELECT track, day, round(level, 6) AS level, round(jump, 6) AS jump FROM j WHERE abs(jump) > 6""")
def jumping_passes(spark, d):
    x = reports.jumping_passes(observations(spark, d), ["track"], "day", "v", 6.0)
    return x.select("track", "day", r("level", 6).alias("level"), r("jump", 6).alias("jump"))


@query("{obs} SELECT round(quantile_cont(v, 0.9) FILTER (track = 'view'), 6) AS low, round(quantile_cont(v, 0.1) FILTER (track = 'click'), 6) AS high FROM obs")
def reference_thresholds(spark, d):
    x = reports.reference_thresholds(observations(spark, d), "track", {"low": ("view", "v", 0.9), "high": ("click", "v", 0.1)})
    return x.select(r("low", 6).alias("low"), r("high", 6).alias("high"))


@query("{obs}, l AS (SELECT k, min(v) FILTER (k % 4 > 0) AS low, avg(v) / 12 AS split FROM obs GROUP BY k) SELECT k, CASE WHEN low IS NULL THEN 1 WHEN low < 0.5 THEN 0 WHEN low > greatest(split, 0.5) THEN 2 ELSE 1 END AS cover FROM l")
def cover_classes(spark, d):
    l = observations(spark, d).groupBy("k").agg(F.min(F.when(F.col("k") % 4 > 0, F.col("v"))).alias("low"), (F.avg("v") / 12).alias("split"))  # noqa: E741
    return l.select("k", reports.cover_codes(F.col("low"), F.col("split"), 0.5).alias("cover"))


_MONTHS = ", ".join(f"CASE WHEN count(db) FILTER (m = {m}) = 0 THEN -32768 ELSE least(greatest(floor(10 * log10(avg(pow(10, db / 10)) FILTER (m = {m})) * 100 + 0.5), -32767), 32767)::INT END AS m{m:02d}" for m in range(1, 13))


@query(f"WITH x AS (SELECT o_custkey, month(o_orderdate) AS m, o_totalprice / 20000 - 15 AS db FROM orders) SELECT o_custkey, {_MONTHS}, floor(min(db) * 100 + 0.5)::INT AS least FROM x GROUP BY 1")
def month_composites(spark, d):
    """Monthly means in power and the least value, packed."""
    x = table(spark, d, "orders").select("o_custkey", "o_orderdate", (F.col("o_totalprice") / 20000 - 15).alias("db"))
    return reports.month_composite(x, ["o_custkey"], "o_orderdate", "db")


@query("""WITH v AS (SELECT vec_id, embedding AS e FROM embeddings), x AS (SELECT vec_id, unnest(range(0, 64)) AS i, e FROM v) SELECT vec_id, i::INT AS i, CASE WHEN i / 1.5 <= 63 THEN round(e[floor(i / 1.5)::INT + 1]::DOUBLE + (e[least(floor(i / 1.5)::INT + 1, 63) + 1]::DOUBLE - e[floor(i / 1.5)::INT + 1]::DOUBLE) * (i / 1.5 - floor(i / 1.5)), 6) END AS z FROM x""")
def stretched_series(spark, d):
    """Each vector read at a slower pace."""
    x = table(spark, d, "embeddings").select("vec_id", F.posexplode(reports.stretched(F.col("embedding").cast("array<double>"), 1.5)).alias("i", "z"))
    return x.withColumn("z", r("z", 6))


@query("""{obs}, w AS (SELECT k, day // 5 AS i, avg(v) AS v FROM obs GROUP BY ALL), m AS (SELECT i, quantile_cont(v, 0.5) AS m FROM w GROUP BY i) SELECT k, round(sqrt(avg((v - m) ** 2)), 6) AS rms, count(*) AS n FROM w JOIN m ON w.i = m.i + 1 GROUP BY k""")
def shifted_rms(spark, d):
    w = observations(spark, d).groupBy("k", F.floor(F.col("day") / 5).alias("i")).agg(F.avg("v").alias("v"))
    centre = w.groupBy("i").agg(reports.median("v").alias("v"))
    return reports.shifted_rms(w, centre, "k", "i", "v", 1).withColumn("rms", r("rms", 6))


SHAPES = """w AS (SELECT k, day // 3 AS i, avg(v) AS v FROM obs GROUP BY ALL), s AS (SELECT k, i - k % 3 AS step, CASE WHEN max(v) OVER p > min(v) OVER p THEN (v - min(v) OVER p) / (max(v) OVER p - min(v) OVER p) END AS share, max(v) OVER p - min(v) OVER p AS amplitude FROM w WHERE i >= k % 3 WINDOW p AS (PARTITION BY k)),
m AS (SELECT step, quantile_cont(share, 0.5) AS middle FROM s GROUP BY 1 HAVING count(share) >= 5), f AS (SELECT step, any_value(middle) AS middle, 1.4826 * quantile_cont(abs(share - middle), 0.5) AS spread FROM s JOIN m USING (step) GROUP BY step)"""


@query("{obs}, " + SHAPES + """, g AS (SELECT k, sqrt(avg(((share - middle) / sqrt(spread ** 2 + CASE WHEN amplitude <> 0 THEN 2 / amplitude END ** 2)) ** 2)) AS gap, max(step) AS age FROM s JOIN f USING (step) GROUP BY k)
SELECT k, round(gap, 4) AS gap, age, CASE WHEN age > 9 THEN 'too old' WHEN age < 7 THEN 'undecided' WHEN gap <= 1.2 THEN 'alike' WHEN gap IS NOT NULL THEN 'unlike' ELSE 'none' END AS verdict FROM g""")
def judged_shapes(spark, d):
    """Each series' own shape against the reference of all."""
    w = observations(spark, d).groupBy("k", F.floor(F.col("day") / 3).alias("i")).agg(F.avg("v").alias("v")).withColumn("start", F.col("k") % 3)
    s = reports.own_shape(w, "k", "i", "v", "start")
    return reports.judge_shapes(s, reports.shape_reference(s, 5), 2.0, 1.2, 7, 9).select("k", r("gap").alias("gap"), "age", "verdict")


# --- lifecycle --------------------------------------------------------------


def _journal(spark, d):
    """Lines of JSON, every thirteenth torn off."""
    e = table(spark, d, "events")
    text = F.concat(F.lit('{"task":"t'), F.col("user_id").cast("string"), F.lit('"'), F.when(F.col("event_type") == "view", F.concat(F.lit(',"state":"S'), (F.col("event_id") % 4).cast("string"), F.lit('"'))).otherwise(F.lit("")), F.when(F.col("event_type") != "click", F.concat(F.lit(',"size":'), (F.col("event_id") % 100).cast("string"))).otherwise(F.lit("")), F.lit("}"))
    return e.withColumn("x", text).select(F.col("event_id").alias("seq"), F.when(F.col("event_id") % 13 == 0, F.expr("left(x, length(x) - 4)")).otherwise(F.col("x")).alias("value"))


JOURNAL = "j AS (SELECT 't' || user_id AS task, event_id AS seq, CASE WHEN event_type = 'view' THEN 'S' || event_id % 4 END AS state, CASE WHEN event_type <> 'click' THEN event_id % 100 END AS size FROM events WHERE event_id % 13 <> 0 UNION ALL SELECT 't' || c_custkey, -1, 'OLD', 7 FROM customer WHERE c_custkey < 20)"


@query(f"WITH {JOURNAL} SELECT task, arg_max(state, seq) FILTER (state IS NOT NULL) AS state, arg_max(size, seq) FILTER (size IS NOT NULL) AS size FROM j GROUP BY task")
def replayed_journal(spark, d):
    """A snapshot and the journal since, whose torn lines are ignored."""
    snapshot = table(spark, d, "customer").where("c_custkey < 20").select(F.concat(F.lit("t"), F.col("c_custkey")).alias("task"), F.lit("OLD").alias("state"), F.lit(7).cast("long").alias("size"))
    return lifecycle.replay(_journal(spark, d), snapshot, "task", {"state": "string", "size": "bigint"})


@query("""WITH t AS (SELECT c_custkey AS k, CASE WHEN c_acctbal < 3000 THEN 'PENDING' ELSE 'RUNNING' END AS state FROM customer), w AS (SELECT o_custkey AS k, o_orderkey AS claimant FROM orders WHERE o_orderpriority < '3'), f AS (SELECT k, min(claimant) AS first FROM w GROUP BY k)
SELECT w.k, claimant, coalesce(state = 'PENDING' AND claimant = first, false) AS granted, CASE WHEN state = 'PENDING' AND claimant = first THEN 'RUNNING' ELSE state END AS state FROM w JOIN f USING (k) LEFT JOIN t ON t.k = w.k""")
def claims(spark, d):
    """Compare and set: one claim a row is granted, and only from the expected state."""
    t = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_acctbal") < 3000, "PENDING").otherwise("RUNNING").alias("state"))
    w = table(spark, d, "orders").where("o_orderpriority < '3'").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("claimant"))
    return lifecycle.claim(t, w, "k", "state", ["PENDING"], "RUNNING")


@query("""SELECT s_suppkey AS track, n_nationkey AS chunk, 'PLANNED' AS state FROM supplier, nation WHERE NOT EXISTS (SELECT 1 FROM supplier x WHERE x.s_suppkey = supplier.s_suppkey AND x.s_nationkey = n_nationkey) AND NOT EXISTS (SELECT 1 FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey WHERE l_suppkey = s_suppkey AND c_nationkey = n_nationkey AND l_linenumber = 7)""")
def planned_exports(spark, d):
    """Every track and chunk that is covered and not yet known."""
    tracks, chunks = table(spark, d, "supplier").select(F.col("s_suppkey").alias("track")), table(spark, d, "nation").select(F.col("n_nationkey").alias("chunk"))
    bare = table(spark, d, "supplier").select(F.col("s_suppkey").alias("track"), F.col("s_nationkey").alias("chunk"))
    l = table(spark, d, "lineitem").where("l_linenumber = 7")  # noqa: E741
    known = l.join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("l_suppkey").alias("track"), F.col("c_nationkey").alias("chunk")).distinct()
    return lifecycle.work_list(tracks, chunks, bare, known, ["track", "chunk"]).withColumn("state", F.lit("PLANNED"))


@query("""WITH t AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 3 THEN o_orderkey - 1 END AS parent, o_orderstatus AS state FROM orders) SELECT CASE WHEN k % 2 = 0 AND state = 'O' THEN 'C' ELSE state END AS state, count(*) AS n FROM t WHERE state <> 'P' AND k NOT IN (SELECT parent FROM t WHERE parent IS NOT NULL) GROUP BY 1""")
def confirmed_scope(spark, d):
    """Rows that count after a transition of a scope; parents that were split don't."""
    t = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 11 == 3, F.col("o_orderkey") - 1).alias("parent"), F.col("o_orderstatus").alias("state"))
    scope = lifecycle.in_scope(t, "state", ["P"], "parent", "k")
    return lifecycle.confirm(scope, F.col("k") % 2 == 0, "state", "O", "C").groupBy("state").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT n_name AS name, 'v1' AS version FROM nation WHERE n_nationkey < 15), b AS (SELECT n_name AS name, 'v2' AS version FROM nation WHERE n_nationkey > 9) SELECT name, coalesce(a.version, b.version) AS version, coalesce(b.version, a.version) AS moved FROM a FULL JOIN b USING (name)""")
def pinned_versions(spark, d):
    """Pinned names stay unless they may be moved."""
    n = table(spark, d, "nation")
    a, b = n.where("n_nationkey < 15").select(F.col("n_name").alias("name"), F.lit("v1").alias("version")), n.where("n_nationkey > 9").select(F.col("n_name").alias("name"), F.lit("v2").alias("version"))
    return lifecycle.pin(a, b, "name", "version").join(lifecycle.pin(a, b, "name", "version", True).withColumnRenamed("version", "moved"), "name")


@query("""WITH s AS (SELECT c_custkey AS k, count(o_orderkey) AS n, max(o_totalprice) AS top, count(*) FILTER (o_orderstatus = 'F') AS f FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) SELECT k, CASE WHEN NOT n > 0 THEN 'export' WHEN NOT coalesce(top > 200000, false) THEN 'stack' WHEN NOT f > 2 THEN 'review' ELSE 'done' END AS stage FROM s""")
def stages(spark, d):
    """The first step that is not finished."""
    s = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy(F.col("c_custkey").alias("k")).agg(F.count("o_orderkey").alias("n"), F.max("o_totalprice").alias("top"), F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("f"))
    return lifecycle.stage_of(s, [("export", F.col("n") > 0), ("stack", F.col("top") > 200000), ("review", F.col("f") > 2)], "done").select("k", "stage")


@query("""SELECT o_orderkey, o_orderdate::DATE IN (SELECT o_orderdate::DATE FROM orders WHERE o_orderstatus = 'F') AS used FROM orders""")
def frozen_inputs(spark, d):
    """Rows of frozen dates, and those that came later."""
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    kept, late = lifecycle.refuse_new_dates(o, o.where("o_orderstatus = 'F'").select("day").distinct(), ["day"])
    return kept.select("o_orderkey", F.lit(True).alias("used")).unionByName(late.select("o_orderkey", F.lit(False).alias("used")))


# --- reviews ----------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN isfinite(a) AND isfinite(b) THEN 'full' WHEN isfinite(b) THEN 'short' END AS model, round(CASE WHEN isfinite(a) AND isfinite(b) THEN a + b WHEN isfinite(b) THEN 2 * b END, 6) AS prediction FROM (SELECT *, CASE WHEN l_discount > 0 THEN ln(l_discount) END AS a, CASE WHEN l_tax > 0 THEN ln(l_tax) END AS b FROM lineitem)""")
def picked_models(spark, d):
    """The first model whose inputs are all known."""
    x = table(spark, d, "lineitem").withColumns({"a": F.log("l_discount"), "b": F.log("l_tax")})
    got = evaluate.first_able(x, [("full", ["a", "b"], F.col("a") + F.col("b")), ("short", ["b"], 2 * F.col("b"))])
    return x.withColumn("p", got).select("l_orderkey", "l_linenumber", "p.model", r("p.prediction", 6).alias("prediction"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_linenumber % 3 AS c, l_extendedprice AS dist, l_returnflag AS m1, CASE WHEN l_discount > 0.03 THEN l_returnflag ELSE 'A' END AS m2 FROM lineitem), q AS (SELECT c, quantile_cont(dist, 0.75) AS q FROM x GROUP BY c),
n AS (SELECT *, CASE c WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' END AS name FROM x JOIN q USING (c)) SELECT l_orderkey, l_linenumber, CASE WHEN dist <= q AND m1 = name AND m2 = name THEN name END AS label FROM n""")
def consensus_labels(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_linenumber") % 3).alias("c"), F.col("l_extendedprice").alias("dist"), F.col("l_returnflag").alias("m1"), F.when(F.col("l_discount") > 0.03, F.col("l_returnflag")).otherwise("A").alias("m2"))
    return evaluate.consensus(x, "c", "dist", ["m1", "m2"], {0: "A", 1: "N", 2: "R"}).select("l_orderkey", "l_linenumber", "label")


@query("""WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS label FROM orders WHERE o_orderkey % 3 <> 0), ch AS (SELECT l_orderkey AS k, arg_max(CASE WHEN l_linestatus = 'O' THEN '' ELSE l_returnflag END, l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey) AS label FROM lineitem WHERE l_linenumber >= 6 GROUP BY 1)
SELECT k, coalesce(ch.label, a.label) AS label FROM a FULL JOIN ch USING (k) WHERE coalesce(ch.label, a.label) <> ''""")
def settled_verdicts(spark, d):
    """Verdicts that users' checks override; an empty one drops the row."""
    a = table(spark, d, "orders").where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("label"))
    ch = table(spark, d, "lineitem").where("l_linenumber >= 6").select(F.col("l_orderkey").alias("k"), F.when(F.col("l_linestatus") == "O", "").otherwise(F.col("l_returnflag")).alias("label"), (F.col("l_linenumber").cast("long") * 1000000000000 + F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("at"))
    return evaluate.settled_verdicts(a, ch, "k", "label", "at")


@query("""WITH j AS (SELECT a.l_returnflag AS x, b.l_returnflag AS y FROM (SELECT l_orderkey, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1) a JOIN (SELECT l_orderkey, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1) b USING (l_orderkey)) SELECT count(*) AS n, round(avg((x = y)::INT), 6) AS exact, round(avg((CASE x WHEN 'R' THEN 'N' ELSE x END = CASE y WHEN 'R' THEN 'N' ELSE y END)::INT), 6) AS merged FROM j""")
def rater_agreement(spark, d):
    one = lambda f: table(spark, d, "lineitem").groupBy("l_orderkey").agg(f("l_returnflag").alias("label"))
    return evaluate.rater_agreement(one(F.max), one(F.min), "l_orderkey", "label", {"R": "N"}).select("n", r("exact", 6).alias("exact"), r("merged", 6).alias("merged"))


@query("""WITH x AS (SELECT l_returnflag, l_suppkey, l_orderkey || '-' || l_linenumber AS key FROM lineitem), a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_suppkey ORDER BY md5('3|' || key), key) AS r FROM x) WHERE r <= 4), b AS (SELECT * FROM (SELECT l_returnflag, l_suppkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY md5('4|' || key), key) AS q FROM a) WHERE q <= 50)
SELECT l_returnflag, l_suppkey, count(*) AS n FROM b GROUP BY ALL""")
def balanced_sample(spark, d):
    """Rows of a class and of a group in it, capped by a seeded draw."""
    x = table(spark, d, "lineitem").withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return evaluate.balanced_sample(x, "l_returnflag", "l_suppkey", "key", 50, 4, 3).groupBy("l_returnflag", "l_suppkey").agg(F.count("*").alias("n"))


@query("""{obs}, k AS (SELECT DISTINCT k FROM obs), dr AS (SELECT k, draw::INT AS draw, (floor(('0x' || substr(md5('5|' || k || '|' || draw), 1, 10))::BIGINT / 1099511627776 * 24) + 3)::INT AS day FROM k, (SELECT unnest(range(1, 4)) AS draw))
SELECT dr.k, draw, dr.day AS "at", round(max(v), 4) AS top FROM dr JOIN obs ON obs.k = dr.k AND abs(obs.day - dr.day) <= 3 GROUP BY ALL""")
def null_dates(spark, d):
    """A statistic at seeded random days: what it is where nothing happened."""
    obs = observations(spark, d)
    draws = evaluate.random_dates(obs.select("k").distinct(), "k", 3, 3, 26, 5)
    near = obs.join(draws.withColumnRenamed("day", "at"), "k").where(F.abs(F.col("day") - F.col("at")) <= 3)
    return near.groupBy("k", "draw", "at").agg(r(F.max("v")).alias("top"))


@query()
def tree_left_out(spark, d):
    """Accuracy of a small tree on languages that it was not trained on."""
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("lang", F.col("quality").cast("double").alias("quality"), F.col("n_chars").cast("double").alias("chars"), F.size(F.split("text", "\n")).cast("double").alias("lines"))
    return evaluate.left_out_accuracy(x, ["chars", "lines"], "quality", "lang", ["de", "en"])


@query()
def cluster_counts(spark, d):
    """Cost and silhouette of k-means for a few k."""
    return evaluate.cluster_scores(table(spark, d, "embeddings"), "embedding", [2, 4]).withColumns({"cost": r("cost", 2), "silhouette": r("silhouette")})


@query("""WITH t AS (SELECT l_returnflag AS teacher, l_linestatus AS predicted, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT teacher, predicted, n, round(n * 100 / 4046.8564224, 6) AS acres, round(n / sum(n) OVER (PARTITION BY teacher), 6) AS share FROM t""")
def teacher_agreement(spark, d):
    from ..operators import aggregate

    x = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("teacher"), F.col("l_linestatus").alias("predicted"))
    return aggregate.transitions(x, "teacher", "predicted").withColumns({"acres": r("acres", 6), "share": r("share", 6)})


@query("""WITH s AS (SELECT c_nationkey AS area, 's' || (c_custkey % 3) AS variant, (c_acctbal > 2000 + 500 * (c_custkey % 3))::INT * 1.0 AS ok, c_custkey % 2 AS h FROM customer), p AS (SELECT area, variant, avg(ok) FILTER (h = 0) AS a, avg(ok) FILTER (h = 1) AS b FROM s GROUP BY ALL)
SELECT area, count(*) AS variants, round(max(a), 6) AS best FROM p GROUP BY area""")
def variant_scores(spark, d):
    """Scores of each area's variants on one half of its rows."""
    s = table(spark, d, "customer").select(F.col("c_nationkey").alias("area"), F.concat(F.lit("s"), F.col("c_custkey") % 3).alias("variant"), (F.col("c_acctbal") > 2000 + 500 * (F.col("c_custkey") % 3)).cast("double").alias("ok"), (F.col("c_custkey") % 2).alias("h"))
    per = s.groupBy("area", "variant").agg(F.avg(F.when(F.col("h") == 0, F.col("ok"))).alias("a"))
    return per.groupBy("area").agg(F.count("*").alias("variants"), r(F.max("a"), 6).alias("best"))


@query("""WITH x AS (SELECT l_returnflag AS cls, l_quantity, l_discount FROM lineitem) SELECT CASE WHEN cls = 'A' AND l_quantity < 10 THEN 'low' WHEN cls = 'R' THEN 'odd' END AS why, count(*) AS n FROM x WHERE (cls = 'A' AND l_quantity < 10) OR cls = 'R' GROUP BY 1 UNION ALL SELECT 'cheap', count(*) FROM x WHERE l_discount > 0.08""")
def suspects(spark, d):
    """Rows in one or more review categories; a row may repeat."""
    x = table(spark, d, "lineitem")
    why = F.array_compact(F.array(F.when((F.col("l_returnflag") == "A") & (F.col("l_quantity") < 10), "low"), F.when(F.col("l_returnflag") == "R", "odd"), F.when(F.col("l_discount") > 0.08, "cheap")))
    return x.select(F.explode(why).alias("why")).groupBy("why").agg(F.count("*").alias("n"))


@query("""{obs}, t AS (SELECT track, k, count(*) AS n, count(*) FILTER (v > 5) * 100.0 / count(*) AS cover FROM obs GROUP BY ALL), g AS (SELECT DISTINCT track, k FROM (SELECT track, k, day, lag(day) OVER (PARTITION BY track, k ORDER BY day) AS p FROM (SELECT DISTINCT track, k, day FROM obs)) WHERE day - p > 8 AND p <= 20 AND day >= 10),
m AS (SELECT *, max(n) OVER (PARTITION BY k) AS best FROM t) SELECT k, track, n, rank FROM (SELECT k, track, n, row_number() OVER (PARTITION BY k ORDER BY n DESC, track) AS rank FROM m ANTI JOIN g USING (track, k) WHERE cover >= 70 AND n * 2 >= best) WHERE rank <= 2""")
def chosen_tracks(spark, d):
    """The two best tracks of a key: covered enough, not too sparse, without a long gap in the season."""
    from ..operators import aggregate, temporal

    obs = observations(spark, d)
    t = obs.groupBy("track", "k").agg(F.count("*").alias("n"), (100.0 * F.count(F.when(F.col("v") > 5, 1)) / F.count("*")).alias("cover"))
    days = obs.select("track", "k", "day").distinct().withColumn("p", F.lag("day").over(temporal.by(["track", "k"], "day")))
    gaps = days.where("day - p > 8 and p <= 20 and day >= 10").select("track", "k").distinct()
    m = t.withColumn("best", F.max("n").over(W.partitionBy("k"))).join(gaps, ["track", "k"], "left_anti").where("cover >= 70 and n * 2 >= best")
    got = aggregate.ranked_choice(m, ["k"], [F.desc("n"), F.col("track")], 2)
    return got.select("k", "track", "n", F.col("rank").cast("long").alias("rank"))
