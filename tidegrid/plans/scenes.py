"""Queries of scans: scenes, windows, tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reports
from ..sources import scans
from ..sources.scratch import scratch_path
from ..sources.tables import table
from .registry import registry

QUERIES, ORACLE_SQL, query = registry()


def r(col, n=4):
    return F.round(col, n)


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey % 37 * 40.0 AS red, l_quantity * 40 AS green, l_suppkey % 30 * 130.0 AS nir, l_partkey % 50 * 30.0 AS swir, l_discount > 0.02 AS ok FROM lineitem)
SELECT l_linenumber AS date, count(*) FILTER (ok) AS clear, round(avg(CASE WHEN nir + red <> 0 THEN (nir - red) / (nir + red) END) FILTER (ok), 6) AS ndvi, round(avg(CASE WHEN nir + green <> 0 THEN (green - nir) / (green + nir) END) FILTER (ok), 6) AS ndwi, round(avg(CASE WHEN nir + swir <> 0 THEN (nir - swir) / (nir + swir) END) FILTER (ok), 6) AS lswi FROM b GROUP BY 1""")
def scene_indices(spark, d):
    """Mean indices of the clear values of each date."""
    x = table(spark, d, "lineitem")
    num = lambda c: c.cast("double")
    b = x.select("l_orderkey", F.col("l_linenumber").alias("date"), num(F.col("l_partkey") % 37 * 40).alias("red"), (F.col("l_quantity") * 40).alias("green"), num(F.col("l_suppkey") % 30 * 130).alias("nir"), num(F.col("l_partkey") % 50 * 30).alias("swir"), "l_discount")
    cube = scans.scene_cube(b, ["l_orderkey"], F.col("l_discount") > 0.02).where("ok")
    return cube.groupBy("date").agg(F.count("*").alias("clear"), *[r(F.avg(c), 6).alias(c) for c in ("ndvi", "ndwi", "lswi")])


@query("SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS win, count(*) AS n_obs, CASE WHEN count(*) >= 2 THEN max(o_totalprice) END AS v FROM orders GROUP BY ALL")
def composite_windows(spark, d):
    """Windows seen too seldom have no value."""
    w = table(spark, d, "orders").groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("win")).agg(F.count("*").alias("n_obs"), F.max("o_totalprice").alias("v"))
    return scans.composite_windows(w, ["v"], 2)


TRACK = """t AS (SELECT o_orderstatus AS track, substr(o_orderpriority, 1, 1)::INT AS date, (o_orderkey // 100)::INT AS "row", (o_orderkey % 100)::INT AS col, o_totalprice / 20000 - 15 AS vh FROM orders), own AS (SELECT * FROM t WHERE track = 'O' AND date <> 3)"""
_BOX = """m AS (SELECT a.date, a."row", a.col, 10 * log10(CASE WHEN count(b.vh) >= 2 THEN avg(pow(10, b.vh / 10)) END) AS vh FROM own a CROSS JOIN (SELECT unnest(range(-2, 3)) AS dr) CROSS JOIN (SELECT unnest(range(-2, 3)) AS dc) LEFT JOIN own b ON b.date = a.date AND b."row" = a."row" + dr AND b.col = a.col + dc GROUP BY ALL)"""


def _passes(spark, d):
    """Passes written by track, as a run leaves them, and the list of bad ones."""
    o = table(spark, d, "orders")
    t = o.select(F.col("o_orderstatus").alias("track"), F.substring("o_orderpriority", 1, 1).cast("int").alias("date"), F.floor(F.col("o_orderkey") / 100).cast("int").alias("row"), (F.col("o_orderkey") % 100).cast("int").alias("col"), (F.col("o_totalprice") / 20000 - 15).alias("vh"))
    path = scratch_path(spark, "passes")
    t.write.partitionBy("track").parquet(path)
    return spark.read.parquet(path), spark.createDataFrame([("O", 3), ("F", 1)], "track string, date int")


@query(f"""WITH {TRACK}, {_BOX} SELECT date, "row", col, round(vh, 4) AS vh FROM m""")
def track_passes(spark, d):
    """One track's box means in power, without bad passes."""
    p, bad = _passes(spark, d)
    return scans.track_passes(p, "O", bad, ["vh"], 5, 0.08).withColumn("vh", r("vh"))


@query(f"""WITH {TRACK}, {_BOX} SELECT date, "row", col, round(vh, 4) AS vh FROM m WHERE "row" BETWEEN 2 AND 9 AND col BETWEEN 10 AND 30 AND ("row" + col) % 3 = 0""")
def track_cells(spark, d):
    """The same for some cells, reading only the box around them."""
    p, bad = _passes(spark, d)
    cells = spark.range(2, 10).select(F.col("id").cast("int").alias("row")).withColumn("col", F.explode(F.sequence(F.lit(10), F.lit(30)))).where("(row + col) % 3 = 0")
    return scans.track_cells(p, cells, "O", bad, ["vh"], 5, 0.08).select("date", "row", "col", r("vh").alias("vh"))


@query("SELECT user_id AS k, count(*) AS n, sum((props->>'$.k')::BIGINT)::BIGINT AS total FROM events GROUP BY 1")
def checked_metadata(spark, d):
    """Records by a schema; broken ones would raise."""
    e = table(spark, d, "events").select(F.to_json(F.struct("user_id", F.get_json_object("props", "$.k").cast("long").alias("k"))).alias("value"))
    got = scans.checked_metadata(e, "user_id long, k long", ["user_id", "k"])
    return got.groupBy(F.col("user_id").alias("k")).agg(F.count("*").alias("n"), F.sum(F.col("k")).alias("total"))


GRID = "g AS (SELECT (o_orderkey // 100)::INT AS \"row\", (o_orderkey % 100)::INT AS col, CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS cls, o_totalprice AS v, o_custkey FROM orders)"


def _grid(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.floor(F.col("o_orderkey") / 100).cast("int").alias("row"), (F.col("o_orderkey") % 100).cast("int").alias("col"), F.when(F.col("o_totalprice") > 150000, 1).otherwise(0).alias("cls"), F.col("o_totalprice").alias("v"), "o_custkey")


@query(f"""WITH {GRID} SELECT a."row", a.col, any_value(a.cls) AS cls, round(avg(b.cls), 6) AS share FROM g a CROSS JOIN (SELECT unnest(range(-4, 5)) AS dr) CROSS JOIN (SELECT unnest(range(-4, 5)) AS dc) JOIN g b ON b."row" = a."row" + dr AND b.col = a.col + dc GROUP BY a."row", a.col""")
def class_context(spark, d):
    """Share of class 1 in the nine by nine cells around each cell."""
    return reports.share_around(_grid(spark, d).select("row", "col", "cls"), "cls", 1, 4).withColumn("share", r("share", 6))


@query(f"""WITH {GRID} SELECT col // 16 AS bx, "row" // 16 AS by, count(*) AS n, min(col) AS xmin, max(col) AS xmax, min("row") AS ymin, max("row") AS ymax FROM g GROUP BY 1, 2""")
def region_blocks(spark, d):
    return reports.region_blocks(_grid(spark, d), "col", "row", 16)


@query(f"""WITH {GRID} SELECT o_custkey, round(avg((v < 60000)::INT), 6) AS share, count(*) AS cells FROM g GROUP BY 1 HAVING avg((v < 60000)::INT) >= 0.3""")
def flagged_ponds(spark, d):
    """Shapes of which a share of the cells is water."""
    return reports.flagged_shapes(_grid(spark, d), "o_custkey", F.col("v") < 60000, 0.3).withColumn("share", r("share", 6))


@query("""WITH f AS (SELECT o_custkey AS k, arg_max(o_totalprice, [epoch(o_orderdate), o_orderkey]) / 100000 - 2 AS ndwi, avg((o_orderstatus = 'O')::INT) AS dry_share, avg((o_totalprice < 100000)::INT) AS open_share, date_diff('day', max(o_orderdate) FILTER (o_totalprice < 50000)::DATE, DATE '2002-01-01') AS ds FROM orders GROUP BY 1)
SELECT k, coalesce(ndwi > 0, false) AS water, coalesce(dry_share < 0.3, false) AS dry, coalesce(open_share >= 0.5, false) OR coalesce(ds <= 600, false) AS days FROM f""")
def too_young_fields(spark, d):
    """Fields too young to deliver, by each of the three readings."""
    o = table(spark, d, "orders")
    newest = F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey"))
    f = o.groupBy(F.col("o_custkey").alias("k")).agg((newest / 100000 - 2).alias("ndwi"), F.avg((F.col("o_orderstatus") == "O").cast("int")).alias("dry_share"), F.avg((F.col("o_totalprice") < 100000).cast("int")).alias("open_share"), F.max(F.when(F.col("o_totalprice") < 50000, F.col("o_orderdate"))).alias("open"))
    f = f.withColumn("days_since_open", F.datediff(F.lit("2002-01-01").cast("date"), F.to_date("open")))
    return f.select("k", reports.too_young(f, "water", 0).alias("water"), reports.too_young(f, "dry", 0.3).alias("dry"), reports.too_young(f, "days", 600).alias("days"))


@query("SELECT event_id, (ceil(event_id / 5.0) - floor((event_id - 24) / 5.0))::INT AS images, substr(regexp_replace(event_type || ' ' || props, '[^A-Za-z0-9_.,:;-]', '_', 'g'), 1, 8) AS name FROM events")
def image_counts(spark, d):
    """Images that overlap the day before, and names of allowed characters."""
    from ..functions import columns as c

    e = table(spark, d, "events")
    text = F.concat_ws(" ", "event_type", "props")
    name = c.short_name(F.concat(text, F.lit(" "), F.repeat(F.lit("x"), 30)), 30)
    return e.select("event_id", c.steps_touched(F.col("event_id"), 24, 5.0).alias("images"), F.substring(name, 1, 8).alias("name"))
