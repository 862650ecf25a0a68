"""Queries of the season rules: peers, floods, cycles, radar masks, status of fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import season, temporal
from ..sources.tables import table
from .crops import ANCHORS, FITS, PASSES, VIEWS, _anchors, _fits, _passes, _views, r
from .registry import registry

QUERIES, ORACLE_SQL, query = registry()


@query(f"WITH {VIEWS}, e AS (SELECT k, min(ndvi) AS low, max(ndvi) AS top, stddev_pop(ndvi) / 5 AS noise FROM v GROUP BY k), m AS (SELECT quantile_cont(top, 0.5) AS m, count(*) AS n FROM e WHERE low < 0.1 HAVING count(*) >= 5), s AS (SELECT any_value(m) AS m, 1.4826 * quantile_cont(abs(top - m), 0.5) AS s FROM e, m WHERE low < 0.1) SELECT k, round((top - m) / sqrt(s ** 2 + noise ** 2), 4) AS above, coalesce(top >= m - 2 * sqrt(s ** 2 + noise ** 2), false) AS reaches FROM e, s")
def beside_peers(spark, d):
    """How a key's peak stands to that of confirmed peers."""
    e = _views(spark, d).groupBy("k").agg(F.min("ndvi").alias("low"), F.max("ndvi").alias("top"), (F.stddev_pop("ndvi") / 5).alias("noise"))
    return season.beside_peers(e, "top", "noise", season.peer_level(e, "top", F.col("low") < 0.1, 5)).select("k", r("above").alias("above"), "reaches")


@query(f"""WITH {VIEWS}, {FITS}, {ANCHORS}, l AS (SELECT k, max(day) AS last FROM fit GROUP BY k), w AS (SELECT a.k, coalesce(min(day) FILTER (day >= event_day), any_value(last)) AS w FROM a JOIN fit USING (k) JOIN l USING (k) GROUP BY a.k),
x AS (SELECT w.k, any_value(w) AS w, max(fit) FILTER (day >= w) AS p, max(fit) FILTER (day = w) AS s, max(fit) FILTER (day = last) AS e FROM w JOIN fit USING (k) JOIN l USING (k) GROUP BY w.k) SELECT k, round(s, 6) AS at_flood, round(p, 6) AS peak_after_flood, round(p - s, 6) AS rise_from_flood, (e >= 0.3 AND e >= p - 0.2) AS standing_after_flood FROM x""")
def after_flood(spark, d):
    """The climb measured from each key's lowest view."""
    floods = _anchors(spark, d).select("k", F.col("event_day").alias("flood"))
    x = season.after_flood(_fits(spark, d), floods, "k", "day", "fit", 0.3, 0.2)
    return x.select("k", *[r(c, 6).alias(c) for c in ("at_flood", "peak_after_flood", "rise_from_flood")], "standing_after_flood")


@query(f"WITH {VIEWS}, {FITS} SELECT k, coalesce(max(day) FILTER (fit <= 0.05 + k % 4 * 0.05), arg_min(day, [fit, -day])) AS trough_day FROM fit GROUP BY k")
def last_low(spark, d):
    """The last window at the key's bare level, or its lowest."""
    fits = _fits(spark, d)
    return season.last_low(fits, fits.select("k").distinct().withColumn("level", 0.05 + F.col("k") % 4 * 0.05), "k", "day", "fit")


CYC = """cy AS (SELECT o_custkey AS k, date_diff('day', DATE '1995-01-01', o_orderdate::DATE)::INT % 365 AS peak_day, o_totalprice AS growth, o_orderstatus <> 'P' AS complete, o_orderkey % 200 AS length, CASE WHEN o_orderpriority > '2' THEN o_orderstatus = 'F' END AS wet FROM orders)"""
_OTSU = """lim AS (SELECT min(growth) AS lo, max(growth) AS hi FROM cy), h0 AS (SELECT least(floor((growth - lo) / (hi - lo) * 256), 255)::INT AS bin, count(*) AS n FROM cy, lim GROUP BY 1), h AS (SELECT b.bin, coalesce(n, 0) AS n, lo + (b.bin + 0.5) * (hi - lo) / 256 AS centre FROM (SELECT unnest(range(0, 256)) AS bin) b LEFT JOIN h0 USING (bin), lim),
u AS (SELECT *, sum(n) OVER (ORDER BY bin) AS w0, sum(n * centre) OVER (ORDER BY bin) AS s0, sum(n) OVER () AS w, sum(n * centre) OVER () AS s FROM h), g AS (SELECT centre, w0 * (w - w0) * power(s0 / w0 - (s - s0) / (w - w0), 2) AS b FROM u WHERE w > w0 AND bin < 255), cut AS (SELECT avg(centre) AS cut FROM g WHERE b >= (SELECT max(b) FROM g) * (1 - 1e-9))"""


def _cycles(spark, d):
    o = table(spark, d, "orders")
    day = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")) % 365
    return o.select(F.col("o_custkey").alias("k"), day.alias("peak_day"), F.col("o_totalprice").alias("growth"), (F.col("o_orderstatus") != "P").alias("complete"), (F.col("o_orderkey") % 200).alias("length"), F.when(F.col("o_orderpriority") > "2", F.col("o_orderstatus") == "F").alias("wet"))


@query(f"""WITH {CYC}, {_OTSU}, sw AS (SELECT quantile_cont(peak_day, 0.5) AS centre, any_value(cut) AS cut FROM cy, cut WHERE growth >= cut AND complete), c AS (SELECT * FROM (SELECT cy.*, centre, sw.cut, row_number() OVER (PARTITION BY k ORDER BY growth DESC, peak_day) AS rn FROM cy, sw WHERE peak_day BETWEEN centre - 60 AND centre + 60) WHERE rn = 1)
SELECT k, peak_day, growth, round(centre, 4) AS centre, round(cut, 4) AS cut, CASE WHEN NOT complete THEN 'incomplete' WHEN NOT growth >= cut THEN 'weak' WHEN NOT length >= 30 THEN 'too short' WHEN NOT length <= 150 THEN 'too long' WHEN wet IS NOT NULL AND NOT wet THEN 'dry at sowing' ELSE 'rice' END AS verdict FROM c""")
def season_cycles(spark, d):
    """Each key's cycle in the area's own season and the first test that it fails."""
    cy = _cycles(spark, d)
    got = season.season_cycles(cy, season.season_window(cy, 60), "k")
    return got.select("k", "peak_day", "growth", r("centre").alias("centre"), r("cut").alias("cut"), season.cycle_verdict(30, 150).alias("verdict"))


def _otsu_of(name, source, value):
    return f"""{name}l AS (SELECT min({value}) AS lo, max({value}) AS hi FROM {source}), {name}0 AS (SELECT least(floor(({value} - lo) / (hi - lo) * 256), 255)::INT AS bin, count(*) AS n FROM {source}, {name}l WHERE {value} IS NOT NULL GROUP BY 1), {name}h AS (SELECT b.bin, coalesce(n, 0) AS n, lo + (b.bin + 0.5) * (hi - lo) / 256 AS centre FROM (SELECT unnest(range(0, 256)) AS bin) b LEFT JOIN {name}0 USING (bin), {name}l),
{name}u AS (SELECT *, sum(n) OVER (ORDER BY bin) AS w0, sum(n * centre) OVER (ORDER BY bin) AS s0, sum(n) OVER () AS w, sum(n * centre) OVER () AS s FROM {name}h), {name}g AS (SELECT centre, w0 * (w - w0) * power(s0 / w0 - (s - s0) / (w - w0), 2) AS b FROM {name}u WHERE w > w0 AND bin < 255 AND w0 > 0), {name} AS (SELECT avg(centre) AS cut FROM {name}g WHERE b >= (SELECT max(b) FROM {name}g) * (1 - 1e-9))"""


@query(f"WITH {PASSES}, lv AS (SELECT k, quantile_cont(vh, 0.5) FILTER (day < 8) AS dry, min(vh) FILTER (day BETWEEN 10 AND 20) AS sow FROM p GROUP BY k), {_otsu_of('ca', 'lv', 'dry')}, st AS (SELECT k, coalesce(dry <= cut, false) AS cropland, CASE WHEN dry <= cut THEN sow END AS s FROM lv, ca), {_otsu_of('cb', 'st', 's')} SELECT k, cropland, coalesce(s <= cut, false) AS flooded, cropland AND coalesce(s <= cut, false) AS rice FROM st, cb")
def two_stage_mask(spark, d):
    """Ground dark when dry, then dark at sowing, by the area's own cuts."""
    lv = _passes(spark, d).groupBy("k").agg(F.percentile(F.when(F.col("day") < 8, F.col("vh")), F.lit(0.5)).alias("dry"), F.min(F.when(F.col("day").between(10, 20), F.col("vh"))).alias("sow"))
    return season.two_stage_mask(lv, "dry", "sow").select("k", "cropland", "flooded", "rice")


@query(f"""WITH {PASSES}, f AS (SELECT k, min(vh) FILTER (day < 8) AS pre_min, count(*) FILTER (vh < 4) AS support, arg_max(vh, [day, vh]) AS vh_end, max(vh) - min(vh) AS climb, max(vh) FILTER (day > 20) - arg_max(vh, [day, vh]) AS vh_fall, max(vv) FILTER (day > 20) - arg_max(vv, [day, vv]) AS vv_fall FROM p GROUP BY k),
x AS (SELECT *, coalesce(support >= 2, false) AND NOT coalesce(pre_min > 8, false) AS fl, coalesce(vh_end >= 12, false) AND coalesce(climb >= 20, false) AS gr FROM f) SELECT k, CASE WHEN fl AND gr AND coalesce(vh_fall >= 5 AND vv_fall >= 5, false) THEN 4 WHEN fl AND gr THEN 1 WHEN fl AND vh_end > 6 THEN 2 WHEN fl THEN 7 ELSE 0 END AS code FROM x""")
def radar_codes(spark, d):
    """Codes of each key from the radar alone."""
    end = lambda c: F.max_by(c, F.struct("day", c))
    late = lambda c: F.max(F.when(F.col("day") > 20, F.col(c)))
    f = _passes(spark, d).groupBy("k").agg(F.min(F.when(F.col("day") < 8, F.col("vh"))).alias("pre_min"), F.count(F.when(F.col("vh") < 4, 1)).alias("support"), end("vh").alias("vh_end"), (F.max("vh") - F.min("vh")).alias("climb"), (late("vh") - end("vh")).alias("vh_fall"), (late("vv") - end("vv")).alias("vv_fall"))
    return f.withColumn("flood", F.lit(True)).select("k", season.radar_codes(cover=8, support=2, canopy=12, climb=20, fall=5, young=6).alias("code"))


@query(f"""WITH {PASSES}, h AS (SELECT k, day // 5 AS period, quantile_cont(vh, 0.5) AS vh, quantile_cont(vv, 0.5) AS vv FROM p GROUP BY ALL), a AS (SELECT k, max(vh) AS hi, min(vh) AS lo, min(vv) AS vm, coalesce(max(vh) FILTER (period = 5), max(vh) FILTER (period = 4)) AS now FROM h GROUP BY k)
SELECT k, vm < 30 AS flooded, coalesce(now > 8, false) AS green, hi - lo > 15 AS seasonal, coalesce(hi - now < 30, false) AS uncut, vm < 30 AND coalesce(now > 8, false) AND hi - lo > 15 AND coalesce(hi - now < 30, false) AS rice FROM a""")
def half_month_rule(spark, d):
    h = _passes(spark, d).groupBy("k", F.floor(F.col("day") / 5).alias("period")).agg(F.percentile("vh", F.lit(0.5)).alias("vh"), F.percentile("vv", F.lit(0.5)).alias("vv"))
    return season.half_month_rule(h, "k", "period", 5, 30, 8, 15, 30).select("k", "flooded", "green", "seasonal", "uncut", "rice")


DROPS = "dr AS (SELECT k, track, day, quantile_cont(vh, 0.5) OVER (PARTITION BY k, track ORDER BY day RANGE BETWEEN 12 PRECEDING AND 2 PRECEDING) - vh AS drop FROM p)"


def _drops(spark, d):
    p = _passes(spark, d)
    return p.select("k", "track", "day", temporal.local_drop(["k", "track"], "day", "vh", 12, 2).alias("drop"))


@query(f"""WITH {PASSES}, {VIEWS}, {ANCHORS}, {DROPS}, x AS (SELECT dr.* FROM dr JOIN a USING (k) WHERE day - event_day BETWEEN -8 AND 4 AND drop IS NOT NULL), b AS (SELECT k, track, max(drop) AS best, arg_max(day, [drop, -day]) AS best_day FROM x GROUP BY ALL),
h AS (SELECT b.k, b.track, any_value(best) AS best, any_value(best_day) AS best_day, count(*) FILTER (abs(day - best_day) <= 6 AND drop >= 5) AS held FROM b JOIN x USING (k, track) GROUP BY ALL), c AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY best DESC, track DESC) AS rn FROM h)
SELECT k, round(best, 4) AS flood_drop, best_day AS flood_day, held AS persist FROM c WHERE rn = 1""")
def persistent_floods(spark, d):
    """The largest drop of each key near its lowest view and on how many passes it stood."""
    a = _anchors(spark, d).select("k", F.col("event_day").alias("anchor"))
    got = season.persistent_floods(_drops(spark, d), a, "k", "track", "day", "drop", (-8, 4), 5.0, 6)
    return got.select("k", r("flood_drop").alias("flood_drop"), "flood_day", "persist")


@query(f"""WITH {PASSES}, {DROPS}, n AS (SELECT *, lead(drop) OVER (PARTITION BY k, track ORDER BY day) AS nx FROM dr) SELECT k, track, day, round(drop, 4) AS drop FROM n WHERE drop >= 5 AND (coalesce(nx >= 5, false) OR EXISTS (SELECT 1 FROM dr o WHERE o.k = n.k AND o.track <> n.track AND o.drop >= 5 AND abs(o.day - n.day) <= 3))""")
def witnessed_floods(spark, d):
    """Drops that the next pass or another track saw as well."""
    return season.seen_again(_drops(spark, d), "k", "track", "day", "drop", 5.0, 3).withColumn("drop", r("drop"))


@query(f"""WITH {PASSES}, {VIEWS}, n AS (SELECT k, max(day) FILTER (ndvi < 0.1) AS newest, max(day) FILTER (ndvi < 0.1 AND day < 15) AS previous FROM v GROUP BY k), rd AS (SELECT k, arg_min(day, [vh, day]) AS radar FROM p GROUP BY k),
x AS (SELECT *, coalesce(abs(radar - newest) <= 4, false) AS ag FROM n LEFT JOIN rd USING (k)), y AS (SELECT *, CASE WHEN coalesce(newest <= 18, false) OR ag THEN newest ELSE coalesce(previous, newest) END AS sowing FROM x) SELECT k, sowing, CASE WHEN sowing IS NULL THEN 0 WHEN sowing <= 18 THEN 1 WHEN ag AND sowing = newest THEN 2 ELSE 3 END AS period FROM y""")
def sowing_choice(spark, d):
    """The newest trough; a late one only where the radar agrees."""
    low = F.col("ndvi") < 0.1
    n = _views(spark, d).groupBy("k").agg(F.max(F.when(low, F.col("day"))).alias("newest"), F.max(F.when(low & (F.col("day") < 15), F.col("day"))).alias("previous"))
    radar = _passes(spark, d).groupBy("k").agg(F.min_by("day", F.struct("vh", "day")).alias("radar"))
    return season.sowing_choice(n.join(radar, "k", "left"), 18, 4).select("k", "sowing", "period")


@query(f"WITH {VIEWS}, e AS (SELECT k, min(ndvi) AS lo, max(ndvi) AS hi, arg_max(ndvi, [day, ndvi]) AS last, max(lswi) AS w FROM v GROUP BY k) SELECT CASE WHEN lo < 0 THEN 'W' ELSE '-' END || CASE WHEN hi > 0.5 THEN 'G' ELSE '-' END || CASE WHEN last < (lo + hi) / 2 THEN 'C' ELSE '-' END || CASE WHEN w > 0.25 THEN 'L' ELSE '-' END AS code, count(*) AS n FROM e GROUP BY 1")
def factor_codes(spark, d):
    """Keys by the factors that hold for them."""
    e = _views(spark, d).groupBy("k").agg(F.min("ndvi").alias("lo"), F.max("ndvi").alias("hi"), F.max_by("ndvi", F.struct("day", "ndvi")).alias("last"), F.max("lswi").alias("w"))
    code = season.factor_code([("W", F.col("lo") < 0), ("G", F.col("hi") > 0.5), ("C", F.col("last") < (F.col("lo") + F.col("hi")) / 2), ("L", F.col("w") > 0.25)])
    return e.groupBy(code.alias("code")).agg(F.count("*").alias("n"))


@query()
def field_status(spark, d):
    """Standing or harvested from each key's views; held against hand-made curves in the tests."""
    v = _views(spark, d).groupBy("k").agg(F.sort_array(F.collect_list(F.struct("day", "ndvi"))).alias("s"))
    s = season.field_status(F.col("s.day").cast("array<double>"), F.col("s.ndvi"))
    return v.select("k", s.alias("x")).select("k", "x.status", "x.cut_from", "x.cut_to", r("x.drop_share").alias("drop_share"))
