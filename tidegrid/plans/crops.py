"""Queries of masks, season events and the own-scale rule: clear views, water, sowing, and the class of a field."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import steady_mean
from ..operators import classes, events, masks, own_scale, rules
from ..sources.tables import observations, table
from .registry import registry

QUERIES, ORACLE_SQL, query = registry()


def r(col, n=4):
    return F.round(col, n)


#: Radar passes, clear views and windows of a fitted curve made of the events table.
K_OF = "(props->>'$.k')::DOUBLE"
PASSES = f"p AS (SELECT user_id AS k, event_type AS track, date_diff('day', DATE '2024-01-01', ts::DATE)::INT AS day, avg(value) AS vh, avg({K_OF}) AS vv FROM events WHERE event_type IN ('view', 'click') GROUP BY ALL)"
VIEWS = f"v AS (SELECT user_id AS k, date_diff('day', DATE '2024-01-01', ts::DATE)::INT AS day, avg(value) / 100 - 0.1 AS ndvi, avg({K_OF}) / 200 - 0.2 AS lswi FROM events WHERE event_type IN ('purchase', 'error') GROUP BY ALL)"
FITS = """s AS (SELECT DISTINCT k, d AS day FROM v, (SELECT unnest(range(0, 30, 5)) AS d)), raw AS (SELECT k, day // 5 * 5 AS day, max(ndvi) AS raw FROM v GROUP BY ALL),
fit AS (SELECT s.k, s.day::INT AS day, coalesce(raw, last_value(raw IGNORE NULLS) OVER (PARTITION BY s.k ORDER BY s.day ROWS UNBOUNDED PRECEDING), first_value(raw IGNORE NULLS) OVER (PARTITION BY s.k ORDER BY s.day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS fit, raw IS NOT NULL AS seen FROM s LEFT JOIN raw USING (k, day))"""
SEASON = own_scale.Season(water_from=5, dry_until=8)


def _events(spark, d):
    obs = table(spark, d, "events")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    return obs.select(F.col("user_id").alias("k"), F.col("event_type").alias("track"), day.alias("day"), "value", F.get_json_object("props", "$.k").cast("double").alias("prop"))


def _passes(spark, d, mean=F.avg):
    return _events(spark, d).where("track in ('view', 'click')").groupBy("k", "track", "day").agg(mean("value").alias("vh"), F.avg("prop").alias("vv"))


def _views(spark, d, mean=F.avg):
    return _events(spark, d).where("track in ('purchase', 'error')").groupBy("k", "day").agg((mean("value") / 100 - 0.1).alias("ndvi"), (F.avg("prop") / 200 - 0.2).alias("lswi"))


def _fits(spark, d, mean=F.avg):
    from ..operators import temporal

    v = _views(spark, d, mean)
    raw = v.groupBy("k", (F.floor(F.col("day") / 5) * 5).cast("int").alias("day")).agg(F.max("ndvi").alias("raw"))
    spine = temporal.window_spine(v.select("k").distinct(), 0, 30, 5).withColumnRenamed("win", "day")
    return temporal.fill_previous(spine.join(raw, ["k", "day"], "left"), ["k"], "day", "raw", "fit").select("k", "day", "fit", F.col("raw").isNotNull().alias("seen"))


def _two(c):
    """Rounded to two places away from a tie of binary fractions."""
    return f"round({c}, 2)"


_TAIL = ", ".join(
    f"avg({p}x) FILTER ({p}b <= 2) AS {p}_pos_end, max({p}x) FILTER ({p}b = 1) - max({p}x) FILTER ({p}b = 3) AS {p}_slope_end, max({p}x) FILTER ({p}b = 1) - max({p}x) FILTER ({p}b = 2) AS {p}_step_end, "
    f"max({p}x) FILTER ({p}b = 1) - 2 * max({p}x) FILTER ({p}b = 2) + max({p}x) FILTER ({p}b = 3) AS {p}_accel_end, avg({p}x) FILTER ({p}b <= 2) - min({p}x) FILTER ({p}b <= 6) AS {p}_rise_recent, max({p}x) FILTER ({p}b <= 6) - avg({p}x) FILTER ({p}b <= 2) AS {p}_fall_recent"
    for p in ("vh", "vv")
)
_ENDS = [f"{p}_{n}" for p in ("vh", "vv") for n in ("pos_end", "slope_end", "step_end", "accel_end", "rise_recent", "fall_recent", "range_rel")]
OWN_SQL = f"""WITH {PASSES}, {VIEWS}, {FITS},
e AS (SELECT k, track, quantile_cont(vh, 0.1) AS hl, quantile_cont(vh, 0.9) AS hh, quantile_cont(vv, 0.1) AS vl, quantile_cont(vv, 0.9) AS vt FROM p GROUP BY ALL),
pos AS (SELECT p.*, CASE WHEN hh > hl THEN hh - hl END AS hs, CASE WHEN vt > vl THEN vt - vl END AS vs, CASE WHEN hh > hl THEN (vh - hl) / (hh - hl) END AS ph, CASE WHEN vt > vl THEN (vv - vl) / (vt - vl) END AS pv FROM p JOIN e USING (k, track)),
b AS (SELECT *, coalesce(ph <= 0.15 AND pv <= 0.15, false) AS bottom FROM pos),
o AS (SELECT *, last_value(CASE WHEN NOT bottom AND ph IS NOT NULL AND pv IS NOT NULL THEN [ph, pv] END IGNORE NULLS) OVER (PARTITION BY k, track ORDER BY day ROWS UNBOUNDED PRECEDING) AS ref FROM b),
m AS (SELECT *, bottom AND day >= 5 AND coalesce(ref[1] - ph >= 0.3 AND ref[2] - pv >= 0.3, false) AS wet FROM o),
fin AS (SELECT k, track, ph AS vhx, pv AS vvx, CASE WHEN ph IS NOT NULL THEN row_number() OVER (PARTITION BY k, track, ph IS NULL ORDER BY day DESC) END AS vhb, CASE WHEN pv IS NOT NULL THEN row_number() OVER (PARTITION BY k, track, pv IS NULL ORDER BY day DESC) END AS vvb FROM m),
tail AS (SELECT k, track, {_TAIL} FROM fin GROUP BY ALL),
d2 AS (SELECT k, track, day, vh - 2 * lag(vh, 1) OVER w + lag(vh, 2) OVER w AS dh, vv - 2 * lag(vv, 1) OVER w + lag(vv, 2) OVER w AS dv FROM p WINDOW w AS (PARTITION BY k, track ORDER BY day)),
nz AS (SELECT k, track, quantile_cont(abs(dh), 0.5) * 1.4826 / sqrt(6) AS nh, quantile_cont(abs(dv), 0.5) * 1.4826 / sqrt(6) AS nv FROM d2 GROUP BY ALL),
rr AS (SELECT k, track, CASE WHEN any_value(nh) > 0 THEN max(hs) / any_value(nh) END AS vh_range_rel, CASE WHEN any_value(nv) > 0 THEN max(vs) / any_value(nv) END AS vv_range_rel FROM m JOIN nz USING (k, track) GROUP BY ALL),
fb AS (SELECT k, track, min(day) FILTER (bottom AND day >= 5) AS fb FROM m GROUP BY ALL),
tp AS (SELECT k, track, arg_max(day, [ph, -day]) AS top FROM m JOIN fb USING (k, track) WHERE day >= 5 AND ph IS NOT NULL AND (fb IS NULL OR day >= fb) GROUP BY ALL),
cl AS (SELECT m.k, m.track, max(day) - max(day) FILTER (day >= 5 AND ph <= 0.15 AND day < top) AS radar_rise_days FROM m LEFT JOIN tp USING (k, track) GROUP BY ALL),
radar AS (SELECT k, {', '.join(f'quantile_cont({c}, 0.5) AS {c}' for c in _ENDS)}, quantile_cont(radar_rise_days, 0.5) AS radar_rise_days FROM rr LEFT JOIN tail USING (k, track) LEFT JOIN cl USING (k, track) GROUP BY k),
dry AS (SELECT k, track, quantile_cont(vh, 0.5) FILTER (day < 8) AS qh, quantile_cont(vv, 0.5) FILTER (day < 8) AS qv, count(*) FILTER (day < 8) AS n FROM p GROUP BY ALL),
depth AS (SELECT k, max(least((qh - vh) / CASE WHEN nh > 0 THEN nh END, (qv - vv) / CASE WHEN nv > 0 THEN nv END)) AS water_depth FROM p JOIN dry USING (k, track) JOIN nz USING (k, track) WHERE n >= 2 AND day >= 5 GROUP BY k),
ends AS (SELECT k, min(ndvi) AS lo, max(ndvi) AS pk, arg_min(day, [ndvi, day]) AS low_day, arg_max(day, [ndvi, -day]) AS peak_day, max(day) AS view_day FROM v GROUP BY k),
near AS (SELECT k, max(day) AS near_low FROM v JOIN ends USING (k) WHERE day <= peak_day AND ndvi <= lo + 0.1 * (pk - lo) GROUP BY k),
top9 AS (SELECT k, min(day) AS near_top FROM v JOIN ends USING (k) JOIN near USING (k) WHERE day <= peak_day AND ndvi >= lo + 0.9 * (pk - lo) AND day >= near_low GROUP BY k),
lastv AS (SELECT k, max(ndvi) FILTER (b = 1) AS last, max(lswi) FILTER (b = 1) AS lastw, max(ndvi) FILTER (b = 2) AS prev FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY day DESC) AS b FROM v) GROUP BY k),
wat AS (SELECT k, max(day) FILTER (ndvi < 0 OR lswi > ndvi) AS wday, max(day) FILTER (ndvi < 0) AS oday, avg((ndvi < 0 OR lswi > ndvi)::INT) FILTER (day < 8) AS dry_water_share FROM v GROUP BY k),
seen AS (SELECT k, CASE WHEN pk <> 0 THEN lo / pk END AS ndvi_low_peak, CASE WHEN pk > lo THEN (last - lo) / (pk - lo) END AS ndvi_left, CASE WHEN pk > lo THEN (prev - lo) / (pk - lo) END AS ndvi_left_prev, CASE WHEN pk > lo THEN (last - prev) / (pk - lo) END AS ndvi_slope_end,
 near_top - near_low AS ndvi_rise_seen, view_day - low_day AS days_since_ndvi_low, (last < 0 OR lastw > last)::INT AS last_view_water, (last < 0)::INT AS last_view_open_water, view_day - wday AS days_since_water_view, view_day - oday AS days_since_open_water_view, dry_water_share, view_day
 FROM ends LEFT JOIN near USING (k) LEFT JOIN top9 USING (k) JOIN lastv USING (k) JOIN wat USING (k)),
cp AS (SELECT k, max(fit) AS top, arg_max(day, [fit, -day]) AS peak_day, min(fit) AS season_low, max(day) AS end_day FROM fit GROUP BY k),
cb AS (SELECT k, min(f.fit) AS base FROM fit f JOIN cp USING (k) WHERE f.day <= peak_day GROUP BY k),
cm AS (SELECT k, any_value(top) AS top, any_value(base) AS base, any_value(season_low) AS season_low, any_value(end_day) AS end_day, any_value(peak_day) AS peak_day, max(f.day) FILTER (f.day <= peak_day AND f.fit <= base + 0.1 * (top - base)) AS d10,
 min(f.day) FILTER (f.day <= peak_day AND f.fit >= base + 0.9 * (top - base)) AS d90, max(f.day) FILTER (f.fit >= base + 0.9 * (top - base)) AS last_top, max(f.day) FILTER (f.day <= peak_day AND f.fit <= base + 0.2 * (top - base)) AS low_end FROM fit f JOIN cp USING (k) JOIN cb USING (k) GROUP BY k),
un AS (SELECT k, count(*) FILTER (f.seen AND f.day > d10 AND f.day < d90) AS inside FROM fit f JOIN cm USING (k) GROUP BY k),
curve AS (SELECT k, CASE WHEN top <> 0 THEN season_low / top END AS fit_low_peak, CASE WHEN d90 > d10 THEN d90 - d10 END AS ndvi_rise_days, end_day - peak_day AS days_since_peak, end_day - d90 AS days_at_top, end_day - last_top AS days_off_top, end_day - low_end AS crop_age, (coalesce(d90 > d10, false) AND inside = 0)::INT AS rise_unseen FROM cm JOIN un USING (k)),
sp AS (SELECT m.k, m.track, m.day, (m.wet AND coalesce((f.fit - base) / CASE WHEN top > base THEN top - base END < 0.5, false))::INT AS s FROM m JOIN cm USING (k) LEFT JOIN fit f ON f.k = m.k AND f.day = greatest(0, least(25, 5 * ceil(m.day / 5 - 0.5)))),
sc AS (SELECT *, sum(s) OVER (PARTITION BY k ORDER BY day RANGE BETWEEN CURRENT ROW AND 15 FOLLOWING) - sum(s) OVER (PARTITION BY k, day ORDER BY track ROWS UNBOUNDED PRECEDING) + s AS ahead FROM sp),
spell AS (SELECT k, max((s = 1 AND ahead >= 2)::INT) AS water_spell, min(day) FILTER (s = 1 AND ahead >= 2) AS first FROM sc GROUP BY k),
cs AS (SELECT m.k, m.track, max([day::DOUBLE, ph]) FILTER (ph IS NOT NULL AND day <= view_day) AS bh, max([day::DOUBLE, pv]) FILTER (pv IS NOT NULL AND day <= view_day) AS bv, max(day) AS lastp FROM m JOIN seen USING (k) GROUP BY ALL),
since AS (SELECT k, quantile_cont(CASE WHEN bh[1] < lastp THEN vh_pos_end - bh[2] END, 0.5) AS vh_since_view, quantile_cont(CASE WHEN bv[1] < lastp THEN vv_pos_end - bv[2] END, 0.5) AS vv_since_view FROM cs JOIN tail USING (k, track) GROUP BY k),
own AS (SELECT * EXCLUDE (first, low_end), coalesce(water_spell, 0) AS spell, coalesce(first, low_end) AS sowing_day, CASE WHEN first IS NOT NULL THEN 3 ELSE 0 END AS sowing_from FROM curve JOIN cm USING (k) LEFT JOIN seen USING (k) LEFT JOIN radar USING (k) LEFT JOIN depth USING (k) LEFT JOIN spell USING (k) LEFT JOIN since USING (k))"""
_OWN_COLUMNS = ["fit_low_peak", "ndvi_rise_days", "days_since_peak", "days_at_top", "days_off_top", "crop_age", "rise_unseen", "ndvi_low_peak", "ndvi_left", "ndvi_left_prev", "ndvi_slope_end", "ndvi_rise_seen", "days_since_ndvi_low", "last_view_water", "last_view_open_water", "days_since_water_view", "days_since_open_water_view", "dry_water_share", "view_day", *_ENDS, "radar_rise_days", "water_depth", "sowing_day", "sowing_from", "vh_since_view", "vv_since_view"]


def _features(spark, d, digits=2, whole=()):
    return own_scale.own_scale_features(_passes(spark, d, steady_mean), _views(spark, d, steady_mean), _fits(spark, d, steady_mean), SEASON, 5, digits, whole)


@query(OWN_SQL + " SELECT k, spell::DOUBLE AS water_spell, " + ", ".join(f"round(({c})::DOUBLE, 4) AS {c}" for c in _OWN_COLUMNS) + " FROM own")
def own_range_features(spark, d):
    """Every feature of the own-scale rule for each series."""
    return _features(spark, d, 4).select("k", "water_spell", *_OWN_COLUMNS)


_RULE = """CASE WHEN low_peak >= 0.45 THEN 'tree/orchard'
 WHEN vh_pos_end < 0.6 AND NOT grown AND coalesce(days_since_peak = 0 AND slope > 0 AND (climbing OR rose), false) THEN 'young rice'
 WHEN vh_pos_end < 0.6 AND NOT grown THEN 'flooded / bare'
 WHEN (coalesce(ndvi_rise_days < {fast}, false) OR coalesce(ndvi_rise_seen <= {fast}, false)) AND NOT coalesce(kept >= 0.85, false) AND NOT coalesce(days_off_top <= {ripen}, false) THEN 'other vegetation'
 WHEN crop_age <= {young} AND kept >= 0.85 THEN 'young rice' WHEN kept < 0.55 THEN 'rice harvested' WHEN spell = 1 THEN 'rice standing transplanted' ELSE 'rice standing direct seeded' END"""
_RULE_ROWS = """, f AS (SELECT *, round(ndvi_low_peak, 4) AS low_peak, round(ndvi_left, 4) AS kept, round(ndvi_slope_end, 4) AS slope, coalesce(ndvi_rise_days >= {fast} AND days_at_top >= {held}, false) AS grown, coalesce(round(vh_slope_end, 4) >= 0.2, false) AS climbing,
 coalesce(round(vv_step_end, 4) >= 0.3, false) OR (coalesce(round(vh_rise_recent, 4) >= 0.5, false) AND coalesce(round(vv_rise_recent, 4) >= 0.5, false)) AS rose FROM own)"""


def _rule_sql(**days):
    return _RULE_ROWS.format(**days), _RULE.format(**days)


#: The rule holds this one against its limit as it is; the others are rounded first.
_WHOLE = ("vh_pos_end",)
_SHORT = classes.OwnScale(fast_days=8, held_days=5, ripen_days=6, young_days=10)


@query(OWN_SQL + "{0} SELECT k, {1} AS class FROM f".format(*_rule_sql(fast=8, held=5, ripen=6, young=10)))
def relative_rule(spark, d):
    """Class of each series by the own-scale rule, its day limits cut to a season of thirty days."""
    f = _features(spark, d, 4, _WHOLE)
    return f.select("k", classes.own_scale_class(f, _SHORT).alias("class"))


@query(OWN_SQL + """{0}, g AS (SELECT *, {1} AS first FROM f), h AS (SELECT *, CASE WHEN coalesce(dry_water_share, 0) >= 0.5 THEN 'flooded / bare' ELSE first END AS a FROM g),
i AS (SELECT *, CASE WHEN a = 'rice harvested' AND NOT (coalesce(round(vh_fall_recent, 4), 0) >= 0.5 AND coalesce(round(vv_fall_recent, 4), 0) >= 0.5) AND NOT coalesce(round(vh_since_view, 4) <= -0.5 AND round(vv_since_view, 4) <= -0.5, false) THEN CASE WHEN spell = 1 THEN 'rice standing transplanted' ELSE 'rice standing direct seeded' END ELSE a END AS b FROM h),
j AS (SELECT *, CASE WHEN b = 'rice standing direct seeded' AND (coalesce(round(water_depth, 4), 0) > 0 OR spell = 1) THEN 'rice standing transplanted' ELSE b END AS c FROM i)
SELECT k, CASE WHEN c = 'young rice' AND round(water_depth, 4) <= 0 THEN 'rice standing direct seeded' ELSE c END AS class FROM j""".format(*_rule_sql(fast=8, held=5, ripen=6, young=10)))
def relative_rule_switched(spark, d):
    """The same with four switches on: ponds, a harvest needs both polarisations, any water is transplanted, young rice needs water."""
    f = _features(spark, d, 4, _WHOLE)
    return f.select("k", classes.own_scale_class(f, _SHORT.using(pond=True, harvest_needs_both=True, any_water=True, young_needs_water=True)).alias("class"))


@query(OWN_SQL + "{0}, f2 AS (SELECT *, coalesce(ndvi_rise_days >= 12 AND days_at_top >= 10, false) AS grown FROM (SELECT * EXCLUDE (grown) FROM f)) SELECT k, 'short' AS rule_set, {1} AS class FROM f UNION ALL SELECT k, 'long', {2} FROM f2".format(*_rule_sql(fast=8, held=5, ripen=6, young=10), _rule_sql(fast=12, held=10, ripen=3, young=15)[1]))
def rule_class_two_sets(spark, d):
    """The own-scale rule under two rule sets side by side."""
    f = _features(spark, d, 4, _WHOLE)
    sets = {"short": _SHORT, "long": classes.OwnScale(fast_days=12, held_days=10, ripen_days=3, young_days=15)}
    return rules.try_rule_sets(f, {n: classes.own_scale_class(f, x) for n, x in sets.items()}, ["k"])


# --- masks: bands made of order lines ---------------------------------------

BANDS = "b AS (SELECT l_orderkey AS cell, l_linenumber AS scene, l_suppkey, (l_quantity * 40)::DOUBLE AS blue, (l_partkey % 50 * 30)::DOUBLE AS green, (l_partkey % 37 * 40)::DOUBLE AS red, (l_suppkey % 30 * 130)::DOUBLE AS nir, CASE WHEN l_tax > 0.06 THEN 1024 WHEN l_tax > 0.04 THEN 2048 ELSE 0 END AS qa, round(l_discount * 1000)::DOUBLE AS score FROM lineitem), n AS (SELECT *, (red > 0 AND nir > 0) AS data, CASE WHEN red > 0 AND nir > 0 THEN (nir - red) / (nir + red) END AS ndvi FROM b)"


def _bands(spark, d):
    x = table(spark, d, "lineitem")
    num = lambda c: c.cast("double")
    qa = F.when(F.col("l_tax") > 0.06, 1024).when(F.col("l_tax") > 0.04, 2048).otherwise(0)
    out = x.select(F.col("l_orderkey").alias("cell"), F.col("l_linenumber").alias("scene"), "l_suppkey", num(F.col("l_quantity") * 40).alias("blue"), num(F.col("l_partkey") % 50 * 30).alias("green"), num(F.col("l_partkey") % 37 * 40).alias("red"), num(F.col("l_suppkey") % 30 * 130).alias("nir"), qa.alias("qa"), num(F.round(F.col("l_discount") * 1000)).alias("score"))
    data = masks.has_data(F.col("green"), F.col("red"), F.col("nir"))
    return out.withColumn("data", data).withColumn("ndvi", F.when(F.col("data"), (F.col("nir") - F.col("red")) / (F.col("nir") + F.col("red"))))


@query(f"""WITH {BANDS} SELECT scene, count(*) AS n, count(*) FILTER (data) AS with_data, count(*) FILTER (data OR (nir = 0 AND red > 0 AND green > 0)) AS with_water,
count(*) FILTER (data AND qa & 1024 = 0 AND score >= 40) AS strict, count(*) FILTER (data AND qa & 1024 = 0 AND (score >= 40 OR coalesce(nir < 1500 AND ndvi < 0.3, false))) AS dark_kept,
count(*) FILTER (data AND qa & 1024 = 0 AND (score >= 40 OR coalesce(nir < 1500 AND ndvi < 0.3, false)) AND NOT coalesce(blue > 900 AND (ndvi >= 0.3 OR blue >= 0.9 * red), false)) AS no_haze FROM n GROUP BY scene""")
def clear_masks(spark, d):
    """Rows that each form of the clear mask keeps, by scene."""
    x = _bands(spark, d)
    c = F.col
    base = lambda **kw: masks.clear(c("data"), c("qa"), c("score"), c("nir"), c("ndvi"), 40, **kw)
    count = lambda cond, name: F.count(F.when(cond, 1)).alias(name)
    return x.groupBy("scene").agg(F.count("*").alias("n"), count(c("data"), "with_data"), count(masks.has_data(c("green"), c("red"), c("nir"), True), "with_water"), count(base(), "strict"), count(base(keep_dark=True), "dark_kept"), count(base(keep_dark=True, blue=c("blue"), red=c("red")), "no_haze"))


@query(f"""WITH {BANDS}, t AS (SELECT CASE WHEN NOT data THEN 'no_data' WHEN qa & 1024 <> 0 THEN 'opaque' WHEN NOT (score >= 40 OR coalesce(nir < 1500 AND ndvi < 0.3, false)) THEN 'score' WHEN coalesce(blue > 900 AND (ndvi >= 0.3 OR blue >= 0.9 * red), false) THEN 'haze' ELSE 'kept' END AS test FROM n)
SELECT test, count(*) AS n FROM t GROUP BY test""")
def mask_tests(spark, d):
    """How many values each test of the mask removes."""
    c = F.col
    return _bands(spark, d).groupBy(masks.lost_to(c("data"), c("qa"), c("score"), c("nir"), c("ndvi"), c("blue"), c("red")).alias("test")).agg(F.count("*").alias("n"))


@query(f"WITH {BANDS} SELECT cell, scene FROM n GROUP BY ALL HAVING count(*) FILTER (data) > 0 AND count(*) FILTER (data AND score > 0) = 0")
def scoreless_scenes(spark, d):
    """Scenes of a cell whose score is missing and not low."""
    return masks.scoreless_dates(_bands(spark, d), ["cell", "scene"], "score", F.col("data"))


@query("""WITH x AS (SELECT user_id AS k, value AS x FROM events WHERE value > 0), lim AS (SELECT min(x) AS lo, max(x) AS hi FROM x), h0 AS (SELECT least(floor((x - lo) / (hi - lo) * 256), 255)::INT AS bin, count(*) AS n FROM x, lim GROUP BY 1), h AS (SELECT b.bin, coalesce(n, 0) AS n, lo, hi FROM (SELECT unnest(range(0, 256)) AS bin) b LEFT JOIN h0 USING (bin), lim),
c AS (SELECT *, lo + (bin + 0.5) * (hi - lo) / 256 AS centre FROM h), w AS (SELECT *, sum(n) OVER u AS w0, sum(n * centre) OVER u AS s0, sum(n) OVER () AS w, sum(n * centre) OVER () AS s FROM c WINDOW u AS (ORDER BY bin)),
g AS (SELECT centre, w0 * (w - w0) * (s0 / w0 - (s - s0) / (w - w0)) * (s0 / w0 - (s - s0) / (w - w0)) AS between_ FROM w WHERE w > w0 AND bin < 255), sp AS (SELECT avg(centre) AS t FROM g WHERE between_ >= (SELECT max(between_) FROM g) * (1 - 1e-9)),
up AS (SELECT k, x FROM x, sp WHERE x >= t), lv AS (SELECT k, quantile_cont(x, 0.5) AS level FROM up GROUP BY k), ow AS (SELECT k, any_value(level) AS level, 1.4826 * quantile_cont(abs(x - level), 0.5) AS own FROM up JOIN lv USING (k) GROUP BY k),
ar AS (SELECT 1.4826 * quantile_cont(abs(x - (SELECT quantile_cont(x, 0.5) FROM up)), 0.5) AS area FROM up)
SELECT e.k, round(coalesce(level - 2 * sqrt(own ** 2 + coalesce(area, 0) ** 2), t), 4) AS limit_ FROM (SELECT DISTINCT user_id AS k FROM events) e LEFT JOIN ow USING (k), sp, ar""")
def relative_score_limits(spark, d):
    """The lowest score that counts as clear, from each key's own clear scores."""
    x = table(spark, d, "events").select(F.col("user_id").alias("k"), "value")
    return masks.clear_limits(x, ["k"], "value").select("k", r("limit").alias("limit_"))


@query("""WITH x AS (SELECT user_id AS k, event_type AS scene, max(value) AS score FROM events GROUP BY ALL), b AS (SELECT k, max(score) AS best, arg_min(scene, struct_pack(v := -score, s := scene)) AS scene FROM x WHERE score > 5 GROUP BY k),
m AS (SELECT scene, quantile_cont(best, 0.5) AS m FROM b GROUP BY scene), s AS (SELECT scene, 1.4826 * quantile_cont(abs(best - m), 0.5) AS spread FROM b JOIN m USING (scene) GROUP BY scene)
SELECT x.k, x.scene, coalesce(x.score > 5 AND x.score >= best - 2 * spread, false) AS clear FROM x LEFT JOIN b ON b.k = x.k LEFT JOIN s ON s.scene = b.scene""")
def relative_clear(spark, d):
    """Views not far below the key's own best one, by the spread of that one's scene."""
    x = table(spark, d, "events").groupBy(F.col("user_id").alias("k"), F.col("event_type").alias("scene")).agg(F.max("value").alias("score"))
    return masks.clear_beside_best(x, ["k"], "scene", "score", F.col("score") > 5).select("k", "scene", "clear")


@query("""{obs}, x AS (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY ts, id) - 1 AS p FROM obs) SELECT k, coalesce(min(p) FILTER (v > 60), -1) AS first_clear FROM x GROUP BY k""")
def first_clear(spark, d):
    x = observations(spark, d).withColumn("at", F.struct("ts", "id"))
    return masks.first_seen(x, ["k"], "at", F.col("v") > 60).select("k", F.col("first_clear").cast("long").alias("first_clear"))


@query("SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS month, count(DISTINCT o_orderdate::DATE) AS days FROM orders GROUP BY ALL HAVING count(DISTINCT o_orderdate::DATE) < 2")
def months_below(spark, d):
    return masks.months_below(table(spark, d, "orders"), ["o_custkey"], "o_orderdate", 2)


# --- events -----------------------------------------------------------------


def _anchors(spark, d, mean=F.avg):
    """Each key's lowest view: (k, event_day, level, noise)."""
    v = _views(spark, d, mean)
    return v.groupBy("k").agg(F.min(F.struct("ndvi", "day")).alias("m")).select("k", F.col("m.day").alias("event_day"), F.col("m.ndvi").alias("level"), F.lit(0.05).alias("noise"))


ANCHORS = "a AS (SELECT k, arg_min(day, [ndvi, day]) AS event_day, min(ndvi) AS level, 0.05 AS noise FROM v GROUP BY k)"


@query(f"WITH {VIEWS}, {ANCHORS} SELECT a.k, count(*) FILTER (day > event_day AND ndvi >= level + 2 * noise) AS views_above, round(max(ndvi) FILTER (day > event_day), 6) AS best_after FROM a LEFT JOIN v USING (k) GROUP BY a.k")
def views_after_trough(spark, d):
    """Views after the lowest one that stand clearly above it, and the best of them."""
    v, a = _views(spark, d, steady_mean), _anchors(spark, d, steady_mean)
    return events.views_above(v, a, "k", "day", "ndvi", 2.0).join(events.best_view_after(v, a, "k", "day", "ndvi"), "k").select("k", "views_above", r("best_after", 6).alias("best_after"))


@query(f"WITH {VIEWS}, {FITS}, e AS (SELECT k, 3 AS wn, CASE WHEN k % 2 = 0 THEN 4 END AS climb FROM v GROUP BY k) SELECT e.k, NOT coalesce(min(raw) FILTER (day // 5 BETWEEN wn - 1 AND greatest(wn, coalesce(climb, wn))) > 0.3, false) AS bare_near FROM e LEFT JOIN raw USING (k) GROUP BY e.k")
def bare_near(spark, d):
    """Whether no view around an event contradicts bare ground; without views it does not."""
    v = _views(spark, d)
    raw = v.groupBy("k", F.floor(F.col("day") / 5).cast("int").alias("idx")).agg(F.max("ndvi").alias("raw"))
    e = v.select("k").distinct().withColumn("at", F.lit(3)).withColumn("climb", F.when(F.col("k") % 2 == 0, 4))
    return events.bare_near(raw, e, "k", "idx", "raw", 0.3, 1, 0)


@query(f"""WITH {PASSES}, {VIEWS}, {ANCHORS}, g AS (SELECT p.k, track, day - event_day AS gap, vh, vv FROM p JOIN a USING (k)),
t AS (SELECT k, track, quantile_cont(vh, 0.5) FILTER (gap BETWEEN -20 AND -4) - min(vh) FILTER (gap BETWEEN -3 AND 6) AS dh, min(vh) FILTER (gap BETWEEN -3 AND 6) AS fh, quantile_cont(vv, 0.5) FILTER (gap BETWEEN -20 AND -4) - min(vv) FILTER (gap BETWEEN -3 AND 6) AS dv FROM g GROUP BY ALL),
b AS (SELECT k, max(dv) AS vv_dip, max(dh) AS vh_dip, min(fh) AS vh_flood FROM t GROUP BY k)
SELECT k, round(vv_dip, 4) AS vv_dip, round(vh_dip, 4) AS vh_dip, (vv_dip IS NOT NULL OR vh_dip IS NOT NULL) AS checkable, ((vv_dip IS NOT NULL OR vh_dip IS NOT NULL) AND ((coalesce(vv_dip >= 3, false) AND NOT coalesce(vh_dip < -1, false)) OR (coalesce(vh_dip >= 3, false) AND NOT coalesce(vv_dip < -1, false))) AND NOT coalesce(vh_flood > 10, false)) AS wet FROM b""")
def pixel_dips(spark, d):
    """The best fall of either polarisation around each key's lowest view, and whether it tells of water."""
    p, a = _passes(spark, d), _anchors(spark, d).select("k", F.col("event_day").alias("anchor"))
    one = lambda c: events.dips(p, a, "k", "track", "day", c, (-20, -4), (-3, 6))
    return events.best_dips(one("vv"), one("vh"), "k", "track", darkest=10.0).select("k", r("vv_dip").alias("vv_dip"), r("vh_dip").alias("vh_dip"), "checkable", "wet")


@query(f"""WITH {PASSES}, {VIEWS}, {ANCHORS}, d2 AS (SELECT k, track, vh - 2 * lag(vh, 1) OVER w + lag(vh, 2) OVER w AS d FROM p WINDOW w AS (PARTITION BY k, track ORDER BY day)), nz AS (SELECT k, track, quantile_cont(abs(d), 0.5) * 1.4826 / sqrt(6) AS noise FROM d2 GROUP BY ALL),
s AS (SELECT p.k, track, day, CASE WHEN lead(vh) OVER w IS NOT NULL AND lag(vh, 2) OVER w IS NOT NULL THEN (vh + lead(vh) OVER w) / 2 - (lag(vh) OVER w + lag(vh, 2) OVER w) / 2 END AS step FROM p WINDOW w AS (PARTITION BY p.k, track ORDER BY day)),
j AS (SELECT s.*, nz.noise AS noise, event_day AS x, event_day + 4 AS y FROM s JOIN nz USING (k, track) JOIN a USING (k) WHERE nz.noise > 0), n AS (SELECT *, arg_min(day, [abs(day - x), day]) OVER (PARTITION BY k, track) AS nx, arg_min(day, [abs(day - y), day]) OVER (PARTITION BY k, track) AS ny FROM j),
t AS (SELECT k, track, max(step) / any_value(noise) AS z FROM n WHERE day BETWEEN nx AND ny GROUP BY ALL HAVING max(step) IS NOT NULL)
SELECT k, round(sum(z) / sqrt(count(*)), 4) AS z, sum(z) / sqrt(count(*)) >= 2 AS brightened FROM t GROUP BY k""")
def brightened(spark, d):
    """Whether the radar rose from each key's lowest view to four days later."""
    spans = _anchors(spark, d).select("k", F.col("event_day").alias("day"), (F.col("event_day") + 4).alias("until"))
    return events.brightening(_passes(spark, d), spans, "k", "track", "day", "vh").select("k", r("z").alias("z"), "brightened")


@query(f"""WITH {PASSES}, d2 AS (SELECT k, track, vh - 2 * lag(vh, 1) OVER w + lag(vh, 2) OVER w AS d FROM p WINDOW w AS (PARTITION BY k, track ORDER BY day)), nz AS (SELECT k, track, quantile_cont(abs(d), 0.5) * 1.4826 / sqrt(6) AS noise FROM d2 GROUP BY ALL),
s AS (SELECT k, track, list_sort(list(vh))[2] AS low2, count(*) AS n FROM p GROUP BY ALL), en AS (SELECT k, track, quantile_cont(vh, 0.5) AS e FROM (SELECT *, row_number() OVER (PARTITION BY k, track ORDER BY day DESC) AS b FROM p) WHERE b <= 2 GROUP BY ALL),
x AS (SELECT p.*, min(vh) OVER (PARTITION BY k, track ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM p), f AS (SELECT k, track, max(day) AS d FROM x JOIN nz USING (k, track) JOIN s USING (k, track) JOIN en USING (k, track) WHERE n >= 4 AND (later IS NULL OR vh < later) AND vh <= low2 + 2 * noise AND e - vh >= 2 * noise GROUP BY ALL)
SELECT k, round_even(quantile_cont(d, 0.5), 0)::INT AS sowing FROM f GROUP BY k""")
def radar_sowing(spark, d):
    """Start of the standing crop from the radar tracks alone."""
    return events.radar_sowing(_passes(spark, d), "k", ["track"], "day", "vh")


@query(f"""WITH {VIEWS}, lo AS (SELECT k, min(ndvi) AS low, stddev_samp(ndvi) / 4 AS wobble FROM v GROUP BY k), m AS (SELECT quantile_cont(low, 0.5) AS m FROM lo WHERE low < 0.2), s AS (SELECT any_value(m) AS m, 1.4826 * quantile_cont(abs(low - m), 0.5) AS s FROM lo, m WHERE low < 0.2)
SELECT k, round(greatest(m + 2 * sqrt(s ** 2 + coalesce(wobble, 0) ** 2), low + 2 * coalesce(wobble, 0)), 4) AS ceiling FROM lo, s""")
def bare_ceiling(spark, d):
    lows = _views(spark, d).groupBy("k").agg(F.min("ndvi").alias("low"), (F.stddev("ndvi") / 4).alias("wobble"))
    return events.bare_ceiling(lows, "k", "low", "wobble", F.col("low") < 0.2).select("k", r("ceiling").alias("ceiling"))


@query(f"""WITH {VIEWS}, pk AS (SELECT k, arg_max(day, [ndvi, -day]) AS pd FROM v GROUP BY k), e AS (SELECT k, max(ndvi) AS top, min(ndvi) AS low FROM v JOIN pk USING (k) WHERE day >= pd GROUP BY k)
SELECT v.k, min(day) FILTER (top - low >= 0.15 AND ndvi <= (top + low) / 2) AS half_fall FROM v JOIN pk USING (k) JOIN e USING (k) WHERE day > pd GROUP BY v.k""")
def half_fall(spark, d):
    return events.half_fall(_views(spark, d), ["k"], "day", "ndvi", 0.15)


@query(f"WITH {VIEWS}, {FITS}, {ANCHORS} SELECT a.k, max(day) FILTER (fit <= 0.3 AND day BETWEEN event_day - 10 AND event_day + 10) AS bare_end FROM a LEFT JOIN fit USING (k) GROUP BY a.k")
def bare_end(spark, d):
    e = _anchors(spark, d).select("k", (F.col("event_day") - 10).alias("trough"), (F.col("event_day") + 10).alias("climb"))
    return events.last_bare(_fits(spark, d), e, "k", "day", F.col("fit") <= 0.3)


@query(f"WITH {VIEWS}, {ANCHORS} SELECT v.k, round(quantile_cont(ndvi, 0.5) - min(ndvi) FILTER (day BETWEEN event_day - 5 AND event_day - 1), 6) AS drop FROM v JOIN a USING (k) GROUP BY v.k")
def drop_before(spark, d):
    """The season's median less the least value in the five days before the lowest view."""
    spans = _anchors(spark, d).select("k", (F.col("event_day") - 5).alias("lo"), (F.col("event_day") - 1).alias("hi"))
    return events.drop_inside(_views(spark, d), spans, "k", "day", "ndvi").select("k", r("drop", 6).alias("drop"))


_SLOPE = "CASE WHEN lag({0}) OVER w IS NULL THEN lead({0}) OVER w - {0} WHEN lead({0}) OVER w IS NULL THEN {0} - lag({0}) OVER w ELSE (lead({0}) OVER w - lag({0}) OVER w) / 2 END"


@query(f"WITH {VIEWS}, {FITS}, s1 AS (SELECT k, day, {_SLOPE.format('fit')} AS s FROM fit WINDOW w AS (PARTITION BY k ORDER BY day)), c AS (SELECT k, day, {_SLOPE.format('s')} AS c FROM s1 WINDOW w AS (PARTITION BY k ORDER BY day)) SELECT k, arg_min(day, [-round(c, 9), day]) AS onset FROM c GROUP BY k")
def acceleration_onset(spark, d):
    """Where each fitted curve turns up most sharply."""
    fits = _fits(spark, d)
    return events.onset(fits, fits.select("k").distinct().withColumns({"lo": F.lit(0), "hi": F.lit(25)}), "k", "day", "fit")


@query(f"WITH {VIEWS}, {FITS} SELECT k, min(day) FILTER (fit >= 0.4) AS up, coalesce(max(day) FILTER (fit < 0.2 AND day < 20), -1) AS last_low FROM fit GROUP BY k")
def level_crossings(spark, d):
    """First window at a level and the last low one before a bound."""
    fits = _fits(spark, d)
    up = events.first_past(fits, ["k"], "day", "fit", F.lit(0.4)).withColumnRenamed("first_past", "up")
    return up.join(events.last_flagged(fits, ["k"], "day", F.col("fit") < 0.2, 20).withColumnRenamed("last", "last_low"), "k")


@query(f"""WITH {VIEWS}, x AS (SELECT k, day, ndvi, row_number() OVER w AS i, coalesce(ndvi < lag(ndvi) OVER w AND ndvi < lead(ndvi) OVER w, false) AS low FROM v WINDOW w AS (PARTITION BY k ORDER BY day)),
l AS (SELECT *, (SELECT max(b.ndvi) FROM x b WHERE b.k = a.k AND b.i < a.i AND b.i >= coalesce((SELECT max(c.i) FROM x c WHERE c.k = a.k AND c.low AND c.i < a.i), 0)) AS lp, (SELECT max(b.ndvi) FROM x b WHERE b.k = a.k AND b.i >= a.i AND b.i < coalesce((SELECT min(c.i) FROM x c WHERE c.k = a.k AND c.low AND c.i > a.i), 999999)) AS rp FROM x a WHERE low),
v2 AS (SELECT *, ndvi + (least(lp, rp) - ndvi) / 2 AS level FROM l),
s AS (SELECT a.k, a.i, (SELECT max(b.i) FROM x b WHERE b.k = a.k AND b.i < a.i AND b.ndvi > level) AS lo, (SELECT min(b.i) FROM x b WHERE b.k = a.k AND b.i > a.i AND b.ndvi > level) AS hi FROM v2 a)
SELECT s.k, s.i::INT AS i, max(b.day) - min(b.day) AS low_days FROM s JOIN x b ON b.k = s.k AND (lo IS NULL OR b.i > lo) AND (hi IS NULL OR b.i < hi) GROUP BY s.k, s.i HAVING max(b.day) - min(b.day) >= 3""")
def durable_lows(spark, d):
    """Lows at which the views stay low for three days or more."""
    from ..operators.temporal import by

    w = by(["k"], "day")
    x = _views(spark, d).withColumn("i", F.row_number().over(w)).withColumn("low", F.coalesce((F.col("ndvi") < F.lag("ndvi").over(w)) & (F.col("ndvi") < F.lead("ndvi").over(w)), F.lit(False)))
    return events.durable_lows(x, "k", "i", "day", "ndvi", F.col("low"), 3)


@query(f"""WITH {PASSES}, a AS (SELECT k, day, vh AS v FROM p WHERE track = 'view'), b AS (SELECT k, day, vh AS v FROM p WHERE track = 'click'),
m AS (SELECT b.k, b.day, arg_min(a.v - b.v, [abs(a.day - b.day), a.day]) AS off FROM b JOIN a ON a.k = b.k AND abs(a.day - b.day) <= 1 GROUP BY ALL), s AS (SELECT k, quantile_cont(off, 0.5) AS s FROM m GROUP BY k)
SELECT k, day, round(v, 4) AS v, 0 AS part FROM a UNION ALL SELECT b.k, b.day, round(b.v + s, 4), 1 FROM b JOIN s USING (k)""")
def merged_tracks(spark, d):
    """Two tracks as one series, the second moved by the median offset of near passes."""
    p = _passes(spark, d).withColumnRenamed("vh", "v")
    got = events.merge_series(p.where("track = 'view'").select("k", "day", "v"), p.where("track = 'click'").select("k", "day", "v"), "k", "day", "v", 1)
    return got.select("k", "day", r("v").alias("v"), "part")
