"""Queries over dated series."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import aggregate, robust, temporal
from ..sources.tables import observations, table
from .registry import registry

QUERIES, ORACLE_SQL, query = registry()
KT = ["k", "track"]


def r(col, n=4):
    return F.round(col, n)


@query("""{obs},
d AS (SELECT k, track, v - 2 * lag(v, 1) OVER w + lag(v, 2) OVER w AS d2 FROM obs WINDOW w AS (PARTITION BY k, track ORDER BY ts, id)),
n AS (SELECT k, track, quantile_cont(abs(d2), 0.5) * 1.4826 / sqrt(6) AS noise FROM d GROUP BY ALL),
p AS (SELECT k, track, quantile_cont(v, 0.1) AS p_low, quantile_cont(v, 0.9) AS p_high, count(v) AS n FROM obs GROUP BY ALL),
l AS (SELECT k, track, avg(v) AS end_mean FROM (SELECT *, row_number() OVER (PARTITION BY k, track ORDER BY ts DESC, id DESC) AS b FROM obs) WHERE b <= 2 GROUP BY ALL),
g AS (SELECT k, track, max(day - prev) AS longest_gap FROM (SELECT k, track, day, lag(day) OVER (PARTITION BY k, track ORDER BY day) AS prev FROM (SELECT DISTINCT k, track, day FROM obs)) GROUP BY ALL),
s AS (SELECT k, track, count(DISTINCT day // 5)::BIGINT AS windows FROM obs GROUP BY ALL)
SELECT k, track, p.n::BIGINT AS n, round(noise, 4) AS noise, round(p_low, 4) AS p_low, round(p_high, 4) AS p_high, round(CASE WHEN p_high > p_low THEN (end_mean - p_low) / (p_high - p_low) END, 4) AS position, windows, longest_gap::INT AS longest_gap
FROM p JOIN n USING (k, track) JOIN l USING (k, track) JOIN g USING (k, track) JOIN s USING (k, track)""")
def own_range_flagship(spark, d):
    """Per series: noise, own range, where its end stands in it, windows seen and the longest gap."""
    obs = observations(spark, d)
    own = robust.own_range(obs, KT, ["ts", "id"], "v")
    noise = robust.pass_noise(obs, KT, ["ts", "id"], "v")
    days = obs.select(*KT, "day").distinct()
    gap = days.withColumn("_g", F.col("day") - F.lag("day").over(temporal.by(KT, "day"))).groupBy(*KT).agg(F.max("_g").alias("longest_gap"), F.countDistinct(F.floor(F.col("day") / 5)).alias("windows"))
    return own.join(noise, KT).join(gap, KT).select(*KT, "n", r("noise").alias("noise"), r("p_low").alias("p_low"), r("p_high").alias("p_high"), r("position").alias("position"), "windows", "longest_gap")


@query("""{obs}, d AS (SELECT k, v - 2 * lag(v, 1) OVER w + lag(v, 2) OVER w AS d2 FROM obs WINDOW w AS (PARTITION BY k ORDER BY ts, id))
SELECT k, round(quantile_cont(abs(d2), 0.5) * 1.4826 / sqrt(6), 4) AS noise FROM d GROUP BY k""")
def pass_noise(spark, d):
    return robust.pass_noise(observations(spark, d), ["k"], ["ts", "id"], "v").withColumn("noise", r("noise"))


@query("""{obs}, d AS (SELECT k, v - 2 * lag(v, 1) OVER w + lag(v, 2) OVER w AS d2 FROM obs WHERE v BETWEEN 5 AND 100 WINDOW w AS (PARTITION BY k ORDER BY ts, id))
SELECT k, round(quantile_cont(abs(d2), 0.5) * 1.4826 / sqrt(6), 4) AS noise FROM d GROUP BY k""")
def optical_noise_filtered(spark, d):
    return robust.clear_noise(observations(spark, d), ["k"], ["ts", "id"], "v", F.col("v").between(5, 100)).withColumn("noise", r("noise"))


@query("""{obs}, d AS (SELECT k, abs(v - lag(v) OVER (PARTITION BY k ORDER BY ts, id)) AS d FROM obs)
SELECT k, round(quantile_cont(d, 0.5), 4) AS wobble FROM d GROUP BY k""")
def pass_wobble(spark, d):
    return robust.pass_wobble(observations(spark, d), ["k"], ["ts", "id"], "v").withColumn("wobble", r("wobble"))


SESSIONS_SQL = """{obs},
s AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch(ts) - epoch(lag(ts) OVER w) > 900 THEN 1 ELSE 0 END AS nw FROM obs WINDOW w AS (PARTITION BY track ORDER BY ts, id)),
t AS (SELECT *, sum(nw) OVER (PARTITION BY track ORDER BY ts, id ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM s)"""


@query(SESSIONS_SQL + " SELECT id, track, session FROM t")
def acquisition_sessions(spark, d):
    """Rows of a track no more than 15 minutes apart share a session."""
    return temporal.sessions(observations(spark, d), ["track"], "ts", "id", 900).select("id", "track", "session")


@query(SESSIONS_SQL + """, g AS (SELECT track, session, min(ts) AS first_ts, count(*) AS n, string_agg(DISTINCT k::VARCHAR, ';' ORDER BY k::VARCHAR) AS members FROM t GROUP BY ALL),
h AS (SELECT *, row_number() OVER (PARTITION BY track, first_ts::DATE ORDER BY first_ts, session) AS nth FROM g)
SELECT track, session, members, n, track || '_' || strftime(first_ts, '%Y%m%d') || CASE WHEN nth > 1 THEN '_' || nth ELSE '' END AS acquisition FROM h""")
def acquisition_rollup(spark, d):
    got = temporal.sessions(observations(spark, d), ["track"], "ts", "id", 900)
    return temporal.session_summary(got, ["track"], "ts", "k").select("track", "session", "members", "n", "acquisition")


@query("""{obs}, g AS (SELECT *, day - lag(day) OVER (PARTITION BY track ORDER BY day) AS gap FROM (SELECT DISTINCT track, day FROM obs)),
x AS (SELECT track, count(*) AS days, min(day) AS first_day, max(day) AS last_day, median(gap) AS median_gap, max(gap) AS max_gap FROM g GROUP BY track),
y AS (SELECT track, count(*) AS n, count(*) FILTER (v > 50) AS n_high, count(DISTINCT k) AS users FROM obs GROUP BY track)
SELECT track, days, first_day::INT AS first_day, last_day::INT AS last_day, round(median_gap, 4) AS median_gap, max_gap::INT AS max_gap, n, n_high, users FROM x JOIN y USING (track)""")
def track_summary(spark, d):
    obs = observations(spark, d)
    days = obs.select("track", "day").distinct().withColumn("gap", F.col("day") - F.lag("day").over(temporal.by(["track"], "day")))
    x = days.groupBy("track").agg(F.count("*").alias("days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), r(F.percentile("gap", F.lit(0.5))).alias("median_gap"), F.max("gap").alias("max_gap"))
    y = obs.groupBy("track").agg(F.count("*").alias("n"), F.count(F.when(F.col("v") > 50, 1)).alias("n_high"), F.countDistinct("k").alias("users"))
    return x.join(y, "track")


GAPS = """o AS (SELECT DISTINCT o_custkey, date_diff('day', DATE '1995-01-01', o_orderdate::DATE)::INT AS day FROM orders),
i AS (SELECT o_custkey, lag(day) OVER (PARTITION BY o_custkey ORDER BY day) AS gap_start, day AS gap_end FROM o),
e AS (SELECT * FROM i WHERE gap_start IS NOT NULL UNION ALL SELECT o_custkey, -60, min(day) FROM o GROUP BY 1 UNION ALL SELECT o_custkey, max(day), 2600 FROM o GROUP BY 1)"""


@query(f"WITH {GAPS} SELECT o_custkey, gap_start, gap_end, gap_end - gap_start AS gap_days FROM e WHERE gap_end - gap_start > 400")
def detect_gaps_edges(spark, d):
    """Stretches of over 400 days without an order, before the first and after the last one too."""
    orders = table(spark, d, "orders").withColumn("day", F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")))
    return temporal.gaps(orders, ["o_custkey"], "day", 400, -60, 2600)


@query("""{obs}, s AS (SELECT track, count(*) FILTER (v > 20) AS n_ok, count(DISTINCT day) AS days, round(max(v), 4) AS top FROM obs GROUP BY track)
SELECT *, row_number() OVER w AS rank, CASE WHEN row_number() OVER w = 1 THEN 'primary' WHEN n_ok >= 0.5 * first_value(n_ok) OVER w THEN 'secondary' ELSE 'unused' END AS role FROM s WINDOW w AS (ORDER BY n_ok DESC, days ASC, track ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def recommend_tracks(spark, d):
    s = observations(spark, d).groupBy("track").agg(F.count(F.when(F.col("v") > 20, 1)).alias("n_ok"), F.countDistinct("day").alias("days"), r(F.max("v")).alias("top"))
    w = W.orderBy(F.desc("n_ok"), F.asc("days"), "track")
    rank = F.row_number().over(w)
    role = F.when(rank == 1, "primary").when(F.col("n_ok") >= 0.5 * F.first("n_ok").over(w), "secondary").otherwise("unused")
    return s.withColumns({"rank": rank.cast("long"), "role": role})


SPINE = "spine AS (SELECT k, unnest(range(0, 30, 5))::INT AS win FROM (SELECT DISTINCT k FROM obs))"
COMPOSITE = f"""{SPINE},
b AS (SELECT k, (day // 5 * 5)::INT AS win, v, day, track, row_number() OVER (PARTITION BY k, day // 5 ORDER BY v DESC, day, id) AS rk FROM obs WHERE v < 150 AND day BETWEEN 0 AND 29),
comp AS (SELECT k, win, v, day, track FROM spine LEFT JOIN (SELECT * FROM b WHERE rk = 1) USING (k, win))"""


def _composite(spark, d):
    return temporal.composite(observations(spark, d), ["k"], "day", "v", F.col("v") < 150, 0, 30, 5, ("track",))


@query("{obs}, " + COMPOSITE + " SELECT k, win, v, day, track FROM comp")
def window5_composite(spark, d):
    """The greatest clear value of every five-day window, with its day and track; empty windows stay."""
    return _composite(spark, d)


SPARSE = f"""{SPINE}, m AS (SELECT k, (day // 5 * 5)::INT AS win, max(v) AS y FROM obs WHERE v > 60 GROUP BY ALL),
f AS (SELECT k, win, y FROM spine LEFT JOIN m USING (k, win)),
n AS (SELECT *, last_value(CASE WHEN y IS NOT NULL THEN win END IGNORE NULLS) OVER b AS bi, first_value(CASE WHEN y IS NOT NULL THEN win END IGNORE NULLS) OVER a AS ai, last_value(y IGNORE NULLS) OVER b AS bv, first_value(y IGNORE NULLS) OVER a AS av FROM f WINDOW b AS (PARTITION BY k ORDER BY win ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY k ORDER BY win ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def _sparse(spark, d):
    obs = observations(spark, d)
    top = obs.where("v > 60 and day between 0 and 29").groupBy("k", (F.floor(F.col("day") / 5) * 5).cast("int").alias("win")).agg(F.max("v").alias("y"))
    return temporal.window_spine(obs.select("k").distinct(), 0, 30, 5).join(top, ["k", "win"], "left")


@query("{obs}, " + SPARSE + " SELECT k, win, coalesce(least(win - bi, ai - win), 30)::INT AS gap_days FROM n")
def gap_days(spark, d):
    """Days from each window to the nearest seen one."""
    s = _sparse(spark, d)
    return s.withColumn("gap_days", temporal.gap_days(s, ["k"], "win", F.col("y").isNotNull(), 1)).withColumn("gap_days", F.when(F.max("y").over(W.partitionBy("k")).isNull(), 30).otherwise(F.col("gap_days"))).select("k", "win", "gap_days")


@query("{obs}, " + SPARSE + " SELECT k, win, round(coalesce(y, CASE WHEN ai > bi THEN bv + (av - bv) * (win - bi) / (ai - bi) END, av, bv), 4) AS filled FROM n")
def hold_edges_fill(spark, d):
    """Linear between seen windows, held flat beyond them."""
    return temporal.fill_linear(_sparse(spark, d), ["k"], "win", "y", "filled").select("k", "win", r("filled").alias("filled"))


@query("{obs}, " + SPARSE + " SELECT k, win, round(coalesce(y, CASE WHEN ai > bi AND ai - bi <= 10 THEN bv + (av - bv) * (win - bi) / (ai - bi) END), 4) AS filled FROM n")
def regrid_short_gaps(spark, d):
    """Linear inside gaps of at most ten days, empty elsewhere."""
    return temporal.fill_linear(_sparse(spark, d), ["k"], "win", "y", "filled", longest=10, hold=False).select("k", "win", r("filled").alias("filled"))


@query("{obs}, " + SPARSE + " SELECT k, win, round(coalesce(bv, av), 4) AS filled FROM n")
def fill_forward_back(spark, d):
    return temporal.fill_previous(_sparse(spark, d), ["k"], "win", "y", "filled").select("k", "win", r("filled").alias("filled"))


@query("""{obs}, m AS (SELECT k, day, avg(v) AS y FROM obs WHERE track = 'view' GROUP BY ALL), g AS (SELECT k, unnest(range(0, 30))::INT AS day FROM (SELECT DISTINCT k FROM m)),
n AS (SELECT k, day, y, last_value(CASE WHEN y IS NOT NULL THEN day END IGNORE NULLS) OVER b AS bi, first_value(CASE WHEN y IS NOT NULL THEN day END IGNORE NULLS) OVER a AS ai, last_value(y IGNORE NULLS) OVER b AS bv, first_value(y IGNORE NULLS) OVER a AS av FROM g LEFT JOIN m USING (k, day) WINDOW b AS (PARTITION BY k ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY k ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT k, day, round(coalesce(y, CASE WHEN ai > bi THEN bv + (av - bv) * (day - bi) / (ai - bi) END, av, bv) + 1e-7, 4) AS y FROM n""")
def lerp_resample(spark, d):
    """Daily means of one track on a daily grid, linear between them."""
    m = observations(spark, d).where("track = 'view'").groupBy("k", "day").agg(F.avg("v").alias("y0"))
    grid = temporal.window_spine(m.select("k").distinct(), 0, 30, 1).withColumnRenamed("win", "day")
    return temporal.fill_linear(grid.join(m, ["k", "day"], "left"), ["k"], "day", "y0", "y").select("k", "day", r(F.col("y") + 1e-7).alias("y"))


@query("""{obs} SELECT k, (year(ts) * 1000 + month(ts) * 10 + CASE WHEN day(ts) > 15 THEN 1 ELSE 0 END)::INT AS bin, round(10 * log10(avg(power(10.0, (v / 20) / 10))), 4) AS mean_db, count(v) AS n FROM (SELECT k, ts, v FROM obs) GROUP BY ALL""")
def half_month_mean_linear(spark, d):
    obs = observations(spark, d).withColumn("db", F.col("v") / 20)
    return aggregate.bin_means_db(obs, ["k"], c.half_month(F.col("ts")), "db").withColumn("mean_db", r("mean_db"))


@query("""{obs}, b AS (SELECT k, track, day // 3 AS bin, avg(v) AS m FROM obs WHERE track IN ('view', 'click') GROUP BY ALL),
j AS (SELECT a.k, a.m AS x, b.m AS y FROM b a JOIN b ON a.k = b.k AND a.bin = b.bin AND a.track = 'view' AND b.track = 'click')
SELECT k, round(CASE WHEN count(*) >= 3 AND var_pop(x) > 1e-12 AND var_pop(y) > 1e-12 THEN corr(x, y) END, 4) AS corr, count(*) AS bins FROM j GROUP BY k""")
def track_correlation(spark, d):
    """Pearson's correlation of two tracks over the bins both have."""
    b = observations(spark, d).where(F.col("track").isin("view", "click")).groupBy("k", F.floor(F.col("day") / 3).alias("bin")).agg(F.avg(F.when(F.col("track") == "view", F.col("v"))).alias("x"), F.avg(F.when(F.col("track") == "click", F.col("v"))).alias("y"))
    return b.where("x is not null and y is not null").groupBy("k").agg(r(robust.guarded_corr("x", "y", 3)).alias("corr"), F.count("*").alias("bins"))


@query("""{obs}, a AS (SELECT k, id, day, v FROM obs WHERE track = 'view'), b AS (SELECT k, day, v FROM obs WHERE track = 'click'),
p AS (SELECT a.k, a.id, a.v - b.v AS off, row_number() OVER (PARTITION BY a.k, a.id ORDER BY abs(b.day - a.day), b.day, b.v) AS rk FROM a JOIN b ON a.k = b.k AND abs(a.day - b.day) <= 3)
SELECT k, round(quantile_cont(off, 0.5), 4) AS "offset", count(*) AS pairs FROM p WHERE rk = 1 GROUP BY k""")
def pair_offsets(spark, d):
    """Median difference between a track's values and their nearest partners within three days."""
    obs = observations(spark, d)
    pairs = temporal.nearest(obs.where("track = 'view'"), obs.where("track = 'click'"), ["k"], "day", 3, "id", ["v"])
    return pairs.groupBy("k").agg(r(F.percentile(F.col("v") - F.col("other_v"), F.lit(0.5))).alias("offset"), F.count("*").alias("pairs"))


@query("""{obs} SELECT id, round(quantile_cont(v, 0.5) OVER (PARTITION BY k, track ORDER BY day RANGE BETWEEN 10 PRECEDING AND 3 PRECEDING) - v, 4) AS drop FROM obs""")
def local_drop(spark, d):
    """How far each value lies below the median of the same series three to ten days earlier."""
    return observations(spark, d).select("id", r(temporal.local_drop(KT, "day", "v", 10, 3)).alias("drop"))


@query("""{obs}, x AS (SELECT id, k, day, quantile_cont(v, 0.5) OVER (PARTITION BY k ORDER BY day RANGE BETWEEN 10 PRECEDING AND 3 PRECEDING) - v AS drop FROM obs),
a AS (SELECT k, min(day) AS anchor FROM obs WHERE track = 'error' GROUP BY k),
y AS (SELECT x.*, anchor FROM x JOIN a USING (k) WHERE x.day BETWEEN anchor AND anchor + 14 AND drop IS NOT NULL)
SELECT k, anchor::INT AS anchor, round(max(drop), 4) AS best_drop, first(day ORDER BY round(drop, 9) DESC, day)::INT AS best_day, count(*) FILTER (drop >= 5) AS persistence FROM y GROUP BY k, anchor""")
def flood_search(spark, d):
    """The deepest local drop in the two weeks after each key's first error, and how many drops persist."""
    obs = observations(spark, d).withColumn("drop", temporal.local_drop(["k"], "day", "v", 10, 3))
    anchor = F.min(F.when(F.col("track") == "error", F.col("day"))).over(W.partitionBy("k"))
    span = obs.withColumn("anchor", anchor).where("day between anchor and anchor + 14 and drop is not null")
    return span.groupBy("k", "anchor").agg(r(F.max("drop")).alias("best_drop"), F.max_by(F.col("day"), F.struct(F.round("drop", 9), -F.col("day"))).alias("best_day"), F.count(F.when(F.col("drop") >= 5, 1)).alias("persistence"))


@query("""{obs}, m AS (SELECT k, first(day ORDER BY v, day, id) AS min_day, min(v) AS v_min, max(v) - min(v) AS v_range FROM obs GROUP BY k),
a AS (SELECT o.k, max(o.v) AS max_after, first(o.day ORDER BY o.v DESC, o.day) AS max_day FROM obs o JOIN m ON o.k = m.k AND o.day >= m.min_day GROUP BY o.k)
SELECT k, round(v_min, 4) AS v_min, min_day::INT AS min_day, round(max_after, 4) AS max_after, max_day::INT AS max_day, round(v_range, 4) AS v_range FROM m JOIN a USING (k)""")
def season_summary(spark, d):
    s = temporal.season_summary(observations(spark, d), ["k"], "day", "v", "id")
    return s.select("k", r("v_min").alias("v_min"), "min_day", r("max_after").alias("max_after"), "max_day", r("v_range").alias("v_range"))


@query("""{obs}, e AS (SELECT k, min(day) AS ev FROM obs WHERE track = 'purchase' GROUP BY k), j AS (SELECT v, (round((day - ev) / 5.0) * 5)::INT AS rel FROM obs JOIN e USING (k))
SELECT rel, round(quantile_cont(v, 0.5), 4) AS mid, round(quantile_cont(v, 0.25), 4) AS low, round(quantile_cont(v, 0.75), 4) AS high, count(v) AS n FROM j WHERE rel BETWEEN -10 AND 25 GROUP BY rel""")
def event_aligned_curve(spark, d):
    """Quantile band by days since each key's first purchase."""
    obs = observations(spark, d)
    ev = obs.where("track = 'purchase'").groupBy("k").agg(F.min("day").alias("ev"))
    got = aggregate.quantile_band(temporal.aligned(obs, ev, ["k"], "day", "ev", -10, 25, 5), ["rel"], "v")
    return got.select("rel", *[r(x).alias(x) for x in ("mid", "low", "high")], "n")


@query("""{obs}, w AS (SELECT k, v, lead(v) OVER x AS nx, lead(1) OVER x AS has FROM obs WINDOW x AS (PARTITION BY k ORDER BY ts, id)),
s AS (SELECT k, list_sort(list(v)) AS l FROM obs GROUP BY k)
SELECT k, round(min(CASE WHEN has IS NOT NULL THEN greatest(v, nx) END), 4) AS sustained_low, round(any_value(CASE WHEN len(l) >= 2 THEN l[2] END), 4) AS second_low, round(any_value(CASE WHEN len(l) >= 4 THEN l[len(l) - 1] - l[2] END), 4) AS swing FROM w JOIN s USING (k) GROUP BY k""")
def lows_and_swing(spark, d):
    """The low held twice running, the second lowest value, and the distance between the second extremes."""
    obs = observations(spark, d)
    both = robust.sustained_low(obs, ["k"], ["ts", "id"], "v").join(robust.extremes(obs, ["k"], "v"), "k")
    return both.select("k", *[r(x).alias(x) for x in ("sustained_low", "second_low", "swing")])


DAILY = "m AS (SELECT k, day, avg(v) AS y FROM obs GROUP BY ALL)"


@query("{obs}, " + DAILY + """, t AS (SELECT k, day, y, lag(y) OVER w AS p, lead(y) OVER w AS n, max(y) OVER (PARTITION BY k ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM m WINDOW w AS (PARTITION BY k ORDER BY day))
SELECT k, day, round(y, 4) AS y FROM t WHERE (p IS NULL OR y <= p) AND y < n AND later >= y + 40""")
def troughs(spark, d):
    m = observations(spark, d).groupBy("k", "day").agg(c.steady_mean("v").alias("y"))
    return m.withColumn("t", temporal.troughs(["k"], "day", "y", F.lit(40.0))).where("t").select("k", "day", r("y").alias("y"))


@query("{obs}, " + DAILY + """, n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY day) AS a, row_number() OVER (PARTITION BY k, y <= 45 ORDER BY day) AS b FROM m)
SELECT k, min(day)::INT AS first, max(day)::INT AS last, count(*) AS length FROM n WHERE y <= 45 GROUP BY k, a - b HAVING count(*) >= 2""")
def low_runs(spark, d):
    """Runs of two or more consecutive low days."""
    m = observations(spark, d).groupBy("k", "day").agg(F.avg("v").alias("y"))
    return temporal.runs(m, ["k"], "day", F.col("y") <= 45).where("length >= 2")


@query("{obs}, " + DAILY + """, x AS (SELECT *, max(y) OVER (PARTITION BY k ORDER BY day) AS before, max(y) OVER (PARTITION BY k ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after, max(y) OVER (PARTITION BY k) - min(y) OVER (PARTITION BY k) AS span FROM m)
SELECT k, max(day)::INT AS crop_start FROM x WHERE before - y >= 0.5 * span AND after - y >= 0.5 * span GROUP BY k""")
def last_crop_start(spark, d):
    """The last day that lies half the range below both an earlier and a later top."""
    m = observations(spark, d).groupBy("k", "day").agg(F.avg("v").alias("y"))
    w = temporal.by(["k"], "day")
    whole = W.partitionBy("k")
    x = m.withColumns({"before": F.max("y").over(w), "after": F.max("y").over(w.rowsBetween(0, W.unboundedFollowing)), "span": F.max("y").over(whole) - F.min("y").over(whole)})
    return x.where((F.col("before") - F.col("y") >= 0.5 * F.col("span")) & (F.col("after") - F.col("y") >= 0.5 * F.col("span"))).groupBy("k").agg(F.max("day").alias("crop_start"))


@query("{obs} SELECT id, count(*) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS neighbours FROM obs")
def temporal_neighbors(spark, d):
    return observations(spark, d).select("id", temporal.neighbour_count(["k"], ["ts", "id"], 3).alias("neighbours"))


@query("""{obs}, s AS (SELECT *, avg(v) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS sm FROM obs)
SELECT id, round(sm * avg(v / sm) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 4) AS filtered FROM s WHERE sm > 0""")
def quegan_filter(spark, d):
    """Multi-date speckle filter: the local mean times the neighbours' mean ratio."""
    obs = observations(spark, d).withColumn("sm", F.avg("v").over(temporal.by(["k"], "ts", "id").rowsBetween(-2, 2))).where("sm > 0")
    return obs.select("id", r(temporal.speckle_mean(["k"], ["ts", "id"], "v", "sm", 3)).alias("filtered"))


@query("""{obs}, x AS (SELECT k, id, epoch(ts) / 3600.0 - 473352.0 AS t FROM obs WHERE track = 'view')
SELECT id, round(greatest(0.0, least(t + 1.5, 100.0) - greatest(t, 76.0)) / 1.5, 4) AS share, (ceil(t / 0.5) - floor((t - 6) / 0.5))::INT AS steps FROM x""")
def rain_overlap(spark, d):
    """Share of each interval that lies in a day-long window, and the half-hour steps of the six hours before it."""
    t = F.timestamp_diff("MICROSECOND", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")) / 1e6 / 3600.0
    obs = observations(spark, d).where("track = 'view'").withColumn("t", t)
    return obs.select("id", r(c.overlap_share(F.col("t"), F.col("t") + 1.5, F.lit(76.0), F.lit(100.0))).alias("share"), c.steps_touched(F.col("t"), 6, 0.5).alias("steps"))


@query("""{obs}, a AS (SELECT id, k, ts FROM obs WHERE track = 'click'), b AS (SELECT k, ts, v FROM obs WHERE track = 'view')
SELECT a.id, round(b.v, 4) AS last_view FROM a ASOF LEFT JOIN b ON a.k = b.k AND a.ts >= b.ts""")
def asof_last_view(spark, d):
    """The last view's value at or before every click of the same key."""
    obs = observations(spark, d)
    got = temporal.asof(obs.where("track = 'click'").select("id", "k", "ts"), obs.where("track = 'view'").select("k", "ts", "v"), ["k"], "ts", "v", "last_view")
    return got.select("id", r("last_view").alias("last_view"))


@query("""{obs}, p AS (SELECT k, id, epoch(ts) - 1704067200 AS t FROM obs WHERE track = 'signup'), q AS (SELECT *, coalesce(lead(t) OVER w, t * 2 - lag(t) OVER w) AS u FROM p WINDOW w AS (PARTITION BY k ORDER BY t, id)),
z AS (SELECT k, epoch(ts) - 1704067200 AS t FROM obs WHERE track = 'error')
SELECT q.id, count(z.t) AS points FROM q LEFT JOIN z ON q.k = z.k AND z.t >= q.t AND z.t < q.u GROUP BY q.id""")
def errors_between_signups(spark, d):
    """How many errors fall between each signup and the next of the same key."""
    t = F.timestamp_diff("MICROSECOND", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")) / 1e6
    obs = observations(spark, d).withColumn("t", t)
    return temporal.interval_hits(obs.where("track = 'signup'"), obs.where("track = 'error'"), ["k"], "t", "id").select("id", "points")


@query("{obs} SELECT k, track, round(avg(v), 4) AS end_mean, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY k, track ORDER BY ts DESC, id DESC) AS b FROM obs) WHERE b <= 3 GROUP BY ALL")
def last_three_mean(spark, d):
    return temporal.last_k(observations(spark, d), KT, ["ts", "id"], 3).groupBy(*KT).agg(r(F.avg("v")).alias("end_mean"), F.count("*").alias("n"))


@query("""{obs} SELECT k, round(min(v), 4) AS v_min, round(max(v), 4) AS v_max, round(max(v) - min(v), 4) AS amplitude, round(var_pop(v), 4) AS variance, first(day ORDER BY v, day, id)::INT AS argmin, count(v) AS n FROM obs GROUP BY k""")
def seasonal_features(spark, d):
    s = aggregate.seasonal_features(observations(spark, d), ["k"], "day", "v", "id")
    return s.select("k", *[r(x).alias(x) for x in ("v_min", "v_max", "amplitude", "variance")], "argmin", "n")


@query("""{obs}, m AS (SELECT track, day, quantile_cont(v, 0.5) AS y FROM obs GROUP BY ALL), x AS (SELECT *, list(y) OVER (PARTITION BY track ORDER BY day ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING EXCLUDE CURRENT ROW) AS near FROM m)
SELECT track, day, round(y - list_aggregate(near, 'median'), 4) AS jump FROM x WHERE abs(y - list_aggregate(near, 'median')) > 4""")
def date_anomalies(spark, d):
    """Days whose median jumps from the median of the two days either side."""
    m = observations(spark, d).groupBy("track", "day").agg(F.percentile("v", F.lit(0.5)).alias("y"))
    w = temporal.by(["track"], "day")
    near = F.array_sort(F.filter(F.array(*[F.lag("y", i).over(w) for i in (2, 1, -1, -2)]), lambda x: x.isNotNull()))
    x = m.withColumn("near", near)
    n = F.size("near")
    mid = (F.get("near", F.floor((n - 1) / 2).cast("int")) + F.get("near", F.floor(n / 2).cast("int"))) / 2
    return x.withColumn("jump", F.col("y") - mid).where(F.abs("jump") > 4).select("track", "day", r("jump").alias("jump"))


@query("""{obs}, t AS (SELECT k, track, date_diff('day', DATE '2024-01-01', ts::DATE) AS day, v, CASE WHEN v > 30 THEN 'dry' ELSE 'wet' END AS state FROM obs), b AS (SELECT *, day // 7 AS bin, max(CASE WHEN state = 'dry' THEN 1 ELSE 0 END) OVER (PARTITION BY k, day // 7) AS has_dry FROM t)
SELECT k, bin::BIGINT AS bin, count(*) AS used, max(state) AS state FROM b WHERE (has_dry = 1 AND state = 'dry') OR has_dry = 0 GROUP BY ALL""")
def plan_bins_dry_first(spark, d):
    """Rows used in each weekly bin: the dry ones, the wet ones only where no dry one is."""
    obs = observations(spark, d).withColumn("bin", F.floor(F.col("day") / 7)).withColumn("state", F.when(F.col("v") > 30, "dry").otherwise("wet"))
    dry = F.max((F.col("state") == "dry").cast("int")).over(W.partitionBy("k", "bin"))
    return obs.withColumn("has_dry", dry).where((F.col("has_dry") == 0) | (F.col("state") == "dry")).groupBy("k", "bin").agg(F.count("*").alias("used"), F.max("state").alias("state"))


@query("""{obs}, x AS (SELECT k, track, day, v, row_number() OVER (PARTITION BY k, track ORDER BY ts DESC, id DESC) AS b FROM obs), e AS (SELECT k, track, quantile_cont(v, 0.5) FILTER (b <= 3) AS late, quantile_cont(v, 0.5) FILTER (b > 3) AS early, count(*) FILTER (b <= 3) AS n FROM x GROUP BY ALL),
d2 AS (SELECT k, track, v - 2 * lag(v, 1) OVER w + lag(v, 2) OVER w AS d FROM obs WINDOW w AS (PARTITION BY k, track ORDER BY ts, id)), nz AS (SELECT k, track, quantile_cont(abs(d), 0.5) * 1.4826 / sqrt(6) AS noise FROM d2 GROUP BY ALL),
z AS (SELECT k, (late - early) / (noise * sqrt(1 + 1.0 / n)) AS z FROM e JOIN nz USING (k, track) WHERE noise > 0 AND early IS NOT NULL)
SELECT k, round(sum(z) / sqrt(count(*)), 4) AS rise, count(*) AS tracks FROM z GROUP BY k""")
def rise_since(spark, d):
    """The median of a track's last three values over that of the rest, in its own noise, summed over tracks."""
    obs = observations(spark, d)
    b = obs.withColumn("b", F.row_number().over(W.partitionBy(*KT).orderBy(F.desc("ts"), F.desc("id"))))
    e = b.groupBy(*KT).agg(F.percentile(F.when(F.col("b") <= 3, F.col("v")), F.lit(0.5)).alias("late"), F.percentile(F.when(F.col("b") > 3, F.col("v")), F.lit(0.5)).alias("early"), F.count(F.when(F.col("b") <= 3, 1)).alias("n"))
    z = e.join(robust.pass_noise(obs, KT, ["ts", "id"], "v"), KT).where("noise > 0 and early is not null").withColumn("z", (F.col("late") - F.col("early")) / (F.col("noise") * F.sqrt(1 + 1.0 / F.col("n"))))
    return z.groupBy("k").agg(r(F.sum("z") / F.sqrt(F.count("*"))).alias("rise"), F.count("*").alias("tracks"))


@query("""{obs}, x AS (SELECT id, k, v, quantile_cont(v, 0.5) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS before, count(v) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS n FROM obs)
SELECT id, k, round(before - v, 4) AS fall FROM x WHERE n = 3 AND before - v >= 60""")
def radar_events(spark, d):
    """Values that fall far below the median of the three before them."""
    w = temporal.by(["k"], "ts", "id").rowsBetween(-3, -1)
    x = observations(spark, d).withColumns({"before": F.percentile("v", F.lit(0.5)).over(w), "n": F.count("v").over(w)})
    return x.where("n = 3 and before - v >= 60").select("id", "k", r(F.col("before") - F.col("v")).alias("fall"))
