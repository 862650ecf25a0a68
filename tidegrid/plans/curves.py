"""Queries over arrays, grids and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, grid, smooth, temporal, vectors
from ..sources.scratch import scratch_root
from ..sources.tables import observations, table
from ..streaming import sessions as streams
from .registry import registry

QUERIES, ORACLE_SQL, query = registry()


def r(col, n=4):
    return F.round(col, n)


def _daily(spark, d):
    m = observations(spark, d).groupBy("k", "day").agg(F.avg("v").alias("y"))
    spine = temporal.window_spine(m.select("k").distinct(), 0, 30, 1).withColumnRenamed("win", "day")
    return smooth.as_array(spine.join(m, ["k", "day"], "left"), ["k"], "day", "y")


@query()
def whittaker_fit(spark, d):
    """Daily means of each key, smoothed."""
    return smooth.as_rows(_daily(spark, d).withColumn("z", smooth.whittaker(F.col("y"), 2.0)), ["k"], {"raw": "y", "fit": "z"}, "day").withColumn("fit", r("fit"))


@query()
def upper_envelope(spark, d):
    """A curve along the upper values of each key."""
    return smooth.as_rows(_daily(spark, d).withColumn("z", smooth.upper_envelope(F.col("y"), 2.0)), ["k"], {"raw": "y", "fit": "z"}, "day").withColumn("fit", r("fit"))


@query()
def choose_penalty(spark, d):
    """Error of values left out, by penalty; the smallest is the penalty to take."""
    return smooth.penalty_errors(_daily(spark, d), "y", [0.5, 2.0, 10.0, 50.0]).withColumn("error", r("error"))


@query()
def pixel_cycles(spark, d):
    """Growth cycles of each key's smoothed curve: one series, many rows."""
    fit = _daily(spark, d).select("k", smooth.whittaker(F.col("y"), 5.0).alias("z"))
    return fit.select("k", F.explode(smooth.cycles(F.col("z"))).alias("c")).select("k", "c.*").withColumns({x: r(x) for x in ("low", "high", "amplitude")})


@query("""WITH l AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), c AS (SELECT label, i, quantile_cont(x, 0.5) AS m FROM l GROUP BY ALL), g AS (SELECT label, list(m ORDER BY i) AS centre FROM c GROUP BY label),
s AS (SELECT vec_id, g.label, round(sqrt(list_sum(list_transform(range(1, len(embedding) + 1), lambda j: (embedding[j]::DOUBLE - centre[j]) * (embedding[j]::DOUBLE - centre[j])))), 6) AS dist FROM embeddings, g)
SELECT vec_id, first(label ORDER BY dist, label) AS pattern, min(dist) AS distance FROM s GROUP BY vec_id""")
def pattern_match(spark, d):
    """Each vector with the nearest class median."""
    e = table(spark, d, "embeddings")
    return vectors.nearest_pattern(e, vectors.centroids(e, "label", "embedding"), "vec_id", "embedding", "label")


@query("""WITH p AS (SELECT q.vec_id AS query, sqrt(list_sum(list_transform(range(1, len(q.embedding) + 1), lambda j: (q.embedding[j]::DOUBLE - e.embedding[j]) * (q.embedding[j]::DOUBLE - e.embedding[j])))) AS d FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0 AND e.vec_id <> q.vec_id)
SELECT query, round(d, 4) AS d FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY d) AS rk FROM p) WHERE rk = 10""")
def knn_distance(spark, d):
    """Distance of every fiftieth vector to its tenth nearest other one."""
    e = table(spark, d, "embeddings")
    return vectors.kth_distance(e.where("vec_id % 50 = 0"), e, "vec_id", "embedding", 10).select("query", r("d").alias("d"))


@query()
def kmeans_curves(spark, d):
    return evaluate.cluster(table(spark, d, "embeddings"), "embedding", 5).groupBy("cluster").agg(F.count("*").alias("n"))


@query()
def curve_segments(spark, d):
    """Peaks of each smoothed series by prominence, each with the floor before it; held against brute force in the tests."""
    fit = _daily(spark, d).select("k", smooth.whittaker(F.col("y"), 5.0).alias("z"))
    return fit.select("k", F.explode(smooth.segments(F.col("z"), 0.3, 0.1)).alias("c")).select("k", "c.start", "c.peak", r("c.rise").alias("rise"))


CELLS = "cells AS (SELECT (o_orderkey // 100)::INT AS \"row\", (o_orderkey % 100)::INT AS col, o_totalprice AS v, CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS cls FROM orders)"


def _cells(spark, d):
    return table(spark, d, "orders").select(F.floor(F.col("o_orderkey") / 100).cast("int").alias("row"), (F.col("o_orderkey") % 100).cast("int").alias("col"), F.col("o_totalprice").alias("v"), F.when(F.col("o_totalprice") > 150000, 1).otherwise(0).alias("cls"))


@query(f"WITH {CELLS} SELECT a.\"row\", a.col, round(CASE WHEN count(b.v) >= 12.5 THEN avg(b.v) + 1e-6 END, 2) AS box_mean FROM (SELECT *, unnest(range(-2, 3)) AS dr FROM cells) a CROSS JOIN (SELECT unnest(range(-2, 3)) AS dc) x LEFT JOIN cells b ON b.\"row\" = a.\"row\" + dr AND b.col = a.col + dc GROUP BY ALL")
def box_mean(spark, d):
    """Mean of the 5 x 5 box around each cell where half of it is known."""
    return grid.box_mean(_cells(spark, d), [], "v", 5, 0.5).select("row", "col", r(F.col("box_mean") + 1e-6, 2).alias("box_mean"))


@query(f"WITH {CELLS} SELECT a.\"row\", a.col, round(avg(CASE WHEN a.cls = b.cls THEN 1 ELSE 0 END), 6) AS same_share FROM (SELECT *, unnest(range(-1, 2)) AS dr FROM cells) a CROSS JOIN (SELECT unnest(range(-1, 2)) AS dc) x JOIN cells b ON b.\"row\" = a.\"row\" + dr AND b.col = a.col + dc GROUP BY ALL")
def same_class_share(spark, d):
    return grid.same_share(_cells(spark, d), [], "cls", 3).select("row", "col", r("same_share", 6).alias("same_share"))


@query(f"WITH {CELLS} SELECT a.\"row\", a.col FROM cells a CROSS JOIN (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) AS x(dr, dc) JOIN cells b ON a.cls = b.cls AND b.\"row\" = a.\"row\" + dr AND b.col = a.col + dc GROUP BY ALL HAVING count(*) = 4")
def interior_pixels(spark, d):
    return grid.interior(_cells(spark, d), [], "cls").select("row", "col")


@query()
def connected_patches(spark, d):
    """Eight-connected patches of one class; no SQL, the recursion over large patches is too slow on the whole grid."""
    return grid.patches(_cells(spark, d), [], "cls").select("row", "col", "patch")


@query()
def sieve_small(spark, d):
    """Patches under four cells take the class of the largest patch they touch."""
    return grid.sieve(_cells(spark, d), [], "cls", 4).select("row", "col", "cls", "sieved")


@query("""WITH c AS (SELECT a::INT AS row_off, b::INT AS col_off, least(16, 50 - a)::INT AS height, least(16, 70 - b)::INT AS width FROM (SELECT unnest(range(0, 50, 16)) AS a), (SELECT unnest(range(0, 70, 16)) AS b)),
p AS (SELECT row_off + dr * ((height + 1) // 2) AS row_off, col_off + dc * ((width + 1) // 2) AS col_off, CASE WHEN dr = 0 THEN (height + 1) // 2 ELSE height - (height + 1) // 2 END AS height, CASE WHEN dc = 0 THEN (width + 1) // 2 ELSE width - (width + 1) // 2 END AS width, dr * 2 + dc AS part FROM c, (SELECT unnest([0, 1]) AS dr), (SELECT unnest([0, 1]) AS dc))
SELECT part::INT AS part, row_off::INT AS row_off, col_off::INT AS col_off, height::INT AS height, width::INT AS width FROM p WHERE height > 0 AND width > 0""")
def grid_split(spark, d):
    """Chunks of a 50 x 70 grid, each cut into up to four parts."""
    return grid.split_chunk(grid.grid_chunks(70, 50, 16, spark)).select(*[F.col(x).cast("int").alias(x) for x in ("part", "row_off", "col_off", "height", "width")])


def _events_stream(spark, d):
    return streams.stream_table(spark, f"{d}/events.parquet")


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS nw FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
t AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, nw DESC ROWS UNBOUNDED PRECEDING) AS s FROM s), g AS (SELECT user_id, s, count(*) AS n FROM t GROUP BY ALL)
SELECT user_id, count(*) AS sessions, max(n) AS longest FROM g GROUP BY user_id""")
def stream_sessions(spark, d):
    """Sessions by a six-hour gap, computed by a stream that reads what is there and stops."""
    got = streams.drain(streams.session_counts(_events_stream(spark, d), "user_id", "ts", "6 hours", "30 days"), spark, "complete", scratch_root(spark))
    return got.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))


@query("SELECT user_id, count(*) AS windows, round(max(best), 4) AS best, sum(n)::BIGINT AS n FROM (SELECT user_id, epoch(ts)::BIGINT // 432000 AS w, max(value) AS best, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id")
def stream_windows(spark, d):
    """Greatest value of five-day tumbling windows, computed by a stream."""
    got = streams.drain(streams.window_best(_events_stream(spark, d), "user_id", "ts", "value", "5 days", "30 days"), spark, "complete", scratch_root(spark))
    return got.groupBy("user_id").agg(F.count("*").alias("windows"), r(F.max("best")).alias("best"), F.sum("n").alias("n"))
