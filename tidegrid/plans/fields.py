"""Queries of the class rules and of polygons on the grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classes, geometry, grid
from ..sources.tables import observations, table
from .registry import registry

QUERIES, ORACLE_SQL, query = registry()


def r(col, n=4):
    return F.round(col, n)


SEASON = """w AS (SELECT k, (day // 3)::INT AS idx, avg(v) / 100 AS y FROM obs GROUP BY ALL),
a AS (SELECT *, max(y) OVER (PARTITION BY k ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ahead FROM w),
t AS (SELECT k, first(y ORDER BY y, idx DESC) AS trough, first(idx ORDER BY y, idx DESC) AS trough_at, first(ahead ORDER BY y, idx DESC) AS peak_after FROM a WHERE idx >= 2 AND ahead IS NOT NULL GROUP BY k),
l AS (SELECT k, first(y ORDER BY idx DESC) AS last FROM w GROUP BY k),
e AS (SELECT k, trough, trough_at, peak_after, peak_after - trough AS rise, last, last >= peak_after - 0.5 * (peak_after - trough) AS standing FROM l LEFT JOIN t USING (k)),
z AS (SELECT k, bool_or(v < 2) AS wet FROM obs WHERE track = 'view' GROUP BY k)"""


def _season(spark, d):
    obs = observations(spark, d)
    w = obs.groupBy("k", F.floor(F.col("day") / 3).cast("int").alias("idx")).agg((F.avg("v") / 100).alias("y"))
    wet = obs.where("track = 'view'").groupBy("k").agg(F.bool_or(F.col("v") < 2).alias("wet"))
    return classes.season_events(w, ["k"], "idx", "y", 2).join(wet, "k", "left")


@query("{obs}, " + SEASON + " SELECT k, round(trough + 1e-7, 4) AS trough, trough_at, round(peak_after + 1e-7, 4) AS peak_after, round(rise + 1e-7, 4) AS rise, round(last + 1e-7, 4) AS last, standing FROM e")
def season_events(spark, d):
    """Trough, climb and what is left of it in each key's three-day means."""
    e = _season(spark, d)
    up = lambda c: r(F.col(c) + 1e-7).alias(c)
    return e.select("k", up("trough"), "trough_at", up("peak_after"), up("rise"), up("last"), "standing")


@query("{obs}, " + SEASON + """, f AS (SELECT k, coalesce(wet, false) AS wet, coalesce(standing, false) AS standing, last, coalesce(trough <= 0.4, false) AS low, coalesce(trough <= 0.4 AND rise >= 0.3 AND peak_after >= 0.5, false) AS grown, coalesce(trough <= 0.4 AND rise >= 0.15 AND peak_after >= 0.3, false) AS any_climb FROM e LEFT JOIN z USING (k)),
g AS (SELECT *, any_climb AND NOT grown AS young FROM f)
SELECT k, (CASE WHEN NOT grown AND NOT young AND wet AND low THEN 7 WHEN young AND wet AND last >= 0.3 THEN 6 WHEN young THEN 2 WHEN grown AND NOT standing AND wet THEN 4 WHEN grown AND NOT standing THEN 8 WHEN grown AND wet THEN 1 WHEN grown THEN 3 ELSE 0 END)::INT AS class FROM g""")
def season_class(spark, d):
    return _season(spark, d).select("k", classes.season_class(F.col("wet")).alias("class"))


def _fields(spark, d):
    """A rectangle for each supplier, its corner and sides from the key."""
    k = F.col("s_suppkey")
    x, y, w, h = (k * 7) % 90 * 1.0, (k * 13) % 70 * 1.0, 3.0 + k % 5, 2.0 + k % 7
    at = lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))
    return table(spark, d, "supplier").select(k.alias("f"), F.array(at(x, y), at(x + w, y), at(x + w, y + h), at(x, y + h), at(x, y)).alias("ring"))


RECT = "fields AS (SELECT s_suppkey AS f, (s_suppkey * 7) % 90 AS x, (s_suppkey * 13) % 70 AS y, 3 + s_suppkey % 5 AS w, 2 + s_suppkey % 7 AS h FROM supplier)"


@query(f"WITH {RECT} SELECT f, c.c::INT AS col, r.r::INT AS \"row\" FROM fields, (SELECT unnest(range(0, 100)) AS c) c, (SELECT unnest(range(0, 80)) AS r) r WHERE c + 0.5 > x AND c + 0.5 < x + w AND r + 0.5 > y AND r + 0.5 < y + h")
def plot_pixels(spark, d):
    """The grid cells whose centre lies in each polygon."""
    return geometry.cells_of(_fields(spark, d), "f", "ring", 1.0)


@query(f"WITH {RECT} SELECT a.f AS a, b.f AS b, ((least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * (least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)))::DOUBLE AS box_area FROM fields a JOIN fields b ON a.f < b.f AND least(a.x + a.w, b.x + b.w) >= greatest(a.x, b.x) AND least(a.y + a.h, b.y + b.h) >= greatest(a.y, b.y)")
def overlapping_fields(spark, d):
    """Pairs of polygons whose boxes meet, and the area they share."""
    f = _fields(spark, d)
    return geometry.touching(f, f, "f", "f", "ring", 10.0).where("a < b")


@query(f"WITH {RECT} SELECT f, (w * h)::DOUBLE AS area, round(4 * pi() * w * h / power(2 * (w + h), 2), 6) AS compactness FROM fields")
def field_shapes(spark, d):
    """Area and compactness of each ring."""
    return _fields(spark, d).select("f", grid.ring_area(F.col("ring")).alias("area"), r(grid.ring_compactness(F.col("ring")), 6).alias("compactness"))


@query(f"WITH {RECT} SELECT f, round(w * h / 2.0, 4)::DOUBLE AS left, round(w * h / 2.0, 4)::DOUBLE AS right, CASE WHEN w >= h THEN 0.0 ELSE 90.0 END::DOUBLE AS axis FROM fields")
def field_halves(spark, d):
    """Each ring cut by the line through the middle of its box."""
    f = _fields(spark, d).withColumn("b", geometry.bounds(F.col("ring")))
    mid = (F.col("b.xmin") + F.col("b.xmax")) / 2
    cut = f.select("f", geometry.half_plane(F.col("ring"), F.lit(0.0), mid).alias("l"), geometry.half_plane(F.col("ring"), F.lit(0.0), mid, False).alias("r"), geometry.long_axis(F.col("ring")).alias("axis"))
    return cut.select("f", r(grid.ring_area(F.col("l"))).alias("left"), r(grid.ring_area(F.col("r"))).alias("right"), r("axis").alias("axis"))


@query()
def best_line_cut(spark, d):
    """The straight cut of each block of cells that separates its classes best."""
    cells = table(spark, d, "orders").select((F.col("o_orderkey") % 100).alias("col"), F.floor(F.col("o_orderkey") / 100).alias("row"), (F.col("o_totalprice") > 150000).alias("c")).withColumn("block", F.floor(F.col("row") / 10))
    return geometry.best_line(cells, ["block"], "col", "row", F.col("c"))
