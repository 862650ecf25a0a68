"""Simple polygons as rings, arrays of (x, y) structs with the first point repeated: tests, bridges, cuts and overlaps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RING = "array<struct<x:double,y:double>>"


def bounds(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def inside(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point lies in the ring, by counting the edges that a ray to the right crosses."""

    def crosses(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, i + 1)
        at = a["x"] + F.try_divide((y - a["y"]) * (b["x"] - a["x"]), b["y"] - a["y"])
        return F.when(((a["y"] > y) != (b["y"] > y)) & (x < at), 1).otherwise(0)

    n = F.aggregate(F.transform(F.sequence(F.lit(0), F.size(ring) - 2), crosses), F.lit(0), lambda s, v: s + v)
    return n % 2 == 1


def cells_of(polygons: DataFrame, key: str, ring: str, size: float) -> DataFrame:
    """(key, row, col): the grid cells whose centre lies in each polygon, from the cells of its bounding box only."""
    box = polygons.select(key, ring, bounds(F.col(ring)).alias("b"))
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / size).cast("int"), F.floor(F.col(hi) / size).cast("int"))
    cells = box.withColumn("row", F.explode(span("b.ymin", "b.ymax"))).withColumn("col", F.explode(span("b.xmin", "b.xmax")))
    return cells.where(inside(F.col(ring), (F.col("col") + 0.5) * size, (F.col("row") + 0.5) * size)).select(key, "row", "col")


def touching(a: DataFrame, b: DataFrame, a_key: str, b_key: str, ring: str, cell: float) -> DataFrame:
    """Pairs whose bounding boxes meet and the area they share.

    Boxes are spread over coarse cells and joined by cell, so no side is held against all of the other; a pair is kept
    in the cell that holds the lower corner of its overlap, once.
    """
    def spread(df: DataFrame, key: str, name: str) -> DataFrame:
        box = df.select(F.col(key).alias(name), bounds(F.col(ring)).alias(f"{name}_b"))
        span = lambda lo, hi: F.sequence(F.floor(F.col(f"{name}_b.{lo}") / cell), F.floor(F.col(f"{name}_b.{hi}") / cell))
        return box.withColumn("_i", F.explode(span("xmin", "xmax"))).withColumn("_j", F.explode(span("ymin", "ymax")))

    met = spread(a, a_key, "a").join(spread(b, b_key, "b"), ["_i", "_j"])
    x0, y0 = F.greatest("a_b.xmin", "b_b.xmin"), F.greatest("a_b.ymin", "b_b.ymin")
    w, h = F.least("a_b.xmax", "b_b.xmax") - x0, F.least("a_b.ymax", "b_b.ymax") - y0
    first = (F.floor(x0 / cell) == F.col("_i")) & (F.floor(y0 / cell) == F.col("_j"))
    return met.where((w >= 0) & (h >= 0) & first).select("a", "b", (w * h).alias("box_area"))


def half_plane(ring: Column, theta: Column, offset: Column, left: bool = True) -> Column:
    """The part of a ring on one side of the line x cos(theta) + y sin(theta) = offset; empty where nothing is left."""

    def cut(rings: pd.Series, thetas: pd.Series, offsets: pd.Series) -> pd.Series:
        out = []
        for pts, t, o in zip(rings, thetas, offsets, strict=True):
            p = np.array([(q["x"], q["y"]) for q in pts][:-1], float).reshape(-1, 2)
            d = p @ np.array([np.cos(t), np.sin(t)]) - o
            d = d if left else -d
            kept = []
            for i in range(len(p)):
                j = (i + 1) % len(p)
                if d[i] <= 0:
                    kept.append(p[i])
                if (d[i] < 0 < d[j]) or (d[j] < 0 < d[i]):
                    kept.append(p[i] + (p[j] - p[i]) * d[i] / (d[i] - d[j]))
            ring_ = [dict(x=float(q[0]), y=float(q[1])) for q in kept]
            out.append(ring_ + ring_[:1])
        return pd.Series(out)

    return F.pandas_udf(cut, RING)(ring, theta, offset)


def long_axis(ring: Column) -> Column:
    """Direction in degrees (0 to 180) of the longer side of the smallest rectangle around a ring."""

    def turn(rings: pd.Series) -> pd.Series:
        out = []
        for pts in rings:
            p = np.array([(q["x"], q["y"]) for q in pts], float)
            edges = np.diff(p, axis=0)
            angles = np.unique(np.mod(np.arctan2(edges[:, 1], edges[:, 0]), np.pi / 2))
            best = None
            for a in angles:
                r = p @ np.array([[np.cos(a), -np.sin(a)], [np.sin(a), np.cos(a)]])
                w, h = np.ptp(r, axis=0)
                if best is None or w * h < best[0] - 1e-12:
                    best = (w * h, a if w >= h else a + np.pi / 2)
            out.append(float(np.degrees(best[1]) % 180))
        return pd.Series(out)

    return F.pandas_udf(turn, "double")(ring)


def best_line(cells: DataFrame, keys: list[str], x: str, y: str, flag: Column, angles: int = 12, least: int = 4) -> DataFrame:
    """The straight cut of each key that puts most cells on the side of their majority: (angle, offset, purity).

    Every cell is projected on each of a few directions; cumulative counts along a direction give every cut's purity.
    """
    turned = cells.withColumn("_f", flag.cast("int")).withColumn("angle", F.explode(F.sequence(F.lit(0), F.lit(angles - 1))))
    t = F.col("angle") * F.pi() / angles
    along = turned.withColumn("p", F.round(F.col(x) * F.cos(t) + F.col(y) * F.sin(t), 6)).groupBy(*keys, "angle", "p").agg(F.count("*").alias("n"), F.sum("_f").alias("k"))
    up, whole = by_(keys + ["angle"], "p"), W.partitionBy(*keys, "angle")
    c = along.withColumns({"ln": F.sum("n").over(up), "lk": F.sum("k").over(up), "tn": F.sum("n").over(whole), "tk": F.sum("k").over(whole), "nx": F.lead("p").over(up)})
    right = F.greatest("lk", F.col("ln") - F.col("lk")) + F.greatest(F.col("tk") - F.col("lk"), F.col("tn") - F.col("ln") - F.col("tk") + F.col("lk"))
    c = c.withColumn("purity", F.round(right / F.col("tn"), 6)).where((F.col("ln") >= least) & (F.col("tn") - F.col("ln") >= least))
    best = c.groupBy(*keys).agg(F.min(F.struct((-F.col("purity")).alias("q"), "angle", "p", "nx")).alias("b"))
    return best.select(*keys, F.col("b.angle").alias("angle"), ((F.col("b.p") + F.col("b.nx")) / 2).alias("offset"), (-F.col("b.q")).alias("purity"))


def by_(keys: list[str], order: str):
    return W.partitionBy(*keys).orderBy(order)


def spread_pick(points: list[tuple], n: int, least_km: float) -> list:
    """Greedy choice on the driver over a small table of (key, weight, lon, lat): the heaviest first, each ``least_km`` apart; filled up with the heaviest left."""
    rest = sorted(points, key=lambda p: (-p[1], p[0]))
    taken: list[tuple] = []
    for p in rest:
        far = all(np.hypot((p[2] - q[2]) * 111 * np.cos(np.radians(p[3])), (p[3] - q[3]) * 111) >= least_km for q in taken)
        if len(taken) < n and far:
            taken.append(p)
    taken += [p for p in rest if p not in taken][: n - len(taken)]
    return [p[0] for p in taken]
