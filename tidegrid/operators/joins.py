"""Joins of layers and tables: samples of grids, coverage of chunks, comparison of deliveries, orders by distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import written
from .vectors import require_few


def sample_grid(points: DataFrame, grid: DataFrame, x: str, y: str, x0: float, y0: float, size: float, value: str) -> DataFrame:
    """The value of the cell that holds each point; NULL outside: an equi-join on the computed row and column."""
    row, col = F.floor((F.lit(y0) - F.col(y)) / size).cast("int"), F.floor((F.col(x) - x0) / size).cast("int")
    return points.withColumns({"row": row, "col": col}).join(grid.select("row", "col", value), ["row", "col"], "left")


def sample_tiles(points: DataFrame, tiles: list[DataFrame], on: list[str], value: str) -> DataFrame:
    """The first tile with a value wins."""
    out = points
    for i, t in enumerate(tiles):
        out = out.join(t.select(*on, F.col(value).alias(f"_t{i}")), on, "left")
    return out.withColumn(value, F.coalesce(*[F.col(f"_t{i}") for i in range(len(tiles))])).drop(*[f"_t{i}" for i in range(len(tiles))])


def scatter(cells: DataFrame, values: DataFrame, on: list[str], value: str, missing: int) -> DataFrame:
    """Every cell of a grid with its value, or the code of missing ones."""
    return cells.join(values.select(*on, value), on, "left").withColumn(value, F.coalesce(value, F.lit(missing)))


def one_per_file(rows: DataFrame, path: Column, pattern: str) -> DataFrame:
    """Rows with the number in their file's name; a file with more than one row raises and is named."""
    out = rows.withColumn("_file", path)
    twice = out.groupBy("_file").count().where("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"more than one row: {[r['_file'] for r in twice]}")
    return out.withColumn("number", F.nullif(F.regexp_extract("_file", pattern, 1), F.lit("")).cast("int")).drop("_file")


def row_ids(df: DataFrame, order: list[str], name: str, parts: int = 64) -> DataFrame:
    """1, 2, … in a definite order, without one ordering task: numbers within ranges after the counts of those before."""
    # Written once: the ranges are drawn from a sample, and both uses must see the same ones.
    dealt = written(df.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()), "row-ids")
    counts = dealt.groupBy("_p").agg(F.count("*").alias("_n"))
    before = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    own = F.row_number().over(W.partitionBy("_p").orderBy(*order))
    return dealt.join(F.broadcast(offsets), "_p").withColumn(name, (F.col("_o") + own).cast("long")).drop("_p", "_o")


def rectangle_share(a: list[Column], b: list[Column]) -> Column:
    """Share of rectangle a (xmin, ymin, xmax, ymax) that lies in b."""
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    return w * h / ((a[2] - a[0]) * (a[3] - a[1]))


def touching(chunks: DataFrame, footprints: DataFrame, key: str, other: str, bucket: float) -> DataFrame:
    """(key, other, share) of rectangles that meet: both sides are dealt to square buckets, so the join is on equal buckets;
    a pair that meets in several is counted in the first bucket that both reach."""
    def cells(df: DataFrame, names: list[str]) -> DataFrame:
        out = df.select(*names, "xmin", "ymin", "xmax", "ymax")
        for axis in ("x", "y"):
            out = out.withColumn(f"_{axis}", F.explode(F.sequence(F.floor(F.col(f"{axis}min") / bucket), F.floor(F.col(f"{axis}max") / bucket))))
        return out

    a, b = cells(chunks, [key]).alias("a"), cells(footprints, [other]).alias("b")
    box = lambda s: [F.col(f"{s}.{c}") for c in ("xmin", "ymin", "xmax", "ymax")]
    met = a.join(b, (F.col("a._x") == F.col("b._x")) & (F.col("a._y") == F.col("b._y")))
    once = (F.col("a._x") == F.greatest(F.floor(F.col("a.xmin") / bucket), F.floor(F.col("b.xmin") / bucket))) & (F.col("a._y") == F.greatest(F.floor(F.col("a.ymin") / bucket), F.floor(F.col("b.ymin") / bucket)))
    out = met.where(once).select(F.col(f"a.{key}").alias(key), F.col(f"b.{other}").alias(other), rectangle_share(box("a"), box("b")).alias("share"))
    return out.where(F.col("share") > 0)


def coverage_counts(met: DataFrame, key: str, group: list[str], full: float = 0.99) -> DataFrame:
    """How many footprints of each group touch a chunk and how many cover it whole."""
    return met.groupBy(key, *group).agg(F.count("*").alias("touch"), F.count(F.when(F.col("share") >= full, 1)).alias("whole"))


def coverage_by_box(chunks: DataFrame, footprints: DataFrame, key: str, group: list[str], bucket: float, full: float = 0.99) -> DataFrame:
    """``coverage_counts`` where many rectangles are equal: each box of either side meets the others' once, footprints
    with their number, and the chunks take the counts of their box."""
    box = ["xmin", "ymin", "xmax", "ymax"]
    boxes = chunks.select(*box).distinct().withColumn("_chunk", F.struct(*box))
    prints = footprints.groupBy(*box, *group).agg(F.count("*").alias("_n")).withColumn("_print", F.struct(*box, *group, "_n"))
    met = touching(boxes, prints, "_chunk", "_print", bucket)
    n = F.col("_print._n")
    counts = met.groupBy("_chunk", *[F.col(f"_print.{g}").alias(g) for g in group]).agg(F.sum(n).alias("touch"), F.sum(F.when(F.col("share") >= full, n).otherwise(0)).alias("whole"))
    own = chunks.select(key, *box).join(counts.select(*[F.col(f"_chunk.{b}").alias(b) for b in box], *group, "touch", "whole"), box)
    return own.groupBy(key, *group).agg(F.sum("touch").alias("touch"), F.sum("whole").alias("whole"))


def compare_layers(before: DataFrame, after: DataFrame, key: str, area: str, least: float) -> DataFrame:
    """What became of each shape: kept, reshaped (its area changed by ``least`` or more), split, deleted or new."""
    a = before.groupBy(key).agg(F.sum(area).alias("area_before"))
    b = after.groupBy(key).agg(F.sum(area).alias("area_after"), F.count("*").alias("parts"))
    change = F.abs(F.col("area_after") - F.col("area_before"))
    fate = F.when(F.col("area_before").isNull(), "new").when(F.col("area_after").isNull(), "deleted").when(F.col("parts") > 1, "split").when(change >= least, "reshaped").otherwise("kept")
    return a.join(b, key, "full_outer").withColumn("fate", fate)


def by_distance(targets: DataFrame, places: DataFrame, key: str, x: str, y: str, k: int) -> DataFrame:
    """The k nearest places of each target in order; places are few (areas), which is checked."""
    p = require_few(places, "places").select(F.col(key).alias("place"), F.col(x).alias("_px"), F.col(y).alias("_py"))
    d = F.hypot(F.col(x) - F.col("_px"), F.col(y) - F.col("_py"))
    pairs = targets.select(key, x, y).crossJoin(F.broadcast(p)).where(F.col(key) != F.col("place")).select(key, "place", F.round(d, 6).alias("distance"))
    rank = F.row_number().over(W.partitionBy(key).orderBy("distance", "place"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k)


def nearest_chain(places: list[tuple], start: list) -> list:
    """Names (name, x, y) in the order in which the next one is nearest to any that went before, the first name of equals."""
    at = {n: (x, y) for n, x, y in places}
    done = [n for n in start if n in at]
    left = sorted(set(at) - set(done))
    while left:
        gap = lambda n: min(((at[n][0] - at[m][0]) ** 2 + (at[n][1] - at[m][1]) ** 2 for m in done), default=0.0)
        done.append(min(left, key=lambda n: (gap(n), n)))
        left.remove(done[-1])
    return done
