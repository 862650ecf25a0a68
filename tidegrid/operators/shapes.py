"""Shapes as sets of grid cells (shape, row, col): parts, holes, slivers, overlaps, tails, and the audit of a layer.

A shape's area is its number of cells, its outline the cell sides that no cell of its own lies behind; so every operation
on shapes is an equi-join or an aggregate over cells, and a layer of any size is dealt by cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import written
from .grid import patches, spread

SIDES = ((0, 1), (0, -1), (1, 0), (-1, 0))


def around(df: DataFrame, *carry: str) -> DataFrame:
    """(row, col) of the four neighbours of each cell, with the columns that are carried as ``from_…``."""
    steps = F.array(*[F.struct(F.lit(a).alias("r"), F.lit(b).alias("c")) for a, b in SIDES])
    x = df.select(*carry, "row", "col", F.explode(steps).alias("d"))
    return x.select(*[F.col(c).alias(f"from_{c}") for c in carry], (F.col("row") + F.col("d.r")).alias("row"), (F.col("col") + F.col("d.c")).alias("col"))


def outline(cells: DataFrame, shape: str) -> DataFrame:
    """Cells and outer sides of each shape, and its compactness 4 pi area / sides squared."""
    inner = around(cells, shape).withColumnRenamed(f"from_{shape}", shape).join(cells, [shape, "row", "col"], "left_semi").groupBy(shape).agg(F.count("*").alias("_inner"))
    size = cells.groupBy(shape).agg(F.count("*").alias("cells"), (F.max("row") - F.min("row") + 1).alias("height"), (F.max("col") - F.min("col") + 1).alias("width"))
    sides = 4 * F.col("cells") - F.coalesce("_inner", F.lit(0))
    return size.join(inner, shape, "left").select(shape, "cells", sides.alias("sides"), "height", "width", F.least("height", "width").alias("short_side"), (4 * F.pi() * F.col("cells") / (sides * sides)).alias("compactness"))


def strips(outlines: DataFrame, narrow: int, times: float) -> Column:
    """Long and thin: a mean width (twice the area over half the outline) of at most ``narrow`` and ``times`` as long."""
    half = F.col("sides") / 2
    breadth = F.col("cells") / (half / 2)
    return (breadth <= narrow) & (half / 2 >= times * breadth)


def split_parts(cells: DataFrame, shape: str, least: int) -> DataFrame:
    """Connected parts: the largest keeps the shape's name (the first of equal ones), others of ``least`` cells become
    new shapes and smaller ones go. ``part``: 0 for the one that keeps it."""
    parts = written(patches(cells.withColumn("_one", F.lit(1)), [shape], "_one").drop("_one"), "shape-parts")
    sizes = parts.groupBy(shape, "patch").agg(F.count("*").alias("_n"))
    rank = F.row_number().over(W.partitionBy(shape).orderBy(F.desc("_n"), "patch")) - 1
    kept = sizes.withColumn("part", rank).where((F.col("part") == 0) | (F.col("_n") >= least))
    return parts.join(kept.select(shape, "patch", "part"), [shape, "patch"]).select(shape, "part", "row", "col")


def cut_overlaps(cells: DataFrame, shape: str) -> DataFrame:
    """Each cell goes to the smallest of the shapes that hold it; of equal ones to the first name."""
    sizes = cells.groupBy(shape).agg(F.count("*").alias("_n"))
    return cells.join(sizes, shape).groupBy("row", "col").agg(F.min(F.struct("_n", shape)).alias("b")).select(F.col(f"b.{shape}").alias(shape), "row", "col")


def overlaps(cells: DataFrame, shape: str) -> DataFrame:
    """(a, b, cells) of each pair of shapes with common cells; a cell in many shapes is paired within itself only."""
    held = cells.groupBy("row", "col").agg(F.sort_array(F.collect_set(shape)).alias("s")).where(F.size("s") > 1)
    pairs = F.flatten(F.transform("s", lambda x, i: F.transform(F.slice("s", i + 2, F.size("s")), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    return held.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("cells"))


def dissolve(cells: DataFrame, shape: str) -> DataFrame:
    """Shapes that overlap, also by way of others, become one, named by the least of them."""
    from .graph import components

    roots = components(overlaps(cells, shape).select("a", "b"))
    return cells.join(roots, cells[shape] == roots["node"], "left").select(F.coalesce("root", shape).alias(shape), "row", "col").distinct()


def fill_holes(cells: DataFrame, shape: str, most: int) -> DataFrame:
    """Holes of at most ``most`` cells are filled: patches of free cells inside the shape's box that don't reach its edge."""
    box = cells.groupBy(shape).agg(*[f(F.col(c)).alias(f"_{n}{c}") for c in ("row", "col") for n, f in (("l", F.min), ("h", F.max))])
    span = box.withColumn("row", F.explode(F.sequence(F.col("_lrow") - 1, F.col("_hrow") + 1))).withColumn("col", F.explode(F.sequence(F.col("_lcol") - 1, F.col("_hcol") + 1)))
    free = span.join(cells, [shape, "row", "col"], "left_anti")
    # Free cells join by their four sides only, so that a ring closed at its corners holds its hole.
    holes = written(side_patches(free, shape), "shape-holes")
    edge = (F.col("row") == F.col("_lrow") - 1) | (F.col("row") == F.col("_hrow") + 1) | (F.col("col") == F.col("_lcol") - 1) | (F.col("col") == F.col("_hcol") + 1)
    small = holes.groupBy(shape, "patch").agg(F.count("*").alias("_n"), F.max(edge.cast("int")).alias("_out")).where((F.col("_out") == 0) & (F.col("_n") <= most))
    return cells.select(shape, "row", "col").unionByName(holes.join(small, [shape, "patch"], "left_semi").select(shape, "row", "col"))


def side_patches(df: DataFrame, key: str) -> DataFrame:
    """``patch``: the first cell of each patch whose cells join by their sides."""
    from .graph import components

    w = W.partitionBy(key, "row").orderBy("col")
    new = F.lag("col").over(w).isNull() | (F.lag("col").over(w) != F.col("col") - 1)
    x = df.withColumn("_run", F.sum(new.cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    runs = written(x.groupBy(key, "row", "_run").agg(F.min("col").alias("lo"), F.max("col").alias("hi")), "shape-runs")
    name = F.struct(key, "row", "lo")
    above = runs.select(key, (F.col("row") + 1).alias("row"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), name.alias("b"))
    met = runs.withColumn("a", name).join(above, [key, "row"]).where((F.col("lo") <= F.col("_hi")) & (F.col("_lo") <= F.col("hi")))
    found = components(met.select("a", "b"))
    named = runs.withColumn("node", name).join(found, "node", "left").select(key, "row", "_run", F.coalesce("root", "node").alias("patch"))
    return x.join(named, [key, "row", "_run"]).drop("_run")


def grow(cells: DataFrame, keys: list[str], half: int = 1) -> DataFrame:
    """Cells whose box of ``half`` cells holds a cell of the shape (dilation)."""
    return spread(cells, keys, half).select(*keys, "row", "col").distinct()


def shrink(cells: DataFrame, keys: list[str], half: int = 1) -> DataFrame:
    """Cells whose whole box lies in the shape (erosion)."""
    return spread(cells, keys, half).groupBy(*keys, "row", "col").agg(F.count("*").alias("_n")).where(F.col("_n") == (2 * half + 1) ** 2).drop("_n")


def remove_tails(cells: DataFrame, shape: str, half: int = 1) -> DataFrame:
    """Opening: what a box of ``half`` cells cannot cover goes; a shape that would vanish stays as it is."""
    opened = grow(shrink(cells, [shape], half), [shape], half).join(cells, [shape, "row", "col"], "left_semi")
    thin = cells.join(opened.select(shape).distinct(), shape, "left_anti")
    return opened.unionByName(thin.select(shape, "row", "col"))


def close_then_majority(cells: DataFrame, half: int = 1) -> DataFrame:
    """(row, col): closing, then the cells whose box is covered by more than half."""
    closed = shrink(grow(cells, [], half), [], half)
    share = spread(closed, [], half).groupBy("row", "col").agg(F.count("*").alias("_n"))
    return share.where(F.col("_n") * 2 > (2 * half + 1) ** 2).select("row", "col")


def absorb_slivers(cells: DataFrame, shape: str, least: int, field: str | None = None) -> DataFrame:
    """Shapes under ``least`` cells join the neighbour with which they share the most sides, one of the same ``field``
    first, then the first name. Chains of small shapes follow their neighbour's neighbour."""
    carry = [shape] + ([field] if field else [])
    base = written(cells.select(*carry, "row", "col"), "shape-cells")
    size = base.groupBy(shape).agg(F.count("*").alias("_n"))
    met = around(base, *carry).join(base, ["row", "col"]).where(F.col(f"from_{shape}") != F.col(shape))
    same = F.max((F.col(f"from_{field}") == F.col(field)).cast("int")) if field else F.lit(0)
    shared = met.groupBy(F.col(f"from_{shape}").alias("a"), F.col(shape).alias("b")).agg(F.count("*").alias("sides"), same.alias("same"))
    first = F.struct((-F.col("same")).alias("s"), (-F.col("sides")).alias("n"), F.col("b").alias("b"))
    to = shared.join(size.where(F.col("_n") < least).select(F.col(shape).alias("a")), "a").groupBy("a").agg(F.min(first).alias("t"))
    lead = to.select("a", F.col("t.b").alias("to")).join(size.select(F.col(shape).alias("to"), (F.col("_n") >= least).alias("done")), "to")
    lead = written(lead.select("a", "to", "done"), "shape-leads")
    for _ in range(max(1, lead.count()).bit_length()):
        if lead.where("not done").isEmpty():
            break
        on = lead.select(F.col("a").alias("to"), F.col("to").alias("_to"), F.col("done").alias("_done"))
        lead = written(lead.join(on, "to", "left").select("a", F.when(F.col("done"), F.col("to")).otherwise(F.coalesce("_to", "to")).alias("to"), (F.col("done") | F.coalesce("_done", F.lit(False))).alias("done")), "shape-leads")
    moved = lead.where("done").select(F.col("a").alias(shape), "to")
    return base.join(moved, shape, "left").select(F.coalesce("to", shape).alias(shape), "row", "col")


def audit(cells: DataFrame, shape: str, least: int) -> DataFrame:
    """One row of counts that should be zero: cells claimed twice, shapes in several parts, crumbs."""
    parts = patches(cells.select(shape, "row", "col").distinct().withColumn("_one", F.lit(1)), [shape], "_one").groupBy(shape).agg(F.countDistinct("patch").alias("p"), F.count("*").alias("n"))
    twice = cells.groupBy("row", "col").agg(F.countDistinct(shape).alias("c")).agg(F.count(F.when(F.col("c") > 1, 1)).alias("claimed_twice"))
    return parts.agg(F.count("*").alias("shapes"), F.count(F.when(F.col("p") > 1, 1)).alias("in_parts"), F.count(F.when(F.col("n") < least, 1)).alias("crumbs")).crossJoin(twice)


def free_ground(wanted: DataFrame, cells: DataFrame, least: int) -> DataFrame:
    """New shapes for wanted cells that no shape holds: their connected patches of ``least`` cells or more."""
    free = wanted.select("row", "col").join(cells.select("row", "col").distinct(), ["row", "col"], "left_anti").withColumn("_one", F.lit(1))
    found = patches(free, [], "_one").drop("_one")
    return found.withColumn("_n", F.count("*").over(W.partitionBy("patch"))).where(F.col("_n") >= least).drop("_n")


def majority_labels(cells: DataFrame, labels: DataFrame, shape: str, label: str) -> DataFrame:
    """Most common label of each shape's cells, the smallest of equals; -1 where no cell has one; and its share."""
    counts = cells.join(labels, ["row", "col"]).groupBy(shape, label).agg(F.count("*").alias("n"))
    top = counts.groupBy(shape).agg(F.max_by(label, F.struct(F.col("n"), -F.col(label))).alias("label"), (F.max("n") / F.sum("n")).alias("share"))
    return cells.select(shape).distinct().join(top, shape, "left").select(shape, F.coalesce("label", F.lit(-1)).alias("label"), "share")
