"""Grid neighbourhoods and patches over (row, col) tables: box means, shares, interiors, components, sieve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import written
from .graph import components


def spread(df: DataFrame, keys: list[str], half: int, *values: str) -> DataFrame:
    """Each cell's values sent to every cell whose box holds it: (keys, row, col, values)."""
    steps = F.sequence(F.lit(-half), F.lit(half))
    return df.select(*keys, "row", "col", *values).withColumn("_dr", F.explode(steps)).withColumn("_dc", F.explode(steps)).select(*keys, (F.col("row") + F.col("_dr")).alias("row"), (F.col("col") + F.col("_dc")).alias("col"), *[F.col(v).alias(f"n_{v}") for v in values])


def box_mean(df: DataFrame, keys: list[str], value: str, size: int, least_share: float = 0.0) -> DataFrame:
    """Mean over the box around each cell of ``df``; NULL where the known share of the whole box is too small.

    Cells send their value to their box's cells and are summed there (map-side first), so no cell is joined with another.
    """
    got = spread(df, keys, size // 2, value).groupBy(*keys, "row", "col").agg(F.sum(f"n_{value}").alias("s"), F.count(f"n_{value}").alias("m"))
    mean = F.when(F.col("m") >= least_share * size * size, F.try_divide("s", "m"))
    return df.join(got, [*keys, "row", "col"], "left").withColumn("box_mean", mean).drop("s", "m")


def same_share(df: DataFrame, keys: list[str], label: str, size: int) -> DataFrame:
    """Share of the box around each cell that has the cell's own class."""
    counts = spread(df, keys, size // 2, label).groupBy(*keys, "row", "col", f"n_{label}").agg(F.count("*").alias("m"))
    total = counts.withColumn("t", F.sum("m").over(W.partitionBy(*keys, "row", "col")))
    return df.join(total, [*keys, "row", "col"]).where(F.col(label) == F.col(f"n_{label}")).withColumn("same_share", F.col("m") / F.col("t")).drop("m", "t", f"n_{label}")


def interior(df: DataFrame, keys: list[str], plot: str) -> DataFrame:
    """Cells whose four neighbours lie in the same plot."""
    steps = F.array(*[F.struct(F.lit(a).alias("r"), F.lit(b).alias("c")) for a, b in ((0, 1), (0, -1), (1, 0), (-1, 0))])
    sent = df.select(*keys, plot, "row", "col", F.explode(steps).alias("d")).groupBy(*keys, plot, (F.col("row") + F.col("d.r")).alias("row"), (F.col("col") + F.col("d.c")).alias("col")).agg(F.count("*").alias("_n"))
    return df.join(sent, [*keys, plot, "row", "col"]).where("_n = 4").drop("_n")


def patches(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """``patch``: the smallest cell id (row * 2**31 + col) of each eight-connected patch of one class.

    Runs along a row are merged by a window first, so the graph whose components are sought holds runs instead of cells;
    rows meet the row above only.
    """
    w = W.partitionBy(*keys, "row").orderBy("col")
    new = (F.lag("col").over(w) != F.col("col") - 1) | (F.lag(label).over(w) != F.col(label)) | F.lag("col").over(w).isNull()
    cells = df.withColumn("_run", F.sum(new.cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    first = F.min(F.col("row").cast("long") * (1 << 31) + F.col("col")).alias("cell")
    runs = written(cells.groupBy(*keys, "row", "_run", label).agg(F.min("col").alias("lo"), F.max("col").alias("hi"), first), "grid-runs")
    name = F.struct(*keys, "cell") if keys else F.col("cell")
    above = runs.select(*keys, (F.col("row") + 1).alias("row"), F.col(label).alias("_label"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), name.alias("b"))
    met = runs.withColumn("a", name).join(above, [*keys, "row"]).where((F.col(label) == F.col("_label")) & (F.col("lo") <= F.col("_hi") + 1) & (F.col("_lo") <= F.col("hi") + 1))
    found = components(met.select("a", "b"))
    named = runs.withColumn("node", name).join(found, "node", "left").select(*keys, "row", "_run", F.coalesce("root.cell" if keys else "root", "cell").alias("patch"))
    return cells.join(named, [*keys, "row", "_run"]).drop("_run")


def sieve(df: DataFrame, keys: list[str], label: str, least: int) -> DataFrame:
    """Patches smaller than ``least`` take the class of their largest neighbour (the smallest id of equal ones).

    Where that neighbour is small too, its own largest neighbour is asked, and so on; patches that only lead to one
    another, and those without neighbours, stay as they are.
    """
    p = written(patches(df, keys, label), "grid-patches")
    sizes = p.groupBy(*keys, "patch", label).agg(F.count("*").alias("size"))
    small = sizes.where(F.col("size") < least).select(*keys, "patch")
    # Cells of small patches alone look around themselves.
    around = spread(p.join(small, [*keys, "patch"], "left_semi"), keys, 1, "patch").select(*keys, "row", "col", F.col("n_patch").alias("patch"))
    sent = around.join(p.select(*keys, "row", "col", F.col("patch").alias("n_patch")), [*keys, "row", "col"]).where("patch <> n_patch").select(*keys, "patch", "n_patch").distinct()
    other = sizes.select(*keys, F.col("patch").alias("n_patch"), F.col("size").alias("_size"))
    to = sent.join(other, [*keys, "n_patch"]).groupBy(*keys, "patch").agg(F.max_by(F.struct("n_patch", "_size"), F.struct(F.col("_size"), -F.col("n_patch"))).alias("t"))
    lead = written(to.select(*keys, "patch", F.col("t.n_patch").alias("to"), (F.col("t._size") >= least).alias("done")), "grid-leads")
    # Each round doubles the way that is followed, so chains of all lengths end within log2 of the patches.
    for _ in range(max(1, lead.count()).bit_length()):
        if lead.where("not done").isEmpty():
            break
        on = lead.select(*keys, F.col("patch").alias("to"), F.col("to").alias("_to"), F.col("done").alias("_done"))
        lead = written(lead.join(on, [*keys, "to"], "left").select(*keys, "patch", F.when(F.col("done"), F.col("to")).otherwise(F.coalesce("_to", "to")).alias("to"), (F.col("done") | F.coalesce("_done", F.lit(False))).alias("done")), "grid-leads")
    goal = sizes.select(*keys, F.col("patch").alias("to"), F.col(label).alias("_class"))
    out = p.join(lead.where("done").join(goal, [*keys, "to"]).select(*keys, "patch", "_class"), [*keys, "patch"], "left")
    return out.withColumn("sieved", F.coalesce("_class", label)).drop("_class")


def grid_chunks(width: int, height: int, size: int, spark) -> DataFrame:
    """Chunks that tile a grid: (row_off, col_off, height, width), the last ones clipped."""
    rows = spark.range(0, height, size).select(F.col("id").cast("int").alias("row_off"))
    out = rows.withColumn("col_off", F.explode(F.sequence(F.lit(0), F.lit(width - 1), F.lit(size))))
    return out.withColumn("height", F.least(F.lit(size), height - F.col("row_off"))).withColumn("width", F.least(F.lit(size), width - F.col("col_off")))


def split_chunk(chunks: DataFrame) -> DataFrame:
    """Up to four parts of each chunk; empty parts are left out."""
    h, w = F.ceil(F.col("height") / 2).cast("int"), F.ceil(F.col("width") / 2).cast("int")
    part = lambda i, r, c, ph, pw: F.struct(F.lit(i).alias("part"), (F.col("row_off") + r).alias("row_off"), (F.col("col_off") + c).alias("col_off"), ph.alias("height"), pw.alias("width"))
    parts = F.array(part(0, F.lit(0), F.lit(0), h, w), part(1, F.lit(0), w, h, F.col("width") - w), part(2, h, F.lit(0), F.col("height") - h, w), part(3, h, w, F.col("height") - h, F.col("width") - w))
    return chunks.select(F.explode(parts).alias("p")).select("p.*").where("height > 0 and width > 0")


def ring_area(ring: Column) -> Column:
    """Area of a closed ring of (x, y) structs by the shoelace rule."""
    n = F.size(ring)
    total = F.aggregate(F.sequence(F.lit(0), n - 2), F.lit(0.0), lambda a, i: a + F.get(ring, i)["x"] * F.get(ring, i + 1)["y"] - F.get(ring, i + 1)["x"] * F.get(ring, i)["y"])
    return F.abs(total) / 2


def ring_compactness(ring: Column) -> Column:
    """4 pi area / perimeter squared."""
    n = F.size(ring)
    length = F.aggregate(F.sequence(F.lit(0), n - 2), F.lit(0.0), lambda a, i: a + F.hypot(F.get(ring, i + 1)["x"] - F.get(ring, i)["x"], F.get(ring, i + 1)["y"] - F.get(ring, i)["y"]))
    return F.try_divide(4 * F.pi() * ring_area(ring), length * length)


def overlap_claims(bridge: DataFrame, cell: str, owner: str, priority: str) -> DataFrame:
    """Contested cells go to the owner with the lowest priority value, then the lowest id."""
    best = F.min(F.struct(F.col(priority).alias("p"), F.col(owner).alias("o")))
    return bridge.groupBy(cell).agg(best.alias("b"), F.count("*").alias("claims")).select(cell, F.col("b.o").alias(owner), "claims")
