"""Scans of exported scenes, passes and windows, with checked metadata; writes that appear whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import to_db, to_linear
from ..operators.grid import spread


def index_of(a: Column, b: Column) -> Column:
    """(a - b) / (a + b), NULL where the sum is zero."""
    return F.try_divide(a - b, a + b)


def scene_cube(bands: DataFrame, cell: list[str], ok: Column) -> DataFrame:
    """Exported dates as greenness, open water and surface moisture with a clear flag; unclear values stay in the table."""
    c = F.col
    return bands.select(*cell, "date", index_of(c("nir"), c("red")).alias("ndvi"), index_of(c("green"), c("nir")).alias("ndwi"), index_of(c("nir"), c("swir")).alias("lswi"), F.coalesce(ok, F.lit(False)).alias("ok"))


def composite_windows(windows: DataFrame, values: list[str], least: int) -> DataFrame:
    """Fixed-window composites; a window seen fewer than ``least`` times has no values."""
    return windows.select(*[F.when(F.col("n_obs") >= least, F.col(x)).alias(x) if x in values else F.col(x) for x in windows.columns])


def track_passes(passes: DataFrame, track: str, bad: DataFrame | None, values: list[str], size: int, least_share: float = 0.5) -> DataFrame:
    """One track's passes as box means taken in power, without the passes recorded as bad.

    ``passes``: (track, date, row, col, values in decibels). The track is a partition, so only its files are read.
    """
    own = passes.where(F.col("track") == track)
    if bad is not None:
        own = own.join(F.broadcast(bad.where(F.col("track") == track).select("date").distinct()), "date", "left_anti")
    power = own.select("date", "row", "col", *[to_linear(F.col(v)).alias(v) for v in values])
    sent = spread(power, ["date"], size // 2, *values).groupBy("date", "row", "col").agg(*[a for v in values for a in (F.sum(f"n_{v}").alias(f"s_{v}"), F.count(f"n_{v}").alias(f"m_{v}"))])
    mean = lambda v: to_db(F.when(F.col(f"m_{v}") >= least_share * size * size, F.col(f"s_{v}") / F.col(f"m_{v}"))).alias(v)
    return power.select("date", "row", "col").join(sent, ["date", "row", "col"]).select("date", "row", "col", *[mean(v) for v in values])


def bounding_box(cells: DataFrame, margin: int) -> tuple[int, int, int, int]:
    """First and last row and column of a few wanted cells, widened by a margin: four numbers that a scan can prune by."""
    b = cells.agg(F.min("row"), F.max("row"), F.min("col"), F.max("col")).first()
    return b[0] - margin, b[1] + margin, b[2] - margin, b[3] + margin


def track_cells(passes: DataFrame, cells: DataFrame, track: str, bad: DataFrame | None, values: list[str], size: int, least_share: float = 0.5) -> DataFrame:
    """The same for some cells: the box around them is read, with a margin for the means, and the cells are kept."""
    r0, r1, c0, c1 = bounding_box(cells, size // 2)
    near = passes.where(F.col("row").between(r0, r1) & F.col("col").between(c0, c1))
    return track_passes(near, track, bad, values, size, least_share).join(cells.select("row", "col").distinct(), ["row", "col"], "left_semi")


def checked_metadata(lines: DataFrame, schema: str, required: list[str], text: str = "value") -> DataFrame:
    """JSON records by a schema; a record without a required field, or that is no JSON, raises."""
    got = lines.select(F.from_json(text, schema).alias("j"), F.col(text).alias("_t"))
    broken = F.col("j").isNull()
    for c in required:
        broken = broken | F.col(f"j.{c}").isNull()
    bad = got.where(broken).limit(3).collect()
    if bad:
        raise ValueError(f"metadata: {[r['_t'] for r in bad]}")
    return got.select("j.*")


def same_grid(a: dict, b: dict) -> str | None:
    """The first field in which two grid definitions differ, and how; nothing if they are alike."""
    for name in sorted(set(a) | set(b)):
        if a.get(name) != b.get(name):
            return f"{name}: {a.get(name)} and {b.get(name)}"
    return None


def write_whole(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Write beside the target and rename: a reader sees the old table or the new one, never a part.

    Renaming is the file system's, so it works wherever Spark writes.
    """
    spark: SparkSession = df.sparkSession
    part = f"{path}.{uuid.uuid4().hex}.part"
    df.write.format(kind).save(part)
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    old = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.old")
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"cannot move {path}")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(part), target):
        raise OSError(f"cannot write {path}")
    if fs.exists(old):
        fs.delete(old, True)
