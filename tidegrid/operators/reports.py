"""Summaries for reports: curves of fields, separations, thresholds from references, composites, profiles of series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import mean_db, pack
from .robust import MAD_FACTOR, auc, counted, counted_percentile
from .temporal import by


def median(c) -> Column:
    return F.percentile(c, F.lit(0.5))


def series_profile(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Least, greatest, mean, range and population deviation and variance of each series."""
    return df.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.avg(value).alias("mean"), (F.max(value) - F.min(value)).alias("span"), F.stddev_pop(value).alias("std"), F.var_pop(value).alias("var"))


def field_means(values: DataFrame, bridge: DataFrame, cell: str, field: str, time: str, value: str, mask: Column | None = None) -> DataFrame:
    """Mean over the known cells of each field at each time; with a mask only over its cells."""
    x = values if mask is None else values.where(mask)
    return x.join(bridge, cell).groupBy(field, time).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def field_curve(values: DataFrame, bridge: DataFrame, cell: str, field: str, time: str, value: str, ok: Column, share: float = 0.5) -> DataFrame:
    """Median of each field's clear cells at each time; a time counts where that share of its cells is clear."""
    x = values.join(bridge, cell).withColumn("_ok", F.coalesce(ok, F.lit(False)))
    return x.groupBy(field, time).agg(median(F.when(F.col("_ok"), F.col(value))).alias("median"), F.avg(F.col("_ok").cast("int")).alias("clear")).where(F.col("clear") >= share)


def parts_of(df: DataFrame, group: list[str], parts: list[tuple[str, Column]], rest: str = "other") -> DataFrame:
    """Rows of each group by the first part whose condition holds."""
    name = reduce(lambda out, p: out.when(p[1], p[0]), parts[1:], F.when(parts[0][1], parts[0][0])).otherwise(rest)
    return df.groupBy(*group, name.alias("part")).agg(F.count("*").alias("n"))


def shares_of(df: DataFrame, group: str, flags: dict[str, Column]) -> DataFrame:
    """Share of each group's rows in each explanation."""
    return df.groupBy(group).agg(F.count("*").alias("n"), *[F.avg(F.coalesce(c, F.lit(False)).cast("int")).alias(n) for n, c in flags.items()])


def availability(df: DataFrame, keys: list[str], day: str, platform: str) -> DataFrame:
    """Rows, platforms and distinct days of each key and month."""
    return df.groupBy(*keys, F.trunc(day, "month").alias("month")).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set(platform)), ";").alias("platforms"), F.countDistinct(F.to_date(day)).alias("days"))


def area_check(df: DataFrame, supplied: str, computed: str) -> DataFrame:
    """Median ratio of supplied to computed areas, the unit it speaks for, and the greatest and mean disagreement in per cent."""
    ratio = df.where((F.col(computed) > 0) & F.col(supplied).isNotNull()).select((F.col(supplied) / F.col(computed)).alias("r"))
    dealt = counted(ratio, "r")
    mid = counted_percentile(dealt, "r", 0.5, "ratio")
    # What a square metre is in hectares and acres.
    units = [("square metres", 1.0), ("hectares", 1e-4), ("acres", 1 / 4046.8564224)]
    unit = F.lit("unknown")
    for name, scale in units:
        unit = F.when(F.abs(F.col("ratio") / scale - 1) < 0.2, name).otherwise(unit)
    off = 100 * F.abs(F.col("r") / F.col("ratio") - 1)
    return dealt.join(F.broadcast(mid)).groupBy("ratio").agg(F.max(off).alias("worst_pct"), (F.sum(off * F.col("n")) / F.sum("n")).alias("mean_pct")).withColumn("unit", unit)


def least_count(df: DataFrame, keys: list[str], value: str, least: int) -> DataFrame:
    """Median of each key with enough rows; NULL for the others."""
    return df.groupBy(*keys).agg(F.when(F.count(value) >= least, median(value)).alias("median"), F.count(value).alias("n"))


def best_day(df: DataFrame, keys: list[str], day: str, share: str) -> DataFrame:
    """The day with the greatest share, the latest of equal ones, and that share."""
    top = F.max(F.struct(F.col(share).alias("s"), F.col(day).alias("d")))
    return df.groupBy(*keys).agg(top.alias("t")).select(*keys, F.col("t.d").alias(day), F.col("t.s").alias(share))


def separation(df: DataFrame, features: list[str], flag: Column, least: int) -> DataFrame:
    """Features by how well they part two groups: AUC, medians of either; groups under ``least`` rows give none."""
    long = df.select(flag.alias("_f"), F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])).alias("e")).select("_f", "e.*")
    mids = long.groupBy("feature").agg(median(F.when(F.col("_f"), F.col("x"))).alias("median_in"), median(F.when(~F.col("_f"), F.col("x"))).alias("median_out"))
    return auc(long, ["feature"], "x", F.col("_f")).where((F.col("positives") >= least) & (F.col("negatives") >= least)).join(mids, "feature")


def earliest(df: DataFrame, keys: list[str], order: str, value: str, goal: float) -> DataFrame:
    """First row of each key that reaches the goal; NULL where none does."""
    return df.groupBy(*keys).agg(F.min(F.when(F.col(value) >= goal, F.col(order))).alias("first"))


def jumping_passes(df: DataFrame, keys: list[str], day: str, value: str, limit: float, n: int = 2) -> DataFrame:
    """Passes whose area median differs by more than the limit from the medians of the n passes either side."""
    area = df.groupBy(*keys, day).agg(median(value).alias("level"))
    w = by(keys, day)
    around = [w.rowsBetween(-n, -1), w.rowsBetween(1, n)]
    both = reduce(lambda a, b: a + b, [F.sum("level").over(f) for f in around]) / reduce(lambda a, b: a + b, [F.count("level").over(f) for f in around])
    full = (F.count("level").over(around[0]) == n) & (F.count("level").over(around[1]) == n)
    return area.withColumn("jump", F.when(full, F.col("level") - both)).where(F.abs("jump") > limit)


def reference_thresholds(df: DataFrame, group: str, cuts: dict[str, tuple[str, str, float]]) -> DataFrame:
    """One row of thresholds: name -> (group, column, percentile) of that group's rows."""
    return df.agg(*[F.percentile(F.when(F.col(group) == g, F.col(c)), F.lit(q)).alias(n) for n, (g, c, q) in cuts.items()])


def cover_codes(low: Column, split: Column, floor: float) -> Column:
    """0 not vegetated, 1 went bare (also where the low is unknown), 2 stayed green."""
    return F.when(low.isNull(), 1).when(low < floor, 0).when(low > F.greatest(split, F.lit(floor)), 2).otherwise(1)


def month_composite(df: DataFrame, cell: list[str], day: str, value: str) -> DataFrame:
    """Monthly means in power and the season's least, as packed decibels, one column a month."""
    x = df.withColumn("_m", F.month(day))
    return x.groupBy(*cell).agg(*[pack(mean_db(F.when(F.col("_m") == m, F.col(value)))).alias(f"m{m:02d}") for m in range(1, 13)], pack(F.min(value)).alias("least"))


def stretched(value: Column, scale: float) -> Column:
    """A series read at s / scale, linear between its places; what lies beyond its end is NULL."""
    n = F.size(value)

    def at(i: Column) -> Column:
        s = i / scale
        a = F.floor(s).cast("int")
        b = F.least(a + 1, n - 1)
        return F.when(s <= n - 1, F.get(value, a) + (F.get(value, b) - F.get(value, a)) * (s - a))

    return F.transform(F.sequence(F.lit(0), n - 1), at)


def hold_last(value: Column) -> Column:
    """NULLs at the end of a series take its last known value."""
    known = F.array_compact(value)
    last = F.get(known, F.size(known) - 1)
    end = F.aggregate(F.sequence(F.lit(0), F.size(value) - 1), F.lit(-1), lambda a, i: F.when(F.get(value, i).isNotNull(), i).otherwise(a))
    return F.transform(value, lambda x, i: F.when(i > end, last).otherwise(x))


def shifted_rms(a: DataFrame, b: DataFrame, key: str, idx: str, value: str, shift: int) -> DataFrame:
    """Root mean square of a series against a centre moved by ``shift`` windows, over the windows both have."""
    moved = b.select((F.col(idx) + shift).alias(idx), F.col(value).alias("_c"))
    return a.join(moved, idx).groupBy(key).agg(F.sqrt(F.avg(F.pow(F.col(value) - F.col("_c"), 2))).alias("rms"), F.count("*").alias("n"))


def own_shape(df: DataFrame, key: str, idx: str, value: str, start: str) -> DataFrame:
    """The curve from its start on a scale of its own: step, share of its range, and its range."""
    x = df.where(F.col(idx) >= F.col(start))
    w = W.partitionBy(key)
    low, high = F.min(value).over(w), F.max(value).over(w)
    return x.select(key, (F.col(idx) - F.col(start)).alias("step"), F.when(high > low, (F.col(value) - low) / (high - low)).alias("share"), (high - low).alias("amplitude"))


def shape_reference(shapes: DataFrame, least: int) -> DataFrame:
    """Per step the median of shapes and its scaled deviation; steps with few members have none."""
    mid = shapes.groupBy("step").agg(median("share").alias("middle"), F.count("share").alias("members")).where(F.col("members") >= least)
    return shapes.join(mid, "step").groupBy("step", "middle", "members").agg((MAD_FACTOR * median(F.abs(F.col("share") - F.col("middle")))).alias("spread"))


def judge_shapes(shapes: DataFrame, reference: DataFrame, noise: float, k: float, half_rise: int, oldest: int, key: str = "k") -> DataFrame:
    """Alike, unlike or undecided: the root mean square gap to the reference in units of its spread and the noise; too young
    and too old ones are undecided, later words over earlier ones."""
    x = shapes.join(reference, "step").withColumn("_z", (F.col("share") - F.col("middle")) / F.sqrt(F.col("spread") ** 2 + F.try_divide(F.lit(noise), F.col("amplitude")) ** 2))
    out = x.groupBy(key).agg(F.sqrt(F.avg(F.pow("_z", 2))).alias("gap"), F.max("step").alias("age"))
    verdict = F.when(F.col("age") > oldest, "too old").when(F.col("age") < half_rise, "undecided").when(F.col("gap") <= k, "alike").when(F.col("gap").isNotNull(), "unlike").otherwise("none")
    return out.withColumn("verdict", verdict)


def share_around(cells: DataFrame, label: str, value, half: int) -> DataFrame:
    """Share of the known cells in the box around each cell that are of one class."""
    from .grid import spread

    flagged = cells.withColumn("_is", (F.col(label) == value).cast("int"))
    got = spread(flagged, [], half, "_is").groupBy("row", "col").agg(F.avg("n__is").alias("share"))
    return cells.join(got, ["row", "col"]).select("row", "col", label, "share")


def region_blocks(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    """Square blocks with the rows in them and the box that these fill."""
    return df.groupBy(F.floor(F.col(x) / size).alias("bx"), F.floor(F.col(y) / size).alias("by")).agg(F.count("*").alias("n"), F.min(x).alias("xmin"), F.max(x).alias("xmax"), F.min(y).alias("ymin"), F.max(y).alias("ymax"))


def flagged_shapes(cells: DataFrame, shape: str, flag: Column, share: float) -> DataFrame:
    """Shapes of whose cells at least that share is flagged."""
    return cells.groupBy(shape).agg(F.avg(F.coalesce(flag, F.lit(False)).cast("int")).alias("share"), F.count("*").alias("cells")).where(F.col("share") >= share)


def too_young(fields: DataFrame, mode: str, limit: float) -> Column:
    """Fields that are too young to deliver, by one of three readings: open water on the newest clear date, a small dry
    share, or open water on half of the field or within so many days."""
    c = F.col
    if mode == "water":
        return F.coalesce(c("ndwi") > 0, F.lit(False))
    if mode == "dry":
        return F.coalesce(c("dry_share") < limit, F.lit(False))
    if mode == "days":
        return F.coalesce(c("open_share") >= 0.5, F.lit(False)) | F.coalesce(c("days_since_open") <= limit, F.lit(False))
    raise ValueError(f"no such reading: {mode}")
