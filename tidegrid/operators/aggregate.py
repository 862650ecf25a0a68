"""Grouped, conditional and pivoted aggregates; majority labels; set comparison; top-k and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import acres, mean_db, seeded_digest


def seasonal_features(df: DataFrame, keys: list[str], order: str, value: str, tie: str) -> DataFrame:
    """Least, greatest, range, population variance, place of the least (the first of equal ones) and count."""
    return df.groupBy(*keys).agg(F.min(value).alias("v_min"), F.max(value).alias("v_max"), (F.max(value) - F.min(value)).alias("amplitude"), F.var_pop(value).alias("variance"), F.min_by(F.col(order), F.struct(value, order, tie)).alias("argmin"), F.count(value).alias("n"))


def bin_means_db(df: DataFrame, keys: list[str], bin_: Column, value: str, name: str = "bin") -> DataFrame:
    """Mean of decibels in each bin, taken in power."""
    return df.groupBy(*keys, bin_.alias(name)).agg(mean_db(F.col(value)).alias("mean_db"), F.count(value).alias("n"))


def quantile_band(df: DataFrame, keys: list[str], value: str, low: float = 0.25, high: float = 0.75) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.percentile(value, F.lit(q)).alias(n) for q, n in ((low, "low"), (0.5, "mid"), (high, "high"))], F.count(value).alias("n"))


def class_counts(df: DataFrame, key: str, label: str, labels: list[str]) -> DataFrame:
    """One column of row counts for each listed label, zero where a key has none."""
    return df.groupBy(key).agg(*[F.count(F.when(F.col(label) == x, 1)).alias(f"n_{x}") for x in labels])


def majority(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Most common label of a key (the smallest of equals), its share and the key's rows."""
    counts = df.groupBy(*keys, label).agg(F.count("*").alias("n"))
    top = F.struct(F.col("n").alias("n"), F.col(label).alias("l"))
    # The smallest label wins a tie: compare counts first, then labels downwards.
    best = counts.groupBy(*keys).agg(F.max("n").alias("m"), F.sum("n").alias("total"))
    win = counts.join(best, keys).where("n = m").groupBy(*keys, "total").agg(F.min(top).alias("t"))
    return win.select(*keys, F.col("t.l").alias("majority"), (F.col("t.n") / F.col("total")).alias("share"), F.col("total"))


def transitions(df: DataFrame, before: str, after: str) -> DataFrame:
    """Rows and acres of each (before, after) pair, and the pair's share of its before class."""
    t = df.groupBy(before, after).agg(F.count("*").alias("n"))
    return t.withColumn("acres", acres(F.col("n"))).withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(before)))


def crosstab_shares(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Row percentages, one decimal."""
    return df.groupBy(row).agg(*[F.round(100 * F.count(F.when(F.col(column) == v, 1)) / F.count("*"), 1).alias(f"pct_{v}") for v in values])


def with_totals(df: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """Sums by (a, b), by a and overall; totals carry the label 'all'."""
    rolled = df.rollup(a, b).agg(F.sum(value).alias("total"), F.count("*").alias("n"), F.grouping_id().alias("level"))
    return rolled.select(*[F.when(F.col("level").bitwiseAND(F.lit(bit)) != 0, F.lit("all")).otherwise(F.col(c).cast("string")).alias(c) for c, bit in ((a, 2), (b, 1))], "total", "n")


def typed_summary(df: DataFrame, keys: list[str], numbers: list[str], flags: list[str], names: list[str]) -> DataFrame:
    """Median of numbers, share of flags, and the most common name (the smallest of equals)."""
    return df.groupBy(*keys).agg(*[F.percentile(c, F.lit(0.5)).alias(f"median_{c}") for c in numbers], *[F.avg(F.col(c).cast("int")).alias(f"share_{c}") for c in flags], *[F.mode(c, True).alias(f"mode_{c}") for c in names])


def attribute_overview(df: DataFrame, columns: list[str], k: int = 3) -> DataFrame:
    """(attribute, value, n, rank): the k most common values of each attribute."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in columns])).alias("e")).select("e.*").where("value is not null")
    counts = long.groupBy("attribute", "value").agg(F.count("*").alias("n"))
    return counts.withColumn("rank", F.row_number().over(W.partitionBy("attribute").orderBy(F.desc("n"), "value"))).where(F.col("rank") <= k)


def coverage(scope: DataFrame, present: DataFrame, on: list[str], valid: Column, group: list[str]) -> DataFrame:
    """Share of the planned cells that are present and valid; a planned cell without rows counts against it."""
    own = present.groupBy(*on).agg(F.max(valid.cast("int")).alias("_v"))
    return scope.join(own, on, "left").groupBy(*group).agg(F.count("*").alias("planned"), F.count(F.when(F.col("_v") == 1, 1)).alias("valid")).withColumn("valid_pct", 100 * F.col("valid") / F.col("planned"))


def diff_stats(a: DataFrame, b: DataFrame, on: list[str], value: str, tolerance: float) -> DataFrame:
    """Over keys known on both sides: median signed and absolute difference, 99th percentile, share over the tolerance."""
    both = a.select(*on, F.col(value).alias("_a")).join(b.select(*on, F.col(value).alias("_b")), on).where("_a is not null and _b is not null").withColumn("_d", F.col("_b") - F.col("_a"))
    p = lambda c, q: F.percentile(c, F.lit(q))
    return both.agg(F.count("*").alias("n"), p(F.col("_d"), 0.5).alias("median_signed"), p(F.abs("_d"), 0.5).alias("median_abs"), p(F.abs("_d"), 0.99).alias("p99_abs"), F.avg((F.abs("_d") > tolerance).cast("int")).alias("over_share"))


def compare_keys(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """(side, n): keys on both sides, only in a, only in b."""
    x, y = a.select(on).distinct().withColumn("_a", F.lit(1)), b.select(on).distinct().withColumn("_b", F.lit(1))
    side = F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").otherwise("both")
    return x.join(y, on, "full_outer").groupBy(side.alias("side")).agg(F.count("*").alias("n"))


def duplicates(df: DataFrame, content: Column, key: str) -> DataFrame:
    """Groups of equal content: digest, rows, the smallest key."""
    return df.groupBy(F.sha2(content.cast("binary"), 256).alias("digest")).agg(F.count("*").alias("n"), F.min(key).alias("first_key")).where("n > 1")


def seeded_cap(df: DataFrame, group: list[str], key: str, n: int, seed: int) -> DataFrame:
    """At most n rows of each group by a seeded digest of the key: the same rows however the table is dealt."""
    order = seeded_digest(seed, F.col(key))
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*group).orderBy(order, key))).where(F.col("_r") <= n).drop("_r")


def ranked_choice(df: DataFrame, group: list[str], order: list[Column], k: int = 1) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)


def thresholds_sweep(df: DataFrame, value: str, positive: Column, cuts: list[float]) -> DataFrame:
    """Recall and false-positive share of ``value >= cut`` for each cut, in one pass."""
    grid = F.explode(F.array(*[F.lit(float(c)) for c in cuts])).alias("cut")
    # One row a cut and side leaves each task: counts, not rows, are shuffled.
    long = df.where(F.col(value).isNotNull()).select(F.col(value).alias("_v"), positive.cast("int").alias("_p"), grid)
    agg = long.groupBy("cut").agg(F.sum("_p").alias("pos"), F.sum(1 - F.col("_p")).alias("neg"), F.sum(F.when(F.col("_v") >= F.col("cut"), F.col("_p")).otherwise(0)).alias("tp"), F.sum(F.when(F.col("_v") >= F.col("cut"), 1 - F.col("_p")).otherwise(0)).alias("fp"))
    return agg.select("cut", "tp", "fp", F.try_divide("tp", "pos").alias("recall"), F.try_divide("fp", "neg").alias("false_share"), F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))
