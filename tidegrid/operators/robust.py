"""Robust and distribution statistics: noise, own range, Otsu, AUC, rank correlation, cuts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import written
from .temporal import by, last_k

#: The normal-consistent factor of the median absolute deviation, and that of a second difference's noise.
MAD_FACTOR = 1.4826
SECOND_DIFF = math.sqrt(6.0)


def pass_noise(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """1.4826 * median |second difference| / sqrt(6); a missing value makes the differences around it missing."""
    w = by(keys, *order)
    second = F.col(value) - 2 * F.lag(value, 1).over(w) + F.lag(value, 2).over(w)
    return df.withColumn("_d2", F.abs(second)).groupBy(*keys).agg((F.percentile("_d2", F.lit(0.5)) * MAD_FACTOR / SECOND_DIFF).alias("noise"))


def clear_noise(df: DataFrame, keys: list[str], order: list[str], value: str, ok: Column) -> DataFrame:
    """The same over clear values, with the gaps closed first."""
    return pass_noise(df.where(ok & F.col(value).isNotNull()), keys, order, value)


def pass_wobble(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    step = F.abs(F.col(value) - F.lag(value).over(by(keys, *order)))
    return df.withColumn("_d", step).groupBy(*keys).agg(F.percentile("_d", F.lit(0.5)).alias("wobble"))


def own_range(df: DataFrame, keys: list[str], order: list[str], value: str, low: float = 0.1, high: float = 0.9, k: int = 2) -> DataFrame:
    """The key's own low and high percentile, and the mean place of its last k values within that range."""
    stats = df.groupBy(*keys).agg(F.percentile(value, F.lit(low)).alias("p_low"), F.percentile(value, F.lit(high)).alias("p_high"), F.count(value).alias("n"))
    tail = last_k(df.where(F.col(value).isNotNull()), keys, order, k).groupBy(*keys).agg(F.avg(value).alias("end_mean"))
    place = F.when(F.col("p_high") > F.col("p_low"), (F.col("end_mean") - F.col("p_low")) / (F.col("p_high") - F.col("p_low")))
    return stats.join(tail, keys, "left").withColumn("position", place)


def otsu(df: DataFrame, value: str, bins: int = 256, flat_top: bool = True) -> DataFrame:
    """Otsu's threshold over equal bins; one row, NULL for a constant.

    Two groups far apart give a flat top over the empty bins between them: the middle of it is taken, or its first centre.
    """
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).where("hi > lo")
    place = F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    counts = df.select(value).where(F.col(value).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    # ``bins`` rows from here on.
    spine = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    up, all_ = W.orderBy("bin"), W.partitionBy()
    c = spine.withColumn("centre", F.col("lo") + (F.col("bin") + 0.5) * (F.col("hi") - F.col("lo")) / bins)
    c = c.withColumns({"w0": F.sum("n").over(up), "s0": F.sum(F.col("n") * F.col("centre")).over(up), "w": F.sum("n").over(all_), "s": F.sum(F.col("n") * F.col("centre")).over(all_)})
    gap = F.try_divide(F.col("s0"), F.col("w0")) - F.try_divide(F.col("s") - F.col("s0"), F.col("w") - F.col("w0"))
    c = c.withColumn("between", F.col("w0") * (F.col("w") - F.col("w0")) * gap * gap).where((F.col("w") > F.col("w0")) & (F.col("bin") < bins - 1))
    best = c.withColumn("top", F.max("between").over(all_)).where(F.col("between") >= F.col("top") * (1 - 1e-9))
    return best.agg((F.avg("centre") if flat_top else F.min("centre")).alias("threshold"))


def auc(df: DataFrame, groups: list[str], value: str, positive: Column) -> DataFrame:
    """Rank AUC with average ranks for ties; missing values are left out, one class alone gives NULL.

    Values are counted first, so the ranking window holds one row for each distinct value.
    """
    tied = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.when(positive, 1)).alias("p"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy(*groups).orderBy(value).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranked = tied.withColumn("rank", before + (F.col("n") + 1) / 2)
    sums = ranked.groupBy(*groups).agg(F.sum(F.col("p") * F.col("rank")).alias("s"), F.sum("p").alias("np"), (F.sum("n") - F.sum("p")).alias("nn"))
    return sums.select(*groups, F.try_divide(F.col("s") - F.col("np") * (F.col("np") + 1) / 2, F.col("np") * F.col("nn")).alias("auc"), F.col("np").alias("positives"), F.col("nn").alias("negatives"))


def rank_features(df: DataFrame, features: list[str], positive: Column) -> DataFrame:
    """Features by how far their AUC is from a coin's."""
    long = df.select(positive.alias("_pos"), F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])).alias("e")).select("_pos", "e.*")
    return auc(long, ["feature"], "x", F.col("_pos")).withColumn("strength", F.abs(F.col("auc") - 0.5) * 2)


def average_rank(keys: list[str], value: str) -> Column:
    """Rank within the key, equal values sharing the mean of their ranks."""
    return F.rank().over(by(keys, value)) + (F.count("*").over(W.partitionBy(*keys, value)) - 1) / 2


def rank_correlation(df: DataFrame, keys: list[str], a: str, b: str, least: int = 5) -> DataFrame:
    """Spearman's correlation of the rows where both are known; NULL for few rows or a constant."""
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    ranked = both.withColumns({"_ra": average_rank(keys, a), "_rb": average_rank(keys, b)})
    return ranked.groupBy(*keys).agg(guarded_corr("_ra", "_rb", least).alias("rho"), F.count("*").alias("n"))


def guarded_corr(a: str, b: str, least: int) -> Column:
    """Pearson's correlation that is NULL for few rows or no variance; sums only, so that a constant raises nothing."""
    cov = F.avg(F.col(a) * F.col(b)) - F.avg(a) * F.avg(b)
    spread = F.sqrt(F.greatest(F.var_pop(a), F.lit(0.0)) * F.greatest(F.var_pop(b), F.lit(0.0)))
    return F.when((F.count("*") >= least) & (spread > 1e-12), cov / spread)


def histogram_percentile(df: DataFrame, keys: list[str], edge: str, count: str, width: float, q: float) -> DataFrame:
    """Percentile from merged histograms, linear within the bin that crosses it."""
    merged = df.groupBy(*keys, edge).agg(F.sum(count).alias("n"))
    w = by(keys, edge)
    c = merged.withColumns({"upto": F.sum("n").over(w), "goal": F.sum("n").over(W.partitionBy(*keys)) * q})
    hit = c.where("upto >= goal and n > 0").withColumn("r", F.row_number().over(w)).where("r = 1")
    return hit.select(*keys, (F.col(edge) + width * (F.col("goal") - (F.col("upto") - F.col("n"))) / F.col("n")).alias("percentile"))


def best_cut(df: DataFrame, value: str, flag: Column, least: int = 1, bins: int = 1024) -> DataFrame:
    """The cut ``value <= cut`` that puts most rows on the side of their majority; one row, ties to the lowest cut.

    Distinct values are counted, dealt into equal bins and added up within them; what stands below a bin comes from the
    bins' totals, a table of bounded size.  So no task orders more than a bin, and the cut is exact.
    """
    tied = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"), F.count(F.when(flag, 1)).alias("p"))
    ends = tied.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.sum("n").alias("tn"), F.sum("p").alias("tp"))
    place = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1))).otherwise(0).alias("bin")
    dealt = tied.join(F.broadcast(ends)).select(value, "n", "p", "tn", "tp", place)
    totals = dealt.groupBy("bin").agg(F.sum("n").alias("bn"), F.sum("p").alias("bp"))
    below = W.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select("bin", *[F.coalesce(F.sum(f"b{x}").over(below), F.lit(0)).alias(f"s{x}") for x in "np"])
    up = W.partitionBy("bin").orderBy(value)
    c = dealt.join(F.broadcast(totals), "bin").withColumns({"ln": F.sum("n").over(up) + F.col("sn"), "lp": F.sum("p").over(up) + F.col("sp")})
    right = F.greatest("lp", F.col("ln") - F.col("lp")) + F.greatest(F.col("tp") - F.col("lp"), F.col("tn") - F.col("ln") - F.col("tp") + F.col("lp"))
    c = c.withColumn("purity", F.round(right / F.col("tn"), 6)).where((F.col("ln") >= least) & (F.col("tn") - F.col("ln") >= least))
    return c.orderBy(F.desc("purity"), value).limit(1).select(F.col(value).alias("cut"), "purity")


def counted(df: DataFrame, value: str, parts: int = 64) -> DataFrame:
    """(value, n, _p): distinct values with their number, dealt to ranges; written once, as the ranges are drawn from a sample."""
    tied = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    return written(tied.repartitionByRange(parts, value).withColumn("_p", F.spark_partition_id()), "counted-values")


def counted_percentile(dealt: DataFrame, value: str, q: float, name: str) -> DataFrame:
    """One row: the exact percentile of ``counted`` values, linear between the two beside it. Only the ranges that hold
    these are ordered, so no task holds all values."""
    totals = dealt.groupBy("_p").agg(F.sum("n").alias("_n"))
    # ``parts`` rows.
    place = (F.sum("_n").over(W.partitionBy()) - 1) * F.lit(q)
    totals = totals.select("_p", "_n", (F.sum("_n").over(W.orderBy("_p")) - F.col("_n")).alias("_before"), place.alias("_at"))
    held = totals.where((F.ceil("_at") >= F.col("_before")) & (F.floor("_at") < F.col("_before") + F.col("_n")))
    upto = dealt.join(F.broadcast(held), "_p").withColumn("_upto", F.col("_before") + F.sum("n").over(W.partitionBy("_p").orderBy(value)))
    beside = upto.groupBy("_at").agg(*[F.min(F.when(F.col("_upto") > f(F.col("_at")), F.col(value))).alias(n) for n, f in (("_lo", F.floor), ("_hi", F.ceil))])
    return beside.select((F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_at") - F.floor("_at"))).alias(name))


def robust_z(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Distance from the group's median in units of its scaled median absolute deviation."""
    w = W.partitionBy(*group)
    mid = df.withColumn("_m", F.percentile(value, F.lit(0.5)).over(w)).withColumn("_d", F.abs(F.col(value) - F.col("_m")))
    mad = F.percentile("_d", F.lit(0.5)).over(w) * MAD_FACTOR
    return mid.withColumn("_mad", mad).withColumn("z", F.when(F.col("_mad") > 0, (F.col(value) - F.col("_m")) / F.col("_mad"))).drop("_m", "_d", "_mad")


def extremes(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Second lowest and second highest value, and their difference; NULL without two or four values."""
    sorted_ = df.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("s"))
    n = F.size("s")
    return sorted_.select(*keys, F.when(n >= 2, F.get("s", F.lit(1))).alias("second_low"), F.when(n >= 4, F.get("s", n - 2) - F.get("s", F.lit(1))).alias("swing"))


def sustained_low(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """The lowest value held for two rows running; a missing neighbour is ignored and the last row starts no pair."""
    w = by(keys, *order)
    pair = F.when(F.lead(F.lit(1)).over(w).isNotNull(), F.greatest(F.col(value), F.lead(value).over(w)))
    return df.withColumn("_held", pair).groupBy(*keys).agg(F.min("_held").alias("sustained_low"))
