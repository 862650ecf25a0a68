"""Operators over dated series: sessions, gaps, windows, composites, fills, lookups and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def by(keys: list[str], *order: str):
    return W.partitionBy(*keys).orderBy(*order)


def sessions(df: DataFrame, keys: list[str], ts: str, tie: str, gap_seconds: float) -> DataFrame:
    """``session``: 1, 2, … a key; a new one where the step from the row before exceeds the gap."""
    w = by(keys, ts, tie)
    step = F.timestamp_diff("MICROSECOND", F.lag(ts).over(w), F.col(ts)) / 1e6
    return df.withColumn("_new", F.when(step.isNull() | (step > gap_seconds), 1).otherwise(0)).withColumn("session", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def session_summary(df: DataFrame, keys: list[str], ts: str, member: str) -> DataFrame:
    """One row a session: first time, members in order of name, size; same-day sessions are told apart by a suffix."""
    out = df.groupBy(*keys, "session").agg(F.min(ts).alias("first_ts"), F.array_join(F.array_sort(F.collect_set(F.col(member).cast("string"))), ";").alias("members"), F.count("*").alias("n"))
    nth = F.row_number().over(W.partitionBy(*keys, F.to_date("first_ts")).orderBy("first_ts", "session"))
    name = F.concat_ws("_", *keys, F.date_format("first_ts", "yyyyMMdd"))
    return out.withColumn("acquisition", F.when(nth > 1, F.concat_ws("_", name, nth.cast("string"))).otherwise(name))


def gaps(df: DataFrame, keys: list[str], day: str, longest: int, start: int, end: int) -> DataFrame:
    """(keys, gap_start, gap_end, gap_days): stretches without a row longer than ``longest`` days, the ends of the season included."""
    days = df.select(*keys, day).distinct()
    w = by(keys, day)
    inner = days.select(*keys, F.lag(day).over(w).alias("gap_start"), F.col(day).alias("gap_end"))
    ends = days.groupBy(*keys).agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    lead = ends.select(*keys, F.lit(start).alias("gap_start"), F.col("lo").alias("gap_end"))
    trail = ends.select(*keys, F.col("hi").alias("gap_start"), F.lit(end).alias("gap_end"))
    out = inner.where("gap_start is not null").unionByName(lead).unionByName(trail)
    return out.withColumn("gap_days", F.col("gap_end") - F.col("gap_start")).where(F.col("gap_days") > longest)


def window_spine(keys: DataFrame, start: int, end: int, step: int) -> DataFrame:
    """Every window start in [start, end) for every row of ``keys``."""
    return keys.withColumn("win", F.explode(F.sequence(F.lit(start), F.lit(end - 1), F.lit(step))))


def composite(df: DataFrame, keys: list[str], day: str, value: str, ok: Column, start: int, end: int, step: int, others: tuple[str, ...] = (), tie: str = "id") -> DataFrame:
    """The greatest clear value of each window (the earliest of equal ones) with the other columns of its row; empty windows stay."""
    win = (F.floor((F.col(day) - start) / step) * step + start).cast("int")
    rank = F.struct(F.col(value).alias("v"), (-F.col(day)).alias("d"), (-F.col(tie)).alias("t"))
    best = df.where(ok & F.col(day).between(start, end - 1)).groupBy(*keys, win.alias("win")).agg(F.max_by(F.struct(value, day, *others), rank).alias("best"))
    spine = window_spine(df.select(*keys).distinct(), start, end, step)
    return spine.join(best, [*keys, "win"], "left").select(*keys, "win", f"best.{value}", f"best.{day}", *[f"best.{c}" for c in others])


def gap_days(df: DataFrame, keys: list[str], idx: str, seen: Column, step: int) -> Column:
    """Days to the nearest seen window of the key; never seen: the whole length."""
    at = F.when(seen, F.col(idx))
    back = F.last(at, True).over(by(keys, idx).rowsBetween(W.unboundedPreceding, 0))
    ahead = F.first(at, True).over(by(keys, idx).rowsBetween(0, W.unboundedFollowing))
    near = F.least(F.col(idx) - back, ahead - F.col(idx))
    return F.coalesce(near * step, F.count("*").over(W.partitionBy(*keys)) * step).cast("int")


def neighbours(keys: list[str], idx: str, value: str) -> dict[str, Column]:
    """Place and value of the last known row up to this one and of the first from it on."""
    at = F.when(F.col(value).isNotNull(), F.struct(F.col(idx).alias("i"), F.col(value).alias("v")))
    back = F.last(at, True).over(by(keys, idx).rowsBetween(W.unboundedPreceding, 0))
    ahead = F.first(at, True).over(by(keys, idx).rowsBetween(0, W.unboundedFollowing))
    return {"_back": back, "_ahead": ahead}


def fill_linear(df: DataFrame, keys: list[str], idx: str, value: str, out: str, longest: int | None = None, hold: bool = True) -> DataFrame:
    """Linear between known values, held beyond them if ``hold``; stretches over ``longest`` stay empty."""
    wide = df.withColumns(neighbours(keys, idx, value))
    span = F.col("_ahead.i") - F.col("_back.i")
    line = F.col("_back.v") + (F.col("_ahead.v") - F.col("_back.v")) * (F.col(idx) - F.col("_back.i")) / F.when(span > 0, span)
    inside = F.coalesce(F.col(value), line if longest is None else F.when(span <= longest, line))
    ends = F.when(F.col("_back").isNull(), F.col("_ahead.v")).when(F.col("_ahead").isNull(), F.col("_back.v"))
    return wide.withColumn(out, F.coalesce(inside, ends) if hold else inside).drop("_back", "_ahead")


def fill_previous(df: DataFrame, keys: list[str], idx: str, value: str, out: str) -> DataFrame:
    """The last known value, before the first known one that one."""
    wide = df.withColumns(neighbours(keys, idx, value))
    return wide.withColumn(out, F.coalesce(F.col("_back.v"), F.col("_ahead.v"))).drop("_back", "_ahead")


def local_drop(keys: list[str], day: str, value: str, far: int, near: int) -> Column:
    """Median of the key's own values dated ``far`` to ``near`` days ago, less the value."""
    w = W.partitionBy(*keys).orderBy(day).rangeBetween(-far, -near)
    return F.percentile(value, F.lit(0.5)).over(w) - F.col(value)


def nearest(left: DataFrame, right: DataFrame, on: list[str], day: str, tolerance: int, tie: str, other: list[str]) -> DataFrame:
    """Each left row with the nearest right row of the same key within the tolerance, the earliest of equally near ones.

    The day axis is cut into buckets as wide as the tolerance; a left row meets its own bucket and the two beside it, so
    the join is an equi-join on (key, bucket) and a long series is not compared with itself as a whole.
    """
    width = tolerance + 1
    cells = left.withColumn("_cell", F.explode(F.sequence(F.floor((F.col(day) - tolerance) / width), F.floor((F.col(day) + tolerance) / width))))
    r = right.select(*on, F.floor(F.col(day) / width).alias("_cell"), F.col(day).alias("other_day"), *[F.col(c).alias(f"other_{c}") for c in other])
    met = cells.join(r, [*on, "_cell"]).where(F.abs(F.col("other_day") - F.col(day)) <= tolerance)
    rank = F.row_number().over(W.partitionBy(*on, tie).orderBy(F.abs(F.col("other_day") - F.col(day)), "other_day", *[f"other_{c}" for c in other]))
    return met.withColumn("_rank", rank).where("_rank = 1").drop("_rank", "_cell")


def asof(left: DataFrame, right: DataFrame, on: list[str], ts: str, value: str, out: str) -> DataFrame:
    """Each left row with the last right value at or before it: one union, one sort, no join."""
    l = left.select("*", F.lit(None).cast(right.schema[value].dataType).alias(out), F.lit(1).alias("_side"))  # noqa: E741
    r = right.select(*[F.col(c) if c in [*on, ts] else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns], F.col(value).alias(out), F.lit(0).alias("_side"))
    w = W.partitionBy(*on).orderBy(ts, "_side").rowsBetween(W.unboundedPreceding, 0)
    return l.unionByName(r).withColumn(out, F.last(out, True).over(w)).where("_side = 1").drop("_side")


def interval_hits(passes: DataFrame, points: DataFrame, on: list[str], ts: str, tie: str) -> DataFrame:
    """Passes, each with whether a point of the key falls in [pass, next pass); the last one lasts as long as the one before.

    Points take the pass before them as-of, so the interval join is a window over the union.
    """
    w = by(on, ts, tie)
    nxt = F.coalesce(F.lead(ts).over(w), F.col(ts) * 2 - F.lag(ts).over(w))
    p = passes.select(*on, ts, tie).withColumn("until", nxt)
    hit = asof(points.select(*on, ts).withColumn("_one", F.lit(1)), p.withColumn("_at", F.struct(F.col(ts).alias("t"), F.col("until").alias("u"), F.col(tie).alias("i"))), on, ts, "_at", "_pass")
    hit = hit.where(F.col(ts) < F.col("_pass.u")).groupBy(*on, F.col("_pass.i").alias(tie)).agg(F.count("*").alias("points"))
    return p.join(hit, [*on, tie], "left").withColumn("points", F.coalesce("points", F.lit(0)))


def aligned(series: DataFrame, events: DataFrame, on: list[str], day: str, event_day: str, first: int, last: int, step: int) -> DataFrame:
    """(…, rel): rows by whole steps since the key's own event."""
    out = series.join(events.select(*on, F.col(event_day).alias("_event")), on)
    rel = (F.round((F.col(day) - F.col("_event")) / step) * step).cast("int")
    return out.withColumn("rel", rel).where(F.col("rel").between(first, last)).drop("_event")


def last_k(df: DataFrame, keys: list[str], order: list[str], k: int) -> DataFrame:
    """The last k rows of each key; ``back`` counts from 1, the newest."""
    w = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("back", F.row_number().over(w)).where(F.col("back") <= k)


def troughs(keys: list[str], idx: str, value: str, rise: Column) -> Column:
    """Not above the row before, below the next, and some later row stands ``rise`` higher."""
    w = by(keys, idx)
    prev, nxt = F.lag(value).over(w), F.lead(value).over(w)
    later = F.max(value).over(w.rowsBetween(1, W.unboundedFollowing))
    return F.coalesce((prev.isNull() | (F.col(value) <= prev)) & (F.col(value) < nxt) & (later >= F.col(value) + rise), F.lit(False))


def runs(df: DataFrame, keys: list[str], idx: str, flag: Column) -> DataFrame:
    """Islands of consecutive rows with the flag: (keys, first, last, length)."""
    w = by(keys, idx)
    n = F.row_number().over(w)
    own = F.row_number().over(W.partitionBy(*keys, "_flag").orderBy(idx))
    marked = df.withColumn("_flag", flag).withColumn("_n", n).withColumn("_island", F.col("_n") - own).where("_flag")
    return marked.groupBy(*keys, "_island").agg(F.min(idx).alias("first"), F.max(idx).alias("last"), F.count("*").alias("length")).drop("_island")


def neighbour_count(keys: list[str], order: list[str], half: int) -> Column:
    """Rows within ``half`` places either side, itself included, clipped at the ends."""
    return F.count("*").over(by(keys, *order).rowsBetween(-half, half))


def speckle_mean(keys: list[str], order: list[str], raw: str, smooth: str, half: int) -> Column:
    """The smooth value times the mean ratio of raw to smooth over the neighbouring rows."""
    return F.col(smooth) * F.avg(F.try_divide(F.col(raw), F.col(smooth))).over(by(keys, *order).rowsBetween(-half, half))


def season_summary(df: DataFrame, keys: list[str], day: str, value: str, tie: str) -> DataFrame:
    """Least value and its day, the greatest on or after that day and its day, and the range."""
    low = F.min_by(F.col(day), F.struct(value, day, tie)).over(W.partitionBy(*keys))
    wide = df.withColumn("_low", low)
    after = F.when(F.col(day) >= F.col("_low"), F.struct(F.col(value).alias("v"), (-F.col(day)).alias("d")))
    out = wide.groupBy(*keys).agg(F.min(value).alias("v_min"), F.min("_low").alias("min_day"), F.max(after).alias("_top"), (F.max(value) - F.min(value)).alias("v_range"))
    return out.select(*keys, "v_min", "min_day", F.col("_top.v").alias("max_after"), (-F.col("_top.d")).alias("max_day"), "v_range")
