"""Events of a season: floods, dips, sowing, bare and harvested ground; each a window or a conditional aggregate by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .robust import MAD_FACTOR, pass_noise
from .rules import sure
from .temporal import by


def views_above(views: DataFrame, events: DataFrame, key: str, day: str, value: str, k: float) -> DataFrame:
    """Clear views after each key's event that stand ``k`` noises above its level; events: (key, event_day, level, noise)."""
    hit = sure((F.col(day) > F.col("event_day")) & (F.col(value) >= F.col("level") + k * F.coalesce("noise", F.lit(0.0))))
    return events.join(views, key, "left").groupBy(key).agg(F.count(F.when(hit, 1)).alias("views_above"))


def best_view_after(views: DataFrame, events: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """The highest clear view after the event; NULL without one."""
    return events.join(views, key, "left").groupBy(key).agg(F.max(F.when(F.col(day) > F.col("event_day"), F.col(value))).alias("best_after"))


def bare_near(views: DataFrame, events: DataFrame, key: str, idx: str, value: str, bare: float, before: int, after: int) -> DataFrame:
    """Whether no view from ``before`` windows ahead of the event to ``after`` behind it, or to the climb, contradicts bare ground.

    events: (key, at, climb) as window numbers.  A key that was never looked at in that time counts as bare.
    """
    around = (F.col(idx) >= F.col("at") - before) & (F.col(idx) <= F.greatest(F.col("at") + after, F.coalesce("climb", "at")))
    lowest = F.min(F.when(around, F.col(value)))
    return events.join(views, key, "left").groupBy(key).agg((~sure(lowest > bare)).alias("bare_near"))


def dips(passes: DataFrame, anchors: DataFrame, key: str, track: str, day: str, value: str, dry: tuple[int, int], flood: tuple[int, int]) -> DataFrame:
    """Per track: median over the dry days before the anchor, least over the flood days, and the fall between them."""
    gap = F.col(day) - F.col("anchor")
    x = passes.join(anchors, key).withColumn("_gap", gap)
    inside = lambda span: F.when(F.col("_gap").between(*span), F.col(value))
    out = x.groupBy(key, track).agg(F.percentile(inside(dry), F.lit(0.5)).alias("dry_level"), F.min(inside(flood)).alias("flood_level"))
    return out.withColumn("dip", F.col("dry_level") - F.col("flood_level"))


def best_dips(vv: DataFrame, vh: DataFrame, key: str, track: str, least: float = 3.0, other: float = -1.0, darkest: float = -18.0) -> DataFrame:
    """The greatest dip of either polarisation over tracks, whether it could be checked, and whether it tells of water:
    one fell enough, the other did not rise, and the ground ended dark."""
    best = lambda d, p: d.groupBy(key).agg(F.max("dip").alias(f"{p}_dip"), F.min("flood_level").alias(f"{p}_flood"))
    out = best(vv, "vv").join(best(vh, "vh"), key, "full_outer")
    fell = lambda a, b: sure(F.col(a) >= least) & ~sure(F.col(b) < other)
    checkable = F.col("vv_dip").isNotNull() | F.col("vh_dip").isNotNull()
    wet = checkable & (fell("vv_dip", "vh_dip") | fell("vh_dip", "vv_dip")) & ~sure(F.col("vh_flood") > darkest)
    return out.withColumns({"checkable": checkable, "wet": wet})


def brightening(passes: DataFrame, spans: DataFrame, key: str, track: str, day: str, value: str, n: int = 2, k: float = 2.0) -> DataFrame:
    """Whether the signal rose at an event: the largest step of ``n``-pass medians near it, in noises, joined over tracks.

    spans: (key, day, until); the passes run from the one nearest ``day`` to the one nearest ``until``, the earlier of
    equally near ones.
    """
    w = by([key, track], day)
    x = passes.where(F.col(value).isNotNull())
    noise = pass_noise(x, [key, track], [day], value).where("noise > 0")
    mid = lambda frame: F.percentile(value, F.lit(0.5)).over(frame)
    full = lambda frame: F.count("*").over(frame) == n
    ahead, behind = w.rowsBetween(0, n - 1), w.rowsBetween(-n, -1)
    step = F.when(full(ahead) & full(behind), mid(ahead) - mid(behind))
    x = x.withColumn("_step", step).join(noise, [key, track]).join(spans.select(key, F.col("day").alias("_a"), F.coalesce("until", "day").alias("_b")), key)
    near = lambda c: F.min(F.struct(F.abs(F.col(day) - F.col(c)).alias("g"), F.col(day).alias("d"))).over(W.partitionBy(key, track))["d"]
    x = x.withColumn("_na", near("_a")).withColumn("_nb", near("_b")).where(F.col(day).between(F.col("_na"), F.col("_nb")))
    each = x.groupBy(key, track, "noise").agg(F.max("_step").alias("_top")).where("_top is not null")
    z = F.col("_top") / (F.col("noise") * (2.0 / n) ** 0.5)
    return each.groupBy(key).agg((F.sum(z) / F.sqrt(F.count("*"))).alias("z")).withColumn("brightened", F.col("z") >= k)


def radar_sowing(passes: DataFrame, key: str, series: list[str], day: str, value: str, k: float = 2.0, least: int = 4) -> DataFrame:
    """Start of the standing crop from radar alone: the median over series of the last pass that is lower than all later
    ones, near the series' own low and followed by a rise, both in its own noise."""
    own = [key, *series]
    x = passes.where(F.col(value).isNotNull())
    w = by(own, day)
    later = F.min(value).over(w.rowsBetween(1, W.unboundedFollowing))
    back = F.row_number().over(W.partitionBy(*own).orderBy(F.desc(day)))
    x = x.withColumn("_later", later).withColumn("_back", back)
    stats = x.groupBy(*own).agg(F.get(F.array_sort(F.collect_list(value)), F.lit(1)).alias("_low2"), F.percentile(F.when(F.col("_back") <= 2, F.col(value)), F.lit(0.5)).alias("_end"), F.count("*").alias("_n"))
    x = x.join(stats, own).join(pass_noise(x, own, [day], value), own).where(F.col("_n") >= least)
    low = sure(F.col("_later").isNull() | (F.col(value) < F.col("_later"))) & sure(F.col(value) <= F.col("_low2") + k * F.col("noise")) & sure(F.col("_end") - F.col(value) >= k * F.col("noise"))
    found = x.where(low).groupBy(*own).agg(F.max(day).alias("_d"))
    return found.groupBy(key).agg(F.rint(F.percentile("_d", F.lit(0.5))).cast("int").alias("sowing"))


def bare_ceiling(lows: DataFrame, key: str, low: str, wobble: str, ground: Column, k: float = 2.0) -> DataFrame:
    """The highest value a trough may have: the level of the area's lows and its spread, or near the key's own low."""
    level = lows.where(ground).agg(F.percentile(low, F.lit(0.5)).alias("_m"))
    spread = lows.where(ground).join(F.broadcast(level)).groupBy("_m").agg((MAD_FACTOR * F.percentile(F.abs(F.col(low) - F.col("_m")), F.lit(0.5))).alias("_s"))
    own = F.coalesce(F.col(wobble), F.lit(0.0))
    return lows.join(F.broadcast(spread)).select(key, F.greatest(F.col("_m") + k * F.sqrt(F.col("_s") ** 2 + own**2), F.col(low) + k * own).alias("ceiling"))


def half_fall(df: DataFrame, keys: list[str], day: str, value: str, least: float) -> DataFrame:
    """First day after the peak at which the value has fallen halfway to its later low; NULL where it falls by less than ``least``."""
    peak = -F.max(F.struct(F.col(value).alias("v"), (-F.col(day)).alias("d"))).over(W.partitionBy(*keys))["d"]
    x = df.where(F.col(value).isNotNull()).withColumn("_pd", peak)
    after = x.where(F.col(day) >= F.col("_pd"))
    ends = after.groupBy(*keys).agg(F.max(value).alias("_top"), F.min(value).alias("_low"))
    hit = after.join(ends, keys).where(F.col(day) > F.col("_pd"))
    return hit.groupBy(*keys).agg(F.min(F.when((F.col("_top") - F.col("_low") >= least) & (F.col(value) <= (F.col("_top") + F.col("_low")) / 2), F.col(day))).alias("half_fall"))


def last_bare(df: DataFrame, events: DataFrame, key: str, idx: str, bare: Column) -> DataFrame:
    """The last bare window between the trough and the climb; events: (key, trough, climb)."""
    hit = bare & F.col(idx).between(F.col("trough"), F.col("climb"))
    return events.join(df, key, "left").groupBy(key).agg(F.max(F.when(hit, F.col(idx))).alias("bare_end"))


def drop_inside(df: DataFrame, spans: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Median of the whole series less its least value inside the key's own span; spans: (key, lo, hi)."""
    inside = F.when(F.col(day).between(F.col("lo"), F.col("hi")), F.col(value))
    return spans.join(df, key).groupBy(key).agg((F.percentile(value, F.lit(0.5)) - F.min(inside)).alias("drop"))


def onset(df: DataFrame, spans: DataFrame, key: str, idx: str, value: str) -> DataFrame:
    """Where an even series turns up most sharply between two places: the largest second difference of its slopes.

    Slopes are central differences, one-sided at the ends of the span; spans under four places have none.
    """
    x = df.join(spans, key).where(F.col(idx).between(F.col("lo"), F.col("hi")) & (F.col("hi") - F.col("lo") >= 3))

    def slope(c: str) -> Column:
        w = by([key], idx)
        prev, nxt = F.lag(c).over(w), F.lead(c).over(w)
        return F.when(prev.isNull(), nxt - F.col(c)).when(nxt.isNull(), F.col(c) - prev).otherwise((nxt - prev) / 2)

    curved = x.withColumn("_s", slope(value)).withColumn("_c", slope("_s"))
    return curved.groupBy(key).agg(F.when(F.count("*") == F.count(value), F.min_by(F.col(idx), F.struct((-F.round("_c", 9)).alias("c"), F.col(idx).alias("i")))).alias("onset"))


def first_past(df: DataFrame, keys: list[str], idx: str, value: str, level: Column, rising: bool = True) -> DataFrame:
    """First row at or past a level."""
    hit = F.col(value) >= level if rising else F.col(value) <= level
    return df.groupBy(*keys).agg(F.min(F.when(hit, F.col(idx))).alias("first_past"))


def last_flagged(df: DataFrame, keys: list[str], idx: str, flag: Column, before: int | None = None) -> DataFrame:
    """Place of the last row with the flag, -1 without one; ``before``: only places below it."""
    hit = flag if before is None else flag & (F.col(idx) < before)
    return df.groupBy(*keys).agg(F.coalesce(F.max(F.when(sure(hit), F.col(idx))), F.lit(-1)).alias("last"))


def durable_lows(df: DataFrame, key: str, idx: str, day: str, value: str, lows: Column, least: int) -> DataFrame:
    """Lows at which the series stays under the middle between the low and its lower neighbouring peak for ``least`` days.

    ``lows`` marks candidate rows; the neighbouring peaks are the highest values to the lows either side.
    """
    w = by([key], idx)
    x = df.withColumn("_low", sure(lows)).withColumn("_n", F.sum(F.col("_low").cast("int")).over(w))
    peaks = x.groupBy(key, F.col("_n").alias("_part")).agg(F.max(value).alias("_peak"))
    at = x.where("_low").select(key, "_n", F.col(idx).alias("_at"), F.col(value).alias("_v"))
    at = at.join(peaks.select(key, (F.col("_part") + 1).alias("_n"), F.col("_peak").alias("_left")), [key, "_n"], "left").join(peaks.select(key, F.col("_part").alias("_n"), F.col("_peak").alias("_right")), [key, "_n"], "left")
    at = at.withColumn("_level", F.col("_v") + (F.least("_left", "_right") - F.col("_v")) / 2)
    near = at.join(x.select(key, F.col(idx).alias("_i"), F.col(day).alias("_d"), F.col(value).alias("_x")), key)
    above = near.groupBy(key, "_at").agg(
        F.max(F.when((F.col("_i") < F.col("_at")) & (F.col("_x") > F.col("_level")), F.col("_i"))).alias("_a"), F.min(F.when((F.col("_i") > F.col("_at")) & (F.col("_x") > F.col("_level")), F.col("_i"))).alias("_b")
    )
    span = near.join(above, [key, "_at"]).where((F.col("_a").isNull() | (F.col("_i") > F.col("_a"))) & (F.col("_b").isNull() | (F.col("_i") < F.col("_b"))))
    return span.groupBy(key, F.col("_at").alias(idx)).agg((F.max("_d") - F.min("_d")).alias("low_days")).where(F.col("low_days") >= least)


def merge_series(main: DataFrame, other: DataFrame, key: str, day: str, value: str, tolerance: int) -> DataFrame:
    """The second track moved by the median of its offsets to the first near in time, then both as one series in order."""
    from .temporal import nearest

    met = nearest(other.withColumn("_row", F.monotonically_increasing_id()), main, [key], day, tolerance, "_row", [value])
    shift = met.groupBy(key).agg(F.percentile(F.col(f"other_{value}") - F.col(value), F.lit(0.5)).alias("_shift"))
    moved = other.join(shift, key).select(key, day, (F.col(value) + F.col("_shift")).alias(value), F.lit(1).alias("part"))
    return main.select(key, day, value, F.lit(0).alias("part")).unionByName(moved)
