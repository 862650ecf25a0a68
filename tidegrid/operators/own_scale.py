"""Features of a series on its own range: where its radar and its greenness stand, which way they move, water and age.

Every number is a share of the series' own range or a count of days, so no level of the signal appears.  Radar passes are
(key, track, day, vh, vv), one row a pass; clear views (key, day, ndvi, lswi); the fitted curve (key, day, fit, seen), one
row a window.  Each feature is a window or a conditional aggregate; what several tracks say is joined by their median.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .robust import pass_noise


@dataclass(frozen=True)
class Season:
    """Days that bound the parts of a season, and fixed values of the water tests."""

    water_from: int
    dry_until: int
    bottom: float = 0.15
    drop: float = 0.3
    spell_days: int = 15
    spell_passes: int = 2
    small: float = 0.5
    age_low: float = 0.2


POLS = ("vh", "vv")


def unknown_is_false(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def own_positions(passes: DataFrame, key: str, track: str) -> DataFrame:
    """Passes with ``vh_pos`` and ``vv_pos``: 0 at the track's own 10th percentile, 1 at its 90th; NULL without a range."""
    edges = passes.groupBy(key, track).agg(*[F.percentile(p, F.lit(q)).alias(f"_{p}{n}") for p in POLS for q, n in ((0.1, "l"), (0.9, "h"))])
    wide = passes.join(edges, [key, track])
    span = lambda p: F.when(F.col(f"_{p}h") > F.col(f"_{p}l"), F.col(f"_{p}h") - F.col(f"_{p}l"))
    return wide.select(*passes.columns, *[((F.col(p) - F.col(f"_{p}l")) / span(p)).alias(f"{p}_pos") for p in POLS], *[span(p).alias(f"{p}_span") for p in POLS])


def wet_passes(positions: DataFrame, key: str, track: str, day: str, season: Season) -> DataFrame:
    """``bottom``: both polarisations at the low end of their range; ``wet``: a fall into it, not before the water season.

    A fall is measured from the last pass that stood outside the bottom: ground that lies there from the start is dry.
    """
    w = W.partitionBy(key, track).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    bottom = unknown_is_false((F.col("vh_pos") <= season.bottom) & (F.col("vv_pos") <= season.bottom))
    known = F.col("vh_pos").isNotNull() & F.col("vv_pos").isNotNull()
    out = positions.withColumn("bottom", bottom)
    out = out.withColumn("_out", F.last(F.when(~F.col("bottom") & known, F.struct("vh_pos", "vv_pos")), True).over(w))
    fell = lambda p: F.col(f"_out.{p}_pos") - F.col(f"{p}_pos") >= season.drop
    wet = F.col("bottom") & unknown_is_false(fell("vh") & fell("vv")) & (F.col(day) >= season.water_from)
    return out.withColumn("wet", wet).drop("_out")


def tail_features(positions: DataFrame, key: str, track: str, day: str) -> DataFrame:
    """Per series: place, slope, step, acceleration, recent rise and fall over the last finite passes of either polarisation."""
    long = positions.select(key, track, day, F.explode(F.array(*[F.struct(F.lit(p).alias("pol"), F.col(f"{p}_pos").alias("x")) for p in POLS])).alias("e")).select(key, track, day, "e.*").where("x is not null")
    back = F.row_number().over(W.partitionBy(key, track, "pol").orderBy(F.desc(day)))
    last = long.withColumn("b", back).where("b <= 6")
    cols = []
    for p in POLS:
        at = lambda i, p=p: F.max(F.when((F.col("pol") == p) & (F.col("b") == i), F.col("x")))
        own = F.when(F.col("pol") == p, F.col("x"))
        two = F.avg(F.when(F.col("b") <= 2, own))
        cols += [two.alias(f"{p}_pos_end"), (at(1) - at(3)).alias(f"{p}_slope_end"), (at(1) - at(2)).alias(f"{p}_step_end"), (at(1) - 2 * at(2) + at(3)).alias(f"{p}_accel_end"), (two - F.min(own)).alias(f"{p}_rise_recent"), (F.max(own) - two).alias(f"{p}_fall_recent")]
    return last.groupBy(key, track).agg(*cols)


def climb_days(marked: DataFrame, key: str, track: str, day: str, season: Season) -> DataFrame:
    """Days from the last low pass before the radar's top to the newest pass; the top comes after the first bottom pass."""
    whole = W.partitionBy(key, track)
    late = F.col(day) >= season.water_from
    first = F.min(F.when(F.col("bottom") & late, F.col(day))).over(whole)
    wide = marked.withColumn("_first", first)
    high = F.when(late & F.col("vh_pos").isNotNull() & (F.col("_first").isNull() | (F.col(day) >= F.col("_first"))), F.struct(F.col("vh_pos").alias("v"), (-F.col(day)).alias("d")))
    wide = wide.withColumn("_top", -F.max(high).over(whole)["d"])
    low = F.when(late & (F.col("vh_pos") <= season.bottom) & (F.col(day) < F.col("_top")), F.col(day))
    return wide.groupBy(key, track).agg((F.max(day) - F.max(low)).alias("radar_rise_days"))


def water_depth(passes: DataFrame, key: str, track: str, day: str, season: Season) -> DataFrame:
    """The deepest fall of both polarisations under their own dry level, in units of their noise, over all tracks."""
    long = passes.select(key, track, day, F.explode(F.array(*[F.struct(F.lit(p).alias("pol"), F.col(p).alias("x")) for p in POLS])).alias("e")).select(key, track, day, "e.*")
    series = [key, track, "pol"]
    dry = long.groupBy(*series).agg(F.percentile(F.when(F.col(day) < season.dry_until, F.col("x")), F.lit(0.5)).alias("dry"), F.count(F.when(F.col(day) < season.dry_until, 1)).alias("dry_passes"))
    noise = pass_noise(long, series, [day], "x")
    fall = long.join(dry.where("dry_passes >= 2"), series).join(noise.where("noise > 0"), series).withColumn("fall", (F.col("dry") - F.col("x")) / F.col("noise"))
    both = fall.where(F.col(day) >= season.water_from).groupBy(key, track, day).agg(F.min("fall").alias("fall"))
    return both.groupBy(key).agg(F.max("fall").alias("water_depth"))


def change_since(positions: DataFrame, since: DataFrame, key: str, track: str, day: str) -> DataFrame:
    """``vh_since_view``, ``vv_since_view``: the last two passes less the last one up to ``since.day``, if any came after it."""
    x = positions.join(since.select(key, F.col("day").alias("_since")), key)
    parts = []
    for p in POLS:
        finite = F.when(F.col(f"{p}_pos").isNotNull(), F.struct(F.col(day).alias("d"), F.col(f"{p}_pos").alias("v")))
        before = F.max(F.when(F.col(day) <= F.col("_since"), finite))
        newest = F.slice(F.reverse(F.array_sort(F.collect_list(finite))), 1, 2)
        parts += [before.alias(f"_{p}b"), newest.alias(f"_{p}n")]
    got = x.groupBy(key, track).agg(*parts, F.max(day).alias("_last"))
    mean = lambda p: F.aggregate(F.col(f"_{p}n.v"), F.lit(0.0), lambda a, v: a + v) / F.size(f"_{p}n")
    per = got.select(key, *[F.when(F.col(f"_{p}b.d") < F.col("_last"), mean(p) - F.col(f"_{p}b.v")).alias(f"{p}_since_view") for p in POLS])
    return per.groupBy(key).agg(*[F.percentile(f"{p}_since_view", F.lit(0.5)).alias(f"{p}_since_view") for p in POLS])


def radar_features(passes: DataFrame, season: Season, key: str = "k", track: str = "track", day: str = "day") -> DataFrame:
    """One row a key: the tail of its series, its range in noises and its climb, each the median over tracks."""
    marked = wet_passes(own_positions(passes, key, track), key, track, day, season)
    spans = marked.groupBy(key, track).agg(*[F.max(f"{p}_span").alias(f"{p}_span") for p in POLS])
    for p in POLS:
        spans = spans.join(pass_noise(passes, [key, track], [day], p).withColumnRenamed("noise", f"_{p}noise"), [key, track], "left")
    spans = spans.select(key, track, *[F.when(F.col(f"_{p}noise") > 0, F.col(f"{p}_span") / F.col(f"_{p}noise")).alias(f"{p}_range_rel") for p in POLS])
    each = spans.join(tail_features(marked, key, track, day), [key, track], "left").join(climb_days(marked, key, track, day, season), [key, track], "left")
    names = [c for c in each.columns if c not in (key, track)]
    return each.groupBy(key).agg(*[F.percentile(c, F.lit(0.5)).alias(c) for c in names])


def view_features(views: DataFrame, season: Season, key: str = "k", day: str = "day", ndvi: str = "ndvi", lswi: str = "lswi") -> DataFrame:
    """One row a key from its clear views: what is left of the peak, the last step, the rise as seen, water."""
    v, d = F.col(ndvi), F.col(day)
    water = unknown_is_false((v < 0) | (F.col(lswi) > v))
    ends = views.groupBy(key).agg(F.min(v).alias("lo"), F.max(v).alias("pk"), F.min(F.struct(v.alias("v"), d.alias("d")))["d"].alias("low_day"), (-F.max(F.struct(v.alias("v"), (-d).alias("d")))["d"]).alias("peak_day"), F.max(d).alias("view_day"))
    x = views.join(ends, key)
    amp = F.col("pk") - F.col("lo")
    back = F.row_number().over(W.partitionBy(key).orderBy(F.desc(day)))
    at = lambda i: F.max(F.when(F.col("b") == i, v))
    near_low = F.max(F.when((d <= F.col("peak_day")) & (v <= F.col("lo") + 0.1 * amp), d)).over(W.partitionBy(key))
    x = x.withColumn("b", back).withColumn("near_low", near_low)
    near_top = F.min(F.when((d <= F.col("peak_day")) & (v >= F.col("lo") + 0.9 * amp) & (d >= F.col("near_low")), d))
    dry = d < season.dry_until
    out = x.groupBy(key, "lo", "pk", "low_day", "view_day", "near_low").agg(
        at(1).alias("last"), at(2).alias("prev"), near_top.alias("near_top"), F.max(F.when(F.col("b") == 1, water.cast("int"))).alias("last_view_water"),
        F.max(F.when(water, d)).alias("water_day"), F.max(F.when(v < 0, d)).alias("open_day"), F.avg(F.when(dry, water.cast("int"))).alias("dry_water_share"),
    )
    share = lambda c: F.when(amp > 0, c / amp)
    return out.select(
        key, F.when(F.col("pk") != 0, F.col("lo") / F.col("pk")).alias("ndvi_low_peak"), share(F.col("last") - F.col("lo")).alias("ndvi_left"), share(F.col("prev") - F.col("lo")).alias("ndvi_left_prev"),
        share(F.col("last") - F.col("prev")).alias("ndvi_slope_end"), (F.col("near_top") - F.col("near_low")).alias("ndvi_rise_seen"), (F.col("view_day") - F.col("low_day")).alias("days_since_ndvi_low"),
        "last_view_water", (F.col("last") < 0).cast("int").alias("last_view_open_water"), (F.col("view_day") - F.col("water_day")).alias("days_since_water_view"),
        (F.col("view_day") - F.col("open_day")).alias("days_since_open_water_view"), "dry_water_share", "view_day",
    )


def curve_marks(fits: DataFrame, season: Season, key: str = "k", day: str = "day") -> DataFrame:
    """One row a key from its fitted curve: low, rise and the days that mark them."""
    d, f = F.col(day), F.col("fit")
    peak = fits.where("fit is not null").groupBy(key).agg(F.max(F.struct(f.alias("v"), (-d).alias("d"))).alias("p"), F.min(f).alias("season_low"), F.max(f).alias("season_high"))
    last = fits.groupBy(key).agg(F.max(d).alias("end_day"))
    x = fits.join(peak.select(key, F.col("p.v").alias("top"), (-F.col("p.d")).alias("peak_day"), "season_low", "season_high"), key).join(last, key)
    x = x.withColumn("base", F.min(F.when(d <= F.col("peak_day"), f)).over(W.partitionBy(key)))
    rise = F.col("top") - F.col("base")
    before = d <= F.col("peak_day")
    keep = [key, "top", "base", "peak_day", "end_day", "season_low", "season_high"]
    return x.groupBy(*keep).agg(
        F.max(F.when(before & (f <= F.col("base") + 0.1 * rise), d)).alias("d10"), F.min(F.when(before & (f >= F.col("base") + 0.9 * rise), d)).alias("d90"),
        F.max(F.when(f >= F.col("base") + 0.9 * rise, d)).alias("last_top"), F.max(F.when(before & (f <= F.col("base") + season.age_low * rise), d)).alias("low_end"),
        F.array_sort(F.collect_list(F.when(F.col("seen"), d))).alias("seen_days"),
    )


def curve_features(marks: DataFrame, key: str = "k") -> DataFrame:
    rise = F.when(F.col("d90") > F.col("d10"), F.col("d90") - F.col("d10"))
    inside = F.size(F.filter("seen_days", lambda s: (s > F.col("d10")) & (s < F.col("d90"))))
    since = lambda c: (F.col("end_day") - F.col(c))
    return marks.select(
        key, F.when(F.col("season_high") != 0, F.col("season_low") / F.col("season_high")).alias("fit_low_peak"), rise.alias("ndvi_rise_days"), since("peak_day").alias("days_since_peak"),
        since("d90").alias("days_at_top"), since("last_top").alias("days_off_top"), since("low_end").alias("crop_age"), (rise.isNotNull() & (inside == 0)).cast("int").alias("rise_unseen"),
    )


def water_spells(marked: DataFrame, fits: DataFrame, marks: DataFrame, season: Season, step: int, key: str = "k", track: str = "track", day: str = "day") -> DataFrame:
    """``water_spell`` and the sowing day: wet passes of all tracks that follow one another while the crop was small.

    A pass takes the fitted share of the window nearest to it, the earlier of equally near ones.
    """
    grid = fits.groupBy(key).agg(F.min(day).alias("_w0"), F.max(day).alias("_w1"))
    at = F.greatest(F.col("_w0"), F.least(F.col("_w1"), F.col("_w0") + step * F.ceil((F.col(day) - F.col("_w0")) / step - 0.5))).cast("int")
    share = fits.join(marks.select(key, "base", "top"), key).select(key, F.col(day).alias("_win"), F.when(F.col("top") > F.col("base"), (F.col("fit") - F.col("base")) / (F.col("top") - F.col("base"))).alias("_share"))
    x = marked.join(grid, key).withColumn("_win", at).join(share, [key, "_win"], "left")
    x = x.withColumn("_m", (F.col("wet") & unknown_is_false(F.col("_share") < season.small)).cast("int"))
    ahead = F.sum("_m").over(W.partitionBy(key).orderBy(day).rangeBetween(0, season.spell_days))
    earlier = F.sum("_m").over(W.partitionBy(key, day).orderBy(track).rowsBetween(W.unboundedPreceding, 0)) - F.col("_m")
    spell = (F.col("_m") == 1) & (ahead - earlier >= season.spell_passes)
    got = x.withColumn("_spell", spell).groupBy(key).agg(F.max(F.col("_spell").cast("int")).alias("water_spell"), F.min(F.when(F.col("_spell"), F.col(day))).alias("_first"))
    out = marks.select(key, "low_end").join(got, key, "left")
    return out.select(key, F.coalesce("water_spell", F.lit(0)).alias("water_spell"), F.coalesce("_first", "low_end").alias("sowing_day"), F.when(F.col("_first").isNotNull(), 3).otherwise(0).alias("sowing_from"))


def own_scale_features(passes: DataFrame, views: DataFrame, fits: DataFrame, season: Season, step: int, digits: int = 2, whole: tuple[str, ...] = ()) -> DataFrame:
    """All features, one row a key ``k``; a key without radar or without views has NULL for those. Those named in
    ``whole`` are not rounded."""
    marked = wet_passes(own_positions(passes, "k", "track"), "k", "track", "day", season)
    marks = curve_marks(fits, season)
    seen = view_features(views, season)
    out = curve_features(marks).join(seen, "k", "left").join(radar_features(passes, season), "k", "left")
    out = out.join(water_depth(passes, "k", "track", "day", season), "k", "left").join(water_spells(marked, fits, marks, season, step), "k", "left")
    out = out.join(change_since(marked, seen.select("k", F.col("view_day").alias("day")), "k", "track", "day"), "k", "left")
    return out.select("k", *[(F.col(c).cast("double") if c in whole else F.round(F.col(c).cast("double"), digits)).alias(c) for c in out.columns if c != "k"])
