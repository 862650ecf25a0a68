"""The two class rules: a field's class on its own scale, and the season class of a trough and climb."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .rules import decide, sure
from .temporal import by


@dataclass(frozen=True)
class OwnScale:
    """Fixed values of the own-scale rule: shares of a series' own range, and days.  Switches are off unless set."""

    tree_low: float = 0.45
    low_now: float = 0.6
    climbing: float = 0.2
    jump: float = 0.3
    rise_both: float = 0.5
    fast_days: float = 35
    harvest_left: float = 0.55
    ripen_days: float = 60
    held_left: float = 0.85
    held_days: float = 15
    young_days: float = 50
    depth: float = 3.0
    fit_never_empty: float = 0.6
    radar_top: float = 0.8
    age_low: float = 0.2
    views_min: float = 2
    fast_is_other: bool = True
    pond: bool = False
    pond_needs_no_crop: bool = False
    canopy_over_water: bool = False
    radar_without_views: bool = False
    story_in_gap: bool = False
    second_crop: bool = False
    tree_needs_dry: bool = False
    never_emptied: float | None = None
    young_after_water: bool = False
    young_while_low: bool = False
    young_needs_age: bool = False
    canopy_not_flooded: bool = False
    lone_low_days: float | None = None
    harvest_not_if_rising: bool = False
    newest_empty: bool = False
    tone_and_curve: bool = False
    harvest_needs_both: bool = False
    green_not_flooded: bool = False
    any_water: bool = False
    young_needs_water: bool = False
    young_min_rise: float | None = None
    dip_is_transplanted: bool = False

    def using(self, **switches) -> OwnScale:
        return replace(self, **switches)


#: The names of the classes.
TREE, OTHER, FLOODED, YOUNG, CUT = "tree/orchard", "other vegetation", "flooded / bare", "young rice", "rice harvested"
PLANTED, SEEDED = "rice standing transplanted", "rice standing direct seeded"


def known(df: DataFrame, column: str, default: float | None = None) -> Column:
    """The column, or the default where the frame has none; an unknown value stays unknown."""
    return F.col(column).cast("double") if column in df.columns else F.lit(default).cast("double")


class OwnScaleTests:
    """What the rule asks of a row; each test is true, false or, if it cannot be told, false."""

    def __init__(self, df: DataFrame, rule: OwnScale):
        c = self.c = lambda name, default=None: known(df, name, default)
        self.rule = rule
        self.spell = sure(c("water_spell", 0.0) == 1)
        self.deep = sure(c("water_depth", 0.0) >= rule.depth)
        self.water_now = sure(c("last_view_water", 0.0) == 1)
        self.low = sure(c("vh_pos_end") < rule.low_now)
        self.young_age = sure(c("crop_age") <= rule.young_days)
        self.rose = (sure(c("vh_rise_recent", 0.0) >= rule.rise_both) & sure(c("vv_rise_recent", 0.0) >= rule.rise_both)) | sure(c("vv_step_end", 0.0) >= rule.jump)
        self.slow = sure(c("ndvi_rise_days") >= rule.fast_days)
        self.grown = (self.slow if rule.fast_is_other else sure(c("ndvi_rise_days").isNotNull())) & sure(c("days_at_top") >= rule.held_days)
        self.cut_now = sure(c("ndvi_left") < rule.harvest_left)
        self.year_left = c("ndvi_left_year") if "ndvi_left_year" in df.columns else c("ndvi_left")
        self.empty_age = F.coalesce(c("days_since_ndvi_low"), c("crop_age"))
        self.both_fell = sure(c("vh_since_view") <= -rule.rise_both) & sure(c("vv_since_view") <= -rule.rise_both)
        self.both_rose = sure(c("vh_since_view") >= rule.rise_both) & sure(c("vv_since_view") >= rule.rise_both)
        self.radar_cut = sure(c("vh_fall_recent", 0.0) >= rule.rise_both) & sure(c("vv_fall_recent", 0.0) >= rule.rise_both)

    def standing(self, wet: Column | None = None) -> Column:
        return F.when(self.spell if wet is None else wet, PLANTED).otherwise(SEEDED)

    def by_age(self) -> Column:
        """A crop's class when only its curve is asked."""
        return F.when(sure(self.empty_age <= self.rule.young_days), YOUNG).otherwise(self.standing())


def own_scale_class(df: DataFrame, rule: OwnScale = OwnScale()) -> Column:  # noqa: B008
    """Class of a field's pixel from how its curve and its radar stand in their own ranges: the first test that holds
    names it, then the switched corrections of ``own_scale_corrections`` apply."""
    t = OwnScaleTests(df, rule)
    c = t.c
    first = []
    if rule.pond:
        green = sure(t.year_left >= rule.harvest_left) if rule.pond_needs_no_crop else F.lit(False)
        first.append((sure(c("dry_water_share", 0.0) >= 0.5) & ~green, F.lit(FLOODED)))
    if rule.canopy_over_water:
        first.append((t.low & sure(c("ndvi_left_year") >= 1.0) & sure(c("days_since_ndvi_low") > rule.young_days), t.standing(t.spell & (sure(c("crop_age") > rule.young_days) | t.deep))))
    if rule.radar_without_views:
        blind = t.spell & t.deep & sure(c("water_views_in_water", 1.0) == 0) & sure(c("views_in_water", 99.0) < rule.views_min)
        first.append((blind, F.when(t.low & ~t.rose, FLOODED).when(t.young_age, YOUNG).otherwise(PLANTED)))
    if rule.story_in_gap:
        paddy = t.spell | t.deep
        held = paddy | sure(c("water_depth", 0.0) > 0)
        age = F.when(~t.spell, c("radar_rise_days"))
        story = F.when(sure(c("ndvi_low_peak") >= rule.tree_low) & ~held, TREE).when(
            sure(t.year_left < rule.harvest_left), F.when(held & ~(t.water_now | (t.low & ~t.rose)), CUT).otherwise(FLOODED)
        ).when(sure(F.coalesce(age, c("crop_age")) <= rule.young_days), YOUNG).otherwise(t.standing(paddy))
        first.append((sure(c("rise_unseen", 0.0) == 1) | sure(c("crop_unseen", 0.0) == 1), story))
    if rule.second_crop:
        again = t.spell & t.deep & sure(c("crop_age") < c("days_off_top")) & sure(c("vh_pos_end") >= rule.low_now)
        first.append((again, F.when(t.young_age, YOUNG).otherwise(PLANTED)))
    first.append((sure(c("ndvi_low_peak") >= rule.tree_low) & (~t.spell if rule.tree_needs_dry else F.lit(True)), F.lit(TREE)))
    if rule.never_emptied is not None:
        always = (sure(c("ndvi_low_peak") >= rule.never_emptied) & ~t.spell) | sure(c("fit_low_peak", 0.0) >= rule.fit_never_empty)
        first.append((~sure(c("water_depth", 0.0) > 0) & always, F.lit(OTHER)))
    if rule.young_after_water:
        first.append((t.water_now & t.rose, F.lit(YOUNG)))
    climbing = sure(c("vh_slope_end") >= rule.climbing)
    if rule.young_while_low:
        first.append((t.low & sure(c("ndvi_left") >= 1.0) & sure(c("ndvi_slope_end") > 0) & (climbing | t.rose), F.lit(YOUNG)))
    low_now = t.low & ~t.grown
    if rule.young_needs_age:
        low_now = low_now & ~(sure(c("crop_age") > rule.young_days) & sure(c("ndvi_left") >= rule.held_left))
    coming = sure(c("days_since_peak") == 0) & sure(c("ndvi_slope_end") > 0) & (climbing | t.rose)
    if rule.canopy_not_flooded:
        closing = sure(c("ndvi_left") >= 1.0) & t.slow & ~coming
        first.append((low_now & closing, F.when(t.young_age, YOUNG).otherwise(t.standing())))
    first += [(low_now & coming, F.lit(YOUNG)), (low_now, F.lit(FLOODED))]
    if rule.fast_is_other:
        fast = sure(c("ndvi_rise_days") < rule.fast_days) | sure(c("ndvi_rise_seen") <= rule.fast_days)
        first.append((fast & ~sure(c("ndvi_left") >= rule.held_left) & ~sure(c("days_off_top") <= rule.ripen_days), F.lit(OTHER)))
    first.append((t.young_age & sure(c("ndvi_left") >= rule.held_left), F.lit(YOUNG)))
    if rule.harvest_not_if_rising:
        first.append((t.cut_now & t.rose & sure(c("vh_pos_end") >= rule.low_now), t.standing(t.spell | t.deep)))
    lone = F.lit(False)
    if rule.lone_low_days is not None:
        lone = sure(c("vh_pos_end") >= rule.radar_top) & sure(c("view_gap_days") <= rule.lone_low_days) & sure(c("ndvi_left_prev") >= rule.harvest_left)
    first.append((t.cut_now & ~lone, F.lit(CUT)))
    out = t.standing()
    for cond, value in reversed(first):
        out = F.when(cond, value).otherwise(out)
    return own_scale_corrections(df, out, rule)


def own_scale_corrections(df: DataFrame, code: Column, rule: OwnScale) -> Column:
    """Corrections that look at the class as it came, each behind its switch, in their order."""
    t = OwnScaleTests(df, rule)
    c, out = t.c, code
    if rule.newest_empty:
        out = F.when(sure(c("seen_on_latest") == 1) & sure(c("ndvi_left_year") <= rule.age_low), FLOODED).otherwise(out)
    if rule.harvest_needs_both:
        out = F.when((out == CUT) & ~t.radar_cut & ~t.both_fell, t.standing()).otherwise(out)
    if rule.tone_and_curve:
        green = ~t.water_now & sure(c("ndvi_left_year") >= 0.5)
        empty = ~t.water_now & ~green
        rice = out.isin(PLANTED, SEEDED, YOUNG)
        told = F.when(green & t.both_fell, CUT).when(green & out.isin(FLOODED, CUT), t.by_age())
        told = told.when(empty & rice & ~t.both_rose, F.when(t.radar_cut, CUT).otherwise(FLOODED)).when(t.water_now & out.isin(PLANTED, SEEDED), F.when(t.both_rose, YOUNG).otherwise(FLOODED))
        out = F.when(c("view_day").isNotNull(), F.coalesce(told, out)).otherwise(out)
    if rule.green_not_flooded:
        wet = t.spell & (sure(c("crop_age") > rule.young_days) | t.deep)
        out = F.when((out == FLOODED) & sure(c("ndvi_left_year") >= rule.harvest_left) & ~t.water_now, F.when(sure(t.empty_age <= rule.young_days), YOUNG).otherwise(t.standing(wet))).otherwise(out)
    if rule.any_water:
        out = F.when((out == SEEDED) & (sure(c("water_depth", 0.0) > 0) | t.spell | sure(c("water_views_in_water", 0.0) > 0)), PLANTED).otherwise(out)
    if rule.young_needs_water:
        out = F.when((out == YOUNG) & sure(c("water_depth") <= 0), SEEDED).otherwise(out)
    short = F.lit(False)
    if rule.young_min_rise is not None:
        short = sure(c("radar_rise_days") < rule.young_min_rise)
        watery = t.water_now | (t.low & sure(c("water_depth", 0.0) > 0))
        out = F.when((out == YOUNG) & short, F.when(watery, FLOODED).otherwise(t.standing(t.spell | t.deep))).otherwise(out)
    if rule.dip_is_transplanted:
        out = F.when((out == YOUNG) & t.spell & t.deep & ~short, PLANTED).otherwise(out)
    return out


def season_events(df: DataFrame, keys: list[str], idx: str, value: str, season: int) -> DataFrame:
    """Per key: the lowest value before the climb, the peak after it, the climb, the last value and what is left of it.

    The trough is the lowest row from ``season`` on that has a later row; of equal ones the last.
    """
    ahead = F.max(value).over(by(keys, idx).rowsBetween(1, W.unboundedFollowing))
    wide = df.withColumn("_ahead", ahead)
    low = F.when((F.col(idx) >= season) & F.col("_ahead").isNotNull(), F.struct((-F.col(value)).alias("v"), F.col(idx).alias("i"), F.col("_ahead").alias("p")))
    out = wide.groupBy(*keys).agg(F.max(low).alias("t"), F.max_by(F.col(value), F.struct(F.col(value).isNotNull(), F.col(idx))).alias("last"))
    rise = F.col("t.p") + F.col("t.v")
    return out.select(*keys, (-F.col("t.v")).alias("trough"), F.col("t.i").alias("trough_at"), F.col("t.p").alias("peak_after"), rise.alias("rise"), F.col("last"), (F.col("last") >= F.col("t.p") - 0.5 * rise).alias("standing"))


def season_class(wet: Column, never_bare: Column | None = None, valid: Column | None = None, low: float = 0.4, rise: float = 0.3, peak: float = 0.5, young_rise: float = 0.15, young_peak: float = 0.3, visible: float = 0.3) -> Column:
    """Class code of ``season_events``: 0 none, 1 standing, 2 young, 3 standing without water, 4 and 8 cut, 5 never bare, 6 young with water, 7 flooded, 255 no data.

    Later codes overwrite earlier ones, so the list stands in reverse.
    """
    is_low = sure(F.col("trough") <= low)
    grown = is_low & sure(F.col("rise") >= rise) & sure(F.col("peak_after") >= peak)
    young = is_low & ~grown & sure(F.col("rise") >= young_rise) & sure(F.col("peak_after") >= young_peak)
    standing, water = sure(F.col("standing")), sure(wet)
    crop = grown | young
    code = F.when(~crop & water & is_low, 7).when(young & water & sure(F.col("last") >= visible), 6).when(young, 2)
    code = code.when(grown & ~standing & water, 4).when(grown & ~standing, 8).when(grown & water, 1).when(grown, 3).otherwise(0)
    if never_bare is not None:
        code = F.when(sure(never_bare) & ~water & code.isin(1, 2, 3, 4, 6, 8), 5).otherwise(code)
    return (code if valid is None else F.when(sure(valid), code).otherwise(255)).cast("int")
