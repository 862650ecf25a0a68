"""Season rules that read their levels from the area itself: peers, floods, cycles in season, radar masks, field status."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .robust import MAD_FACTOR, otsu
from .rules import sure
from .temporal import by

PEERS_MIN = 50


def peer_level(df: DataFrame, value: str, peer: Column, least: int = PEERS_MIN) -> DataFrame:
    """One row: median and scaled deviation of the peers' values; no row where there are too few."""
    own = df.where(sure(peer) & F.col(value).isNotNull())
    mid = own.agg(F.percentile(value, F.lit(0.5)).alias("peer_median"), F.count("*").alias("peers")).where(F.col("peers") >= least)
    return own.join(F.broadcast(mid)).groupBy("peer_median", "peers").agg((MAD_FACTOR * F.percentile(F.abs(F.col(value) - F.col("peer_median")), F.lit(0.5))).alias("peer_spread"))


def beside_peers(df: DataFrame, value: str, noise: str, level: DataFrame, k: float = 2.0) -> DataFrame:
    """``above``: distance over the peers' median in units of their spread and the row's own noise; ``reaches``: not more
    than k such units below it; NULL and false without enough peers."""
    x = df.join(F.broadcast(level), F.lit(True), "left")
    unit = F.sqrt(F.col("peer_spread") ** 2 + F.coalesce(noise, F.lit(0.0)) ** 2)
    out = x.withColumn("above", F.try_divide(F.col(value) - F.col("peer_median"), unit)).withColumn("reaches", sure(F.col(value) >= F.col("peer_median") - k * unit))
    return out.drop("peer_median", "peers", "peer_spread")


def after_flood(fits: DataFrame, floods: DataFrame, key: str, day: str, value: str, standing: float, fall: float) -> DataFrame:
    """The climb measured from the flood: value at its window, peak from there on, rise and whether the crop stands.

    floods: (key, flood). The flood's window is the first that does not begin before it, or the last one.
    """
    x = floods.join(fits, key)
    last = F.max(F.struct(F.col(day).alias("d"), F.col(value).alias("v")))
    at = F.min(F.when(F.col(day) >= F.col("flood"), F.struct(F.col(day).alias("d"), F.col(value).alias("v"))))
    got = x.groupBy(key).agg(F.coalesce(at, last).alias("a"), F.max(F.when(F.col(day) >= F.col("flood"), F.col(value))).alias("p"), last.alias("l"))
    peak = F.coalesce("p", F.col("l.v"))
    return got.select(key, F.col("a.v").alias("at_flood"), peak.alias("peak_after_flood"), (peak - F.col("a.v")).alias("rise_from_flood"), sure((F.col("l.v") >= standing) & (F.col("l.v") >= peak - fall)).alias("standing_after_flood"))


def last_low(fits: DataFrame, levels: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """The last window at or below the key's own level; where it never gets there, its lowest one, the last of equals."""
    x = fits.join(levels, key)
    low = F.max(F.when(F.col(value) <= F.col("level"), F.col(day)))
    return x.groupBy(key).agg(F.coalesce(low, -F.min(F.struct(F.col(value).alias("v"), (-F.col(day)).alias("d")))["d"]).alias("trough_day"))


def season_window(cycles: DataFrame, tolerance: int, cut: float | None = None) -> DataFrame:
    """One row: the centre of the area's own season, its first and last day and the growth that counts as strong.

    cycles: (…, peak_day, growth, complete). The centre is the median peak of strong, fully seen cycles; strong is Otsu's.
    """
    known = cycles.where(F.col("growth").isNotNull() & F.col("peak_day").isNotNull())
    level = otsu(known, "growth").select(F.col("threshold").alias("cut")) if cut is None else cycles.sparkSession.range(1).select(F.lit(float(cut)).alias("cut"))
    strong = known.join(F.broadcast(level)).where((F.col("growth") >= F.col("cut")) & sure(F.col("complete")))
    return strong.groupBy("cut").agg(F.percentile("peak_day", F.lit(0.5)).alias("centre")).select("centre", (F.col("centre") - tolerance).alias("first"), (F.col("centre") + tolerance).alias("last"), "cut")


def season_cycles(cycles: DataFrame, window: DataFrame, key: str) -> DataFrame:
    """The strongest cycle of each key whose peak lies in the season, the earliest of equal ones."""
    x = cycles.join(F.broadcast(window)).where(F.col("peak_day").between(F.col("first"), F.col("last")))
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.desc("growth"), "peak_day"))
    return x.withColumn("_r", rank).where("_r = 1").drop("_r")


def cycle_verdict(shortest: int, longest: int) -> Column:
    """The first test that a season cycle fails, or rice."""
    testable = F.col("wet").isNotNull()
    return F.when(~sure(F.col("complete")), "incomplete").when(~sure(F.col("growth") >= F.col("cut")), "weak").when(~sure(F.col("length") >= shortest), "too short").when(~sure(F.col("length") <= longest), "too long").when(testable & ~sure(F.col("wet")), "dry at sowing").otherwise("rice")


def split_high(df: DataFrame, value: str, name: str, above: bool = True, cut: float | None = None) -> DataFrame:
    """``name``: on which side of Otsu's threshold, or of a given cut, a value lies; unknown ones on neither."""
    level = otsu(df, value).select(F.col("threshold").alias("_cut")) if cut is None else df.sparkSession.range(1).select(F.lit(float(cut)).alias("_cut"))
    side = F.col(value) >= F.col("_cut") if above else F.col(value) <= F.col("_cut")
    return df.join(F.broadcast(level), F.lit(True), "left").withColumn(name, sure(side)).drop("_cut")


def two_stage_mask(levels: DataFrame, dry: str, sowing: str) -> DataFrame:
    """Ground that is dark when dry, then, among that, dark at sowing: both cuts are the area's own."""
    first = split_high(levels, dry, "cropland", above=False).withColumn("_s", F.when(F.col("cropland"), F.col(sowing)))
    return split_high(first, "_s", "flooded", above=False).drop("_s").withColumn("rice", F.col("cropland") & F.col("flooded"))


def radar_codes(cover: float = -18.0, support: int = 2, canopy: float = -18.0, climb: float = 3.0, fall: float = 3.0, young: float = -20.5) -> Column:
    """Codes from radar alone: 4 harvested, 1 canopy, 2 young, 7 flooded, 0 none."""
    c = lambda n: F.col(n)
    flood = sure(c("flood")) & sure(c("support") >= support) & ~sure(c("pre_min") > cover)
    grown = flood & sure(c("vh_end") >= canopy) & sure(c("climb") >= climb)
    cut = grown & sure(c("vh_fall") >= fall) & sure(c("vv_fall") >= fall)
    return F.when(cut, 4).when(grown, 1).when(flood & sure(c("vh_end") > young), 2).when(flood, 7).otherwise(0)


def half_month_rule(periods: DataFrame, key: str, period: str, now: int, flood: float, green: float, span: float, drop: float) -> DataFrame:
    """A rule over half-month medians: once dark in VV, green now, a season's swing, and not fallen from its top.

    ``now`` is the newest period; where it is unknown the one before speaks.
    """
    at = lambda p: F.max(F.when(F.col(period) == p, F.col("vh")))
    out = periods.groupBy(key).agg(F.max("vh").alias("vh_max"), F.min("vh").alias("vh_min"), F.min("vv").alias("vv_min"), F.coalesce(at(now), at(now - 1)).alias("vh_now"))
    flags = {"flooded": F.col("vv_min") < flood, "green": F.col("vh_now") > green, "seasonal": F.col("vh_max") - F.col("vh_min") > span, "uncut": F.col("vh_max") - F.col("vh_now") < drop}
    out = out.withColumns({n: sure(f) for n, f in flags.items()})
    return out.withColumn("rice", F.col("flooded") & F.col("green") & F.col("seasonal") & F.col("uncut"))


def persistent_floods(drops: DataFrame, anchors: DataFrame, key: str, track: str, day: str, drop: str, span: tuple[int, int], fell: float, days: int) -> DataFrame:
    """Per key over its tracks: the largest local drop near the anchor, its day, and on how many passes it stood."""
    rel = F.col(day) - F.col("anchor")
    x = drops.join(anchors, key).where(rel.between(*span) & F.col(drop).isNotNull())
    best = x.groupBy(key, track).agg(F.max(F.struct(F.col(drop).alias("v"), (-F.col(day)).alias("d"))).alias("b")).select(key, track, F.col("b.v").alias("best"), (-F.col("b.d")).alias("best_day"))
    held = x.join(best, [key, track]).where((F.abs(F.col(day) - F.col("best_day")) <= days) & (F.col(drop) >= fell)).groupBy(key, track).agg(F.count("*").alias("held"))
    each = best.join(held, [key, track], "left").withColumn("held", F.coalesce("held", F.lit(0)))
    return each.groupBy(key).agg(F.max(F.struct(F.col("best").alias("v"), F.col(track).alias("t"), F.col("best_day").alias("d"), F.col("held").alias("h"))).alias("b")).select(key, F.col("b.v").alias("flood_drop"), F.col("b.d").alias("flood_day"), F.col("b.h").alias("persist"))


def seen_again(drops: DataFrame, key: str, track: str, day: str, drop: str, fell: float, near: int) -> DataFrame:
    """Drops with a second witness: the next pass of the track is dark as well, or a pass of another track near in time."""
    w = by([key, track], day)
    x = drops.withColumn("_next", F.lead(drop).over(w)).where(F.col(drop) >= fell)
    others = x.select(key, F.col(track).alias("_t"), F.col(day).alias("_d"))
    met = x.select(key, track, day).join(others, key).where((F.col("_t") != F.col(track)) & (F.abs(F.col("_d") - F.col(day)) <= near)).select(key, track, day).distinct().withColumn("_other", F.lit(True))
    out = x.join(met, [key, track, day], "left")
    return out.where(sure(F.col("_next") >= fell) | sure(F.col("_other"))).select(key, track, day, drop)


def sowing_choice(found: DataFrame, late: int, tolerance: int) -> DataFrame:
    """The sowing and a code for its time: the newest trough; after the late day only with the radar's agreement, else the
    one before. found: (…, newest, previous, radar)."""
    agrees = sure(F.abs(F.col("radar") - F.col("newest")) <= tolerance)
    day = F.when((F.col("newest") <= late) | agrees, F.col("newest")).otherwise(F.coalesce("previous", "newest"))
    out = found.withColumn("sowing", day)
    code = F.when(F.col("sowing").isNull(), 0).when(F.col("sowing") <= late, 1).when(agrees & (F.col("sowing") == F.col("newest")), 2).otherwise(3)
    return out.withColumn("period", code)


STATUS = "struct<status:string,cut_from:double,cut_to:double,drop_share:double>"


def field_status(days: Column, values: Column, share: float = 0.3, last_views: int = 3) -> Column:
    """Standing or harvested from a field's curve: its newest views against its own green canopy.

    Canopy: median of the views in the upper half of the rise, the newest left out.  Harvested where the newest views lie
    more than ``share`` of the rise below it; the cut is the largest single step after the last view above that level.
    """

    def judge(d: np.ndarray, v: np.ndarray) -> dict:
        out = {"status": "no data", "cut_from": None, "cut_to": None, "drop_share": None}
        top = int(v.argmax()) if len(v) else 0
        if len(v) < 6 or top == 0:
            return out
        empty = v[:top].min()
        rise = v[top] - empty
        if rise <= 0:
            return out
        body = (np.arange(len(v)) < len(v) - last_views) & (v >= empty + rise / 2) & (np.arange(len(v)) >= v[:top].argmin())
        canopy = np.median(v[body]) if body.any() else v[top]
        now = np.median(v[-last_views:])
        if (v[-2] - v[-1]) / rise > share:
            now = min(now, v[-1])
        out["drop_share"] = float((canopy - now) / rise)
        level = canopy - share * rise
        if now >= level:
            return out | {"status": "standing"}
        above = np.flatnonzero(v >= level)
        first = int(above[-1]) if len(above) and above[-1] < len(v) - 1 else len(v) - 2
        k = first + 1 + int(np.argmax(v[first:-1] - v[first + 1 :]))
        return out | {"status": "harvested", "cut_from": float(d[k - 1]), "cut_to": float(d[k])}

    def run(ds: pd.Series, vs: pd.Series) -> pd.DataFrame:
        rows = []
        for d, v in zip(ds, vs, strict=True):
            d, v = np.asarray(d, float), np.asarray(v, float)
            known = np.isfinite(v)
            rows.append(judge(d[known], v[known]))
        return pd.DataFrame(rows, columns=["status", "cut_from", "cut_to", "drop_share"])

    return F.pandas_udf(run, STATUS)(days, values)


def factor_code(parts: list[tuple[str, Column]], none: str = "-") -> Column:
    """A code of one letter for each factor that holds."""
    return F.concat(*[F.when(sure(c), F.lit(n)).otherwise(F.lit(none)) for n, c in parts])
