"""Clear-view masks: which optical values count, by tests on bands and quality bits and by scores relative to the cell's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import bits_set
from .robust import MAD_FACTOR, otsu
from .rules import sure

#: Fixed values of the mask: dark ground and haze in reflectance and greenness, the opaque-cloud bit, noises of tolerance.
DARK_NIR, DARK_NDVI = 1500, 0.30
HAZE_BLUE, HAZE_NDVI, HAZE_RATIO = 900, 0.30, 0.9
OPAQUE = 1 << 10
SCORE_CUT = 40
TOLERANCE = 2.0


def has_data(green: Column, red: Column, nir: Column, open_water: bool = False) -> Column:
    """Red and infrared above zero; with ``open_water`` infrared may be zero where green and red are not."""
    out = (red > 0) & (nir > 0)
    return sure(out | ((nir == 0) & (red > 0) & (green > 0)) if open_water else out)


def is_dark(nir: Column, ndvi: Column) -> Column:
    return sure((nir < DARK_NIR) & (ndvi < DARK_NDVI))


def is_haze(blue: Column, ndvi: Column, red: Column | None = None) -> Column:
    """Blue-bright canopy and, where red is given, blue-bright grey."""
    canopy = ndvi >= HAZE_NDVI
    return sure((blue > HAZE_BLUE) & (canopy if red is None else canopy | (blue >= HAZE_RATIO * red)))


def clear(data: Column, quality: Column, score: Column, nir: Column, ndvi: Column, cut: float | None, bits: int = OPAQUE, keep_dark: bool = False, blue: Column | None = None, red: Column | None = None) -> Column:
    """Data, none of the quality bits, a score at the cut or dark ground that is kept, and no haze where blue is given."""
    out = data & ~bits_set(quality, bits)
    if cut is not None:
        enough = sure(score >= cut)
        out = out & (enough | is_dark(nir, ndvi) if keep_dark else enough)
    return sure(out & ~is_haze(blue, ndvi, red) if blue is not None else out)


def lost_to(data: Column, quality: Column, score: Column, nir: Column, ndvi: Column, blue: Column, red: Column, cut: float = SCORE_CUT, bits: int = OPAQUE) -> Column:
    """The first test that removes a value: no_data, opaque, score, haze; or kept."""
    return F.when(~data, "no_data").when(bits_set(quality, bits), "opaque").when(~(sure(score >= cut) | is_dark(nir, ndvi)), "score").when(is_haze(blue, ndvi, red), "haze").otherwise("kept")


def scoreless_dates(df: DataFrame, date: list[str], score: str, data: Column) -> DataFrame:
    """Dates whose score is zero wherever there is data: it did not exist yet, which is unknown and not cloud."""
    return df.groupBy(*date).agg(F.count(F.when(data, 1)).alias("_n"), F.count(F.when(data & (F.col(score) > 0), 1)).alias("_s")).where("_n > 0 and _s = 0").select(*date)


def clear_limits(df: DataFrame, cell: list[str], score: str, k: float = TOLERANCE) -> DataFrame:
    """Per cell the lowest score that still counts as clear.

    Otsu's threshold parts all positive scores; a cell's limit is the median of its own clear ones less ``k`` times the
    root of its own and the whole area's squared spread; a cell without clear ones takes the threshold.
    """
    known = df.where(F.col(score) > 0).select(*cell, F.col(score).alias("_x"))
    split = otsu(known, "_x")
    up = known.join(F.broadcast(split), F.col("_x") >= F.col("threshold"))
    level = up.groupBy(*cell).agg(F.percentile("_x", F.lit(0.5)).alias("level"))
    own = up.join(level, cell).groupBy(*cell, "level").agg((MAD_FACTOR * F.percentile(F.abs(F.col("_x") - F.col("level")), F.lit(0.5))).alias("own"))
    middle = up.agg(F.percentile("_x", F.lit(0.5)).alias("_m"))
    area = up.join(F.broadcast(middle)).agg((MAD_FACTOR * F.percentile(F.abs(F.col("_x") - F.col("_m")), F.lit(0.5))).alias("area"))
    out = df.select(*cell).distinct().join(own, cell, "left").join(F.broadcast(split)).join(F.broadcast(area))
    return out.select(*cell, F.coalesce(F.col("level") - k * F.sqrt(F.col("own") ** 2 + F.coalesce("area", F.lit(0.0)) ** 2), F.col("threshold")).alias("limit"))


def clear_beside_best(df: DataFrame, cell: list[str], scene: str, score: str, ok: Column, k: float = TOLERANCE) -> DataFrame:
    """Rows with ``clear``: not more than ``k`` spreads of their best scene below the cell's own best score.

    A scene's spread is that of the scores of the cells whose best view it is; the first scene of equal scores is best.
    """
    valid = F.when(ok, F.struct(F.col(score).alias("v"), F.col(scene).alias("s")))
    top = df.groupBy(*cell).agg(F.max(F.when(ok, F.col(score))).alias("best"), F.min_by(F.col(scene), F.when(ok, F.struct((-F.col(score)).alias("v"), F.col(scene).alias("s")))).alias("best_scene"))
    top = top.where("best is not null")
    middle = top.groupBy("best_scene").agg(F.percentile("best", F.lit(0.5)).alias("_m"))
    spread = top.join(middle, "best_scene").groupBy("best_scene").agg((MAD_FACTOR * F.percentile(F.abs(F.col("best") - F.col("_m")), F.lit(0.5))).alias("spread"))
    limits = top.join(spread, "best_scene").select(*cell, (F.col("best") - k * F.col("spread")).alias("_limit"))
    return df.join(limits, cell, "left").withColumn("clear", sure(valid.isNotNull() & (F.col(score) >= F.col("_limit")))).drop("_limit")


def first_seen(df: DataFrame, cell: list[str], order: str, ok: Column) -> DataFrame:
    """Place of the first clear view of each cell, -1 where there is none."""
    place = F.row_number().over(W.partitionBy(*cell).orderBy(order)) - 1
    return df.withColumn("_p", place).groupBy(*cell).agg(F.coalesce(F.min(F.when(ok, F.col("_p"))), F.lit(-1)).alias("first_clear"))


def wet_flag(rain: Column, least: float) -> Column:
    """Rain of the day before at the threshold or over; unknown rain is none."""
    return F.coalesce(rain, F.lit(0.0)) >= least


def months_below(df: DataFrame, keys: list[str], day: str, least: int) -> DataFrame:
    """Months of a key with fewer distinct days than wanted."""
    return df.groupBy(*keys, F.trunc(day, "month").alias("month")).agg(F.countDistinct(F.to_date(day)).alias("days")).where(F.col("days") < least)
