"""Column functions: signal scales, packed integers, grid arithmetic, names and free-text verdicts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: One acre in square metres, and the missing-value code of packed decibels.
ACRE_SQM = 4046.8564224
PACKED_MISSING = -32768
PACKED_LIMIT = 32767


def to_linear(db: Column) -> Column:
    """Decibels to power."""
    return F.pow(F.lit(10.0), db / 10)


def to_db(power: Column) -> Column:
    """Power to decibels; zero or less is missing."""
    return F.when(power > 0, 10 * F.log10(power))


def mean_db(db: Column) -> Column:
    """Mean of decibels, taken in power (an aggregate)."""
    return to_db(F.avg(to_linear(db)))


def pack(value: Column, scale: int = 100) -> Column:
    """Scaled 16-bit integer, halves rounded up and clamped; missing has a code of its own."""
    code = F.least(F.greatest(F.floor(value * scale + 0.5), F.lit(-PACKED_LIMIT)), F.lit(PACKED_LIMIT))
    return F.when(value.isNull(), F.lit(PACKED_MISSING)).otherwise(code).cast("int")


def unpack(code: Column, scale: int = 100, missing: int = PACKED_MISSING) -> Column:
    return F.nullif(code, F.lit(missing)) / scale


def steady_mean(value: str) -> Column:
    """Mean that doesn't hang on the order of the rows: equal means are equal, so that ties stay ties.

    Sums of doubles differ in the last place with the way the rows are dealt; decimals are added exactly.  A group with a
    value that 18 decimals don't hold (NaN, 1e9 or more, finer ones) has the plain mean.
    """
    c = F.col(value)
    d = F.when(F.abs(c) < 1e9, c.try_cast("decimal(38,18)"))
    return F.when(F.count(c) == F.count(F.when(d.cast("double") == c, 1)), F.avg(d).cast("double")).otherwise(F.avg(c))


def no_nan(value: Column) -> Column:
    """NaN as NULL: aggregates of the engine skip NULL but not NaN."""
    return F.nanvl(value, F.lit(None).cast("double"))


def pixel_id(row: Column, col: Column, width: int) -> Column:
    return (row * F.lit(width).cast("long") + col).cast("long")


def pixel_row(pid: Column, width: int) -> Column:
    return F.floor(pid / width).cast("long")


def pixel_col(pid: Column, width: int) -> Column:
    return F.pmod(pid, F.lit(width).cast("long"))


def chunk_of(pid: Column, width: int, chunk: int) -> Column:
    """Name of the square chunk that holds a pixel."""
    r, c = F.floor(pixel_row(pid, width) / chunk), F.floor(pixel_col(pid, width) / chunk)
    return F.concat(F.lit("r"), F.lpad(r.cast("string"), 3, "0"), F.lit("c"), F.lpad(c.cast("string"), 3, "0"))


def cell_of(x: Column, y: Column, size: float) -> Column:
    """Spatial block, for grouped validation."""
    return F.concat_ws("_", F.floor(x / size).cast("string"), F.floor(y / size).cast("string"))


def track_name(orbit: Column, ascending: Column) -> Column:
    return F.concat(F.lit("RO"), F.lpad(orbit.cast("string"), 3, "0"), F.when(ascending, "_ASC").otherwise("_DSC"))


def acres(pixels: Column, pixel_sqm: float = 100.0) -> Column:
    return pixels * pixel_sqm / ACRE_SQM


def half_month(day: Column) -> Column:
    """year * 1000 + month * 10 + (0 to the 15th, 1 after)."""
    return (F.year(day) * 1000 + F.month(day) * 10 + F.when(F.dayofmonth(day) > 15, 1).otherwise(0)).cast("int")


def bits_set(value: Column, bits: int) -> Column:
    return value.bitwiseAND(F.lit(bits)) != 0


def ordered_match(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The first rule whose needle the lower-cased text contains names the class."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = None
    for needle, name in rules:
        out = F.when(low.contains(needle), name) if out is None else out.when(low.contains(needle), name)
    return out.otherwise(F.lit(default))


def overlap_share(start: Column, end: Column, lo: Column, hi: Column) -> Column:
    """Share of the interval [start, end) that lies in [lo, hi)."""
    return F.greatest(F.lit(0.0), F.least(end, hi) - F.greatest(start, lo)) / (end - start)


def steps_touched(hi: Column, hours: float, step: float) -> Column:
    """How many fixed steps overlap the last ``hours`` before ``hi``."""
    return (F.ceil(hi / step) - F.floor((hi - hours) / step)).cast("int")


def short_name(text: Column, limit: int = 100) -> Column:
    """Allowed characters only; longer names end in a digest of the whole."""
    clean = F.regexp_replace(text, r"[^A-Za-z0-9_.,:;-]", "_")
    return F.when(F.length(clean) <= limit, clean).otherwise(F.concat(F.substring(clean, 1, limit - 9), F.lit("_"), F.substring(F.sha2(text.cast("binary"), 256), 1, 8)))


def slope_toward(slope_deg: Column, aspect_deg: Column, toward_deg: Column) -> Column:
    """Slope in the direction of the sensor, in degrees."""
    return F.degrees(F.atan(F.tan(F.radians(slope_deg)) * F.cos(F.radians(aspect_deg - toward_deg))))


def volume_factor(theta_deg: Column, slope_deg: Column) -> Column:
    return F.tan(F.radians(theta_deg - slope_deg)) / F.tan(F.radians(theta_deg))


def geometry_ok(theta_deg: Column, slope_deg: Column) -> Column:
    """Neither layover nor shadow."""
    return (slope_deg < theta_deg) & (slope_deg > theta_deg - 90)


def day_of_year(day: Column) -> Column:
    """1 to 366; an unknown day is 0."""
    return F.coalesce(F.dayofyear(day), F.lit(0))


def pixel_x(col: Column, x0: float, size: float) -> Column:
    """Centre of a column of cells."""
    return F.lit(x0) + (col + 0.5) * size


def pixel_y(row: Column, y0: float, size: float) -> Column:
    """Centre of a row of cells, counted downwards."""
    return F.lit(y0) - (row + 0.5) * size


def chunk_name(row: Column, col: Column) -> Column:
    return F.concat(F.lit("r"), F.lpad(row.cast("string"), 3, "0"), F.lit("c"), F.lpad(col.cast("string"), 3, "0"))


def task_key(track: Column, chunk: Column) -> Column:
    return F.concat_ws("__", track, chunk)


def month_week(day: Column) -> Column:
    """Week of the month with its first and last day: weeks start on the 1st, 8th, 15th and 22nd, the last one is longer."""
    number = F.least(F.floor((F.dayofmonth(day) - 1) / 7) + 1, F.lit(4)).cast("int")
    first = F.date_add(F.trunc(day, "month"), (number - 1) * 7)
    last = F.when(number == 4, F.last_day(day)).otherwise(F.date_add(first, 6))
    return F.concat(F.date_format(day, "yyyy-MM"), F.lit(" w"), number.cast("string"), F.lit(" ("), F.date_format(first, "dd"), F.lit("-"), F.date_format(last, "dd"), F.lit(")"))


def finite(*values: Column) -> Column:
    """All values are known numbers."""
    out = F.lit(True)
    for v in values:
        out = out & F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))
    return out


def direct_factor(theta_deg: Column, slope_range_deg: Column, slope_azimuth_deg: Column) -> Column:
    """cos(azimuth slope) * sin(theta - range slope) / sin(theta)."""
    return F.cos(F.radians(slope_azimuth_deg)) * F.sin(F.radians(theta_deg - slope_range_deg)) / F.sin(F.radians(theta_deg))


def steepest_fall(dx: Column, dy: Column) -> Column:
    """Azimuth in degrees, clockwise from north, in which a surface with these gradients falls most."""
    return F.pmod(F.degrees(F.atan2(-dx, -dy)), F.lit(360.0))


def backoff(attempt: Column, most: float = 60.0) -> Column:
    """Seconds before a further try: doubled each time up to ``most``."""
    return F.least(F.lit(most), F.pow(F.lit(2.0), attempt))


def headroom(limit: Column, queued: Column, margin: float, most: int | None = None) -> Column:
    """Free places of a queue under a margin, never below zero."""
    free = F.greatest(F.floor(limit * margin) - queued, F.lit(0))
    return free if most is None else F.least(free, F.lit(most))


def tone(ndvi: Column, lswi: Column, low: Column, high: Column) -> Column:
    """Water, green or empty: below zero or wetter than green, else by the middle of the cell's own range."""
    return F.when((ndvi < 0) | (lswi > ndvi), "water").when(ndvi >= (low + high) / 2, "green").when(ndvi.isNotNull(), "empty")


def seeded_digest(seed: int, *keys: Column) -> Column:
    """A digest of seed and keys: an order and a draw that any engine can repeat."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]).cast("binary"))


def seeded_share(seed: int, *keys: Column) -> Column:
    """A number from 0 up to 1 that seed and keys decide: ten hexadecimal digits of their digest."""
    return F.conv(F.substring(seeded_digest(seed, *keys), 1, 10), 16, 10).cast("double") / float(1 << 40)
