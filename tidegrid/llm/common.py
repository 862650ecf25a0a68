"""Helpers that the training-data operators share: tokens, folds and shared scratch tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.sources.scratch import written

#: Fixed value: the white space that separates words (space, tab to carriage return).
WORD_GAP = r"[\x20\x09-\x0D]+"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends there and a lost executor costs nothing."""
    return written(df, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, parts: int = 5) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key is in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(0)).cast("int")


def row_id(key: Column, text: Column) -> Column:
    """128 bits that stand for a row's key and text; a null differs from every value."""
    mark = lambda c: F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), c.cast("string")))
    return F.unhex(F.md5(F.concat(mark(key), F.lit("\x1f"), mark(text)).cast("binary")))


def words(text: Column) -> Column:
    """The words of a text, unchanged; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased; bytes.lower() touches ASCII letters only."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def pack(a: np.ndarray, width: int) -> bytes:
    """Little-endian bytes of ``a``, one plane after another: sorted and small values compress well."""
    return np.ascontiguousarray(a.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpack(b: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


# --- word hashes ------------------------------------------------------------

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: The inverse of an odd number modulo 2**64 exists, so a prefix sum can be brought back to position 0.
_BASE_INV = np.uint64(pow(int(_BASE), -1, 2**64))


#: Powers up to this many are kept; longer texts make their own.
_KEPT = 1 << 20
_kept_powers: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base squared, … : n of them; not to be written to."""
    have = _kept_powers.get(int(base))
    if have is None or len(have) < n:
        out = np.full(max(n, min(_KEPT, 2 * n, 1 << 16)), base, np.uint64)
        out[:1] = 1
        have = np.multiply.accumulate(out)
        if n <= _KEPT:
            _kept_powers[int(base)] = have
    return have[:n]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, first byte and end byte of each word of ``data``, without a loop over words."""
    raw = np.frombuffer(data, np.uint8)
    gap = _GAP[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start, end
    value = _BYTE[raw]
    value[gap] = 0
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * _powers(_BASE, len(raw)), dtype=np.uint64)))
    inverse = _powers(_BASE_INV, len(raw))[start]
    return mix64((sums[end] - sums[start]) * inverse + (end - start).astype(np.uint64)), start, end


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out = out * _BASE + h[j : j + m]
    return mix64(out)
