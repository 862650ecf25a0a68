"""Benchmark decontamination by SimHash over item-sized windows, with DataFrame functions only.

A window holds as many shingles (five-word runs) as the item it is held against.  Documents that contain a window whose
weighted shingle similarity with an item (shingles weighted by how often they occur) is 0.75 or more are contaminated.

1. Windows.  A window can only qualify if enough of its shingles belong to *some* item of its size, and moving its start
   to the first of those loses none of them; so windows are made where a shingle of any item of that size stands and
   enough others lie within reach.  This says nothing about which item it may be.  Windows of equal content are one.
2. Fingerprints.  Each distinct window and each item gets a SimHash of ``BITS`` bits: two sums a counter lane.
3. Multi-index Hamming search.  Fingerprints are cut into ``BLOCKS`` blocks.  Two fingerprints at most
   ``RADIUS`` = BLOCKS * (FLIPS + 1) - 1 bits apart have a block in which at most ``FLIPS`` bits differ, so items are
   entered under every value of each block within ``FLIPS`` and the join on (size, block, value) finds all of them.
   Only this search says which item a window may hold.
4. The exact weighted similarity of the pairs within the radius decides.

At a similarity of 0.75 between sets of one size the cosine is 6/7 and 22 of 128 bits differ on average, with a standard
deviation of 4.3; the radius of 35 lies three deviations further, and random pairs, at 64, lie seven beyond it.

Defined results: null and empty texts have no shingle and are clean; texts and items under five words count as one
shingle, the whole sequence; very long texts are cut into windows like any other; repeated ids are judged row by row and
a document is contaminated if any of its rows is; equal items count once for each id; an empty benchmark leaves
everything clean; the document's own columns travel inside ``row``, so no name of theirs can clash.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.sources.scratch import release

from .common import let, materialise, row_id, table, words

SHINGLE = 5
SIMILAR_PER_CENT = 75
BITS, BLOCKS, FLIPS = 128, 12, 2
RADIUS = BLOCKS * (FLIPS + 1) - 1
#: A lane of a counter holds sums of up to 2**31 shingles.
LANE = (1 << 32) + 1


def _shingles(text: Column) -> Column:
    """Hashes of the text's five-word runs in order; one for a shorter text, none for an empty one."""

    def of(h: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(SHINGLE)]))
        return F.when(F.size(h) >= SHINGLE, runs).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words(F.lower(text)), lambda w: F.xxhash64(w)), of)


def fingerprints(rows: DataFrame, by: list[str], shingle: str) -> DataFrame:
    """``by`` and the SimHash (``lo``, ``hi``) of each group's shingles, one row for each occurrence.

    A shingle votes with its hash's bits.  Bits j and j + 32 of a hash are counted in the two halves of one sum.
    """
    halves = {"lo": F.col(shingle), "hi": F.xxhash64(F.lit(1), F.col(shingle))}
    sums = [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(LANE))).alias(f"{name}{j}") for name, h in halves.items() for j in range(32)]
    counted = rows.select(*by, shingle).groupBy(*by).agg(F.count("*").alias("votes"), *sums)
    bit = lambda count, at: F.call_function("shiftleft", F.when(2 * count > F.col("votes"), F.lit(1)).otherwise(F.lit(0)).cast("long"), at)

    def bits(name: str) -> Column:
        pairs = F.transform(F.array(*[F.col(f"{name}{j}") for j in range(32)]), lambda c, j: bit(c.bitwiseAND(F.lit((1 << 32) - 1)), j).bitwiseOR(bit(F.shiftrightunsigned(c, 32), j + 32)))
        return F.aggregate(pairs, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

    return counted.select(*by, bits("lo").alias("lo"), bits("hi").alias("hi"))


def _edges(block: int) -> tuple[str, int, int]:
    """Which half a block lies in, and its first and end bit there."""
    half = BLOCKS // 2
    name, at = ("lo", block) if block < half else ("hi", block - half)
    return name, round(at * 64 / half), round((at + 1) * 64 / half)


def _blocks(prints: DataFrame) -> DataFrame:
    """Fingerprints with (block, value), a row for each block."""
    parts = []
    for i in range(BLOCKS):
        name, a, b = _edges(i)
        parts.append(F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(F.col(name), a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).alias("value")))
    return prints.select("*", F.inline(F.array(*parts)))


def _masks(spark: SparkSession) -> DataFrame:
    """(block, mask): all changes of at most ``FLIPS`` bits of each block, a table of fixed size."""
    rows = []
    for i in range(BLOCKS):
        _, a, b = _edges(i)
        rows += [(i, sum(1 << x for x in c)) for k in range(FLIPS + 1) for c in combinations(range(b - a), k)]
    return spark.createDataFrame(rows, "block int, mask long")


def item_table(benchmark: DataFrame, item: str, item_text: str) -> DataFrame:
    """(item, iid, m, s): the items with their shingles; ``iid`` stands for one text."""
    items = benchmark.select(F.col(item).alias("item"), _shingles(F.col(item_text)).alias("s")).where(F.size("s") > 0)
    return items.select("item", F.xxhash64("s").alias("iid"), F.size("s").alias("m"), "s")


def candidate_windows(docs: DataFrame, items: DataFrame, key: str, text: str) -> DataFrame:
    """(id, m, start, w1, w2, s): windows of m shingles that may hold an item of that size; (w1, w2) stands for their content."""
    sizes = items.select("m", F.explode("s").alias("sh")).groupBy("sh").agg(F.collect_set("m").alias("sizes"))
    rid = row_id(F.col(key), F.col(text)).alias("id")
    placed = docs.select(rid, F.posexplode(_shingles(F.col(text))).alias("at", "sh"))
    hits = placed.join(sizes, "sh").select("id", "at", F.explode("sizes").alias("m"))
    ranked = hits.groupBy("id", "m").agg(F.sort_array(F.collect_set("at")).alias("ats"))
    need = F.floor((F.col("m") * SIMILAR_PER_CENT + 99) / 100).cast("int")
    # The k-th hit starts a window with enough hits if the hit need - 1 places further on lies within it.
    enough = F.filter("ats", lambda at, k: F.get("ats", k + F.col("need") - 1) < at + F.col("m"))
    ranked = ranked.where(F.size("ats") >= need).withColumn("need", need).select("id", "m", enough.alias("starts")).where(F.size("starts") > 0)
    touched = materialise(ranked.groupBy("id").agg(F.collect_list(F.struct("m", "starts")).alias("places")), "op8-places")

    full = docs.select(rid, F.col(text).alias("t")).join(touched, "id").dropDuplicates(["id"]).select("id", "places", _shingles(F.col("t")).alias("s"))
    # A window at the end of a text starts early enough to hold m shingles, if the text has so many; starts that then
    # coincide are one window.
    last = lambda m: F.greatest(F.lit(0), F.size("s") - m)
    held = F.flatten(F.transform("places", lambda p: F.transform(F.array_distinct(F.transform(p["starts"], lambda x: F.least(x, last(p["m"])))), lambda x: F.struct(p["m"].alias("m"), x.alias("start"), F.slice("s", x + 1, p["m"]).alias("w")))))
    windows = full.select("id", F.explode(held).alias("p")).select("id", "p.*")
    return windows.select("id", "m", "start", F.xxhash64("w").alias("w1"), F.xxhash64(F.lit(1), "w").alias("w2"), F.col("w").alias("s"))


def nearby(windows: DataFrame, items: DataFrame) -> DataFrame:
    """(m, w1, w2, iid): distinct windows and items whose fingerprints lie within the radius, found block by block."""
    key = ["m", "w1", "w2"]
    left = _blocks(fingerprints(windows.select(*key, F.explode("s").alias("sh")), key, "sh"))
    goals = _blocks(fingerprints(items.select("iid", "m", F.explode("s").alias("sh")), ["iid", "m"], "sh"))
    near = goals.join(F.broadcast(_masks(windows.sparkSession)), "block")
    right = near.select("iid", "m", "block", F.col("value").bitwiseXOR(F.col("mask")).alias("value"), F.col("lo").alias("glo"), F.col("hi").alias("ghi"))
    apart = F.bit_count(F.col("lo").bitwiseXOR(F.col("glo"))) + F.bit_count(F.col("hi").bitwiseXOR(F.col("ghi")))
    # The items' entries grow with the benchmark, so they are dealt out and never sent to every executor.
    return left.join(right.hint("merge"), ["m", "block", "value"]).where(apart <= RADIUS).select(*key, "iid").distinct()


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each row of ``docs`` (``id``: see ``row_id``) and item found in it: similarity and place."""
    named = item_table(benchmark, item, item_text)
    items = named.select("iid", "m", "s").dropDuplicates(["iid"])
    windows = materialise(candidate_windows(docs, items, key, text), "op8-windows")
    wkey = ["m", "w1", "w2"]
    # The same passage in many documents is fingerprinted and verified once.
    distinct = materialise(windows.groupBy(*wkey).agg(F.first("s").alias("s")), "op8-distinct")
    release(docs.sparkSession)
    near = nearby(distinct, items)

    # Exact: sum of the lesser weights over sum of the greater ones.
    weighed = distinct.join(near, wkey).select(*wkey, "iid", F.size("s").alias("here"), F.explode("s").alias("sh")).groupBy(*wkey, "iid", "here", "sh").agg(F.count("*").alias("w"))
    parts = items.select("iid", F.explode("s").alias("sh")).groupBy("iid", "sh").agg(F.count("*").alias("v"))
    both = weighed.join(parts, ["iid", "sh"]).groupBy(*wkey, "iid", "here").agg(F.sum(F.least("w", "v")).alias("both"))
    either = F.col("here") + F.col("m") - F.col("both")
    alike = both.where(100 * F.col("both") >= SIMILAR_PER_CENT * either).select(*wkey, "iid", (F.col("both") / either).alias("similarity"))
    best = windows.select("id", "start", *wkey).join(alike, wkey).groupBy("id", "iid").agg(F.max("similarity").alias("similarity"), F.min("start").alias("start"))
    return best.join(named.select("iid", "item"), "iid").select("id", "item", "similarity", "start")


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Columns: ``row`` (the whole row as a struct), ``n_items``, ``items`` (sorted ids; null: clean) and ``similarity``."""
    found = matches(docs, benchmark, key, text, **options).groupBy("id").agg(F.sort_array(F.collect_set("item")).alias("items"), F.max("similarity").alias("similarity"))
    rows = docs.select(row_id(F.col(key), F.col(text)).alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(found, "id", "left").select("row", F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"), "items", "similarity")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the benchmark items that it leaks and whether it is kept."""
    out = contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("row.doc_id", "n_items", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("item_ids"), F.round("similarity", 6).alias("similarity"), (F.col("n_items") > 0).alias("contaminated"), (F.col("n_items") == 0).alias("kept"))
