"""Sharding by a two-pass external shuffle that is written to shard folders.

Pass one scatters the rows, by seeded hashes of the key, into shards and inside them, by seeded hashes of key, text and
the row's place in the input, into buckets that fit in memory: a shard has as many as its own bytes ask for, so the rows
of one hot or null key are spread over many.  Pass two puts the rows of a bucket into a definite order, shuffles them
with Fisher-Yates (Spark's seeded ``shuffle``) and writes them; the slot of a row is its place after all rows of the
buckets before it.  The law is ``key``: the key and the number of shards alone decide the shard, by highest random
weight, so that one more shard takes rows only into itself.

What another run repeats: shards always.  Slots too, as long as the input is cut into the same splits: buckets are dealt
to a fixed number of partitions, each partition sorts its buckets, and the generator is seeded by ``seed`` and the
partition.

Defined results: null text has size 1 and the CRC of no bytes; a null key hashes as the text "null"; equal rows get
slots of their own; a text longer than a bucket fills one alone; an empty table gives no rows and an empty folder;
further columns travel unchanged inside ``row``, so no name of theirs can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.sources.scratch import scratch_path

from .common import materialise, table

#: Bytes of text that one bucket should hold.
BUCKET_BYTES = 8 << 20
#: Counts of at most so many buckets, a few megabytes, are broadcast.
BROADCAST_BUCKETS = 100_000


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """Highest random weight: the shard with the greatest seeded hash of (key, shard)."""
    name = F.coalesce(key.cast("string"), F.lit("null"))
    weights = [F.struct(F.xxhash64(F.lit(seed), name, F.lit(i)).alias("w"), F.lit(i).alias("i")) for i in range(shards)]
    return F.greatest(*weights)["i"] if shards > 1 else F.lit(0)


def scatter(docs: DataFrame, shards: int, seed: int, key: str, text: str, bucket_bytes: int) -> tuple[DataFrame, int]:
    """Pass one: ``shard``, ``bucket`` and the row as ``item``; and the number of buckets of all shards."""
    size = (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    own = shard_of(F.col(key), shards, seed)
    held = {r["shard"]: int(r["n"]) for r in docs.groupBy(own.alias("shard")).agg(F.sum(size).alias("n")).collect()}
    per_shard = [max(1, -(-held.get(i, 0) // bucket_bytes)) for i in range(shards)]
    bucket = F.pmod(F.xxhash64(F.lit(seed + 1), name, F.col(text), F.monotonically_increasing_id()), F.get(F.array(*map(F.lit, per_shard)), own)).cast("int")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (key, text)]
    tie = F.xxhash64(F.struct(*others).cast("string")) if others else F.lit(0).cast("long")
    item = F.struct(F.xxhash64(F.lit(seed + 2), name, F.col(text)).alias("h"), tie.alias("tie"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), size.alias("size"), shard_of(F.col(key), shards + 1, seed).alias("grown"))
    return docs.select(own.alias("shard"), bucket.alias("bucket"), item.alias("item")), sum(per_shard)


def write_shards(docs: DataFrame, path: str, shards: int = 8, seed: int = 17, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> None:
    """One folder a shard under ``path``; a bucket's rows stand together in the order of their slots (``bucket``, ``at``)."""
    dealt, buckets = scatter(docs, shards, seed, key, text, bucket_bytes)
    grouped = dealt.repartition(buckets, "shard", "bucket").groupBy("shard", "bucket").agg(F.collect_list("item").alias("items")).sortWithinPartitions("shard", "bucket")

    def before(a: Column, b: Column) -> Column:
        return F.when((a["h"] < b["h"]) | ((a["h"] == b["h"]) & (a["tie"] < b["tie"])), -1).when((a["h"] == b["h"]) & (a["tie"] == b["tie"]), 0).otherwise(1)

    mixed = grouped.select("shard", "bucket", F.shuffle(F.array_sort("items", before), F.lit(seed)).alias("items"))
    rows = mixed.select("shard", "bucket", F.posexplode("items").alias("at", "item")).select("shard", "bucket", "at", "item.row", "item.size", F.col("item.grown").alias("grown_shard"))
    rows.write.partitionBy("shard").option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """What ``write_shards`` wrote: ``row``, ``size``, ``shard``, ``grown_shard`` and ``slot``."""
    rows = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    counts = materialise(rows.groupBy("shard", "bucket").agg(F.count("*").alias("n")), "op9-counts")
    earlier = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    # A row for each few megabytes of text: broadcast up to a checked size, so that the rows needn't be dealt again.
    if counts.count() <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    return rows.join(offsets, ["shard", "bucket"]).select("row", "size", "shard", "grown_shard", (F.col("offset") + F.col("at")).alias("slot"))


def shard(docs: DataFrame, **options) -> DataFrame:
    """``docs`` written to shards in the shared folder and read back."""
    path = scratch_path(docs.sparkSession, "op9-shards")
    write_shards(docs, path, **options)
    row = ", ".join(f"`{f.name.replace('`', '``')}`: {f.dataType.simpleString()}" for f in docs.schema)
    return read_shards(docs.sparkSession, path, f"bucket int, at int, row struct<{row}>, size long, grown_shard int, shard int")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 under the ``key`` law, each row with its slot."""
    out = shard(table(spark, sf_dir, "documents"))
    crc = F.crc32(F.coalesce(F.col("row.text"), F.lit("")).cast("binary"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "size", crc.alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", "grown_shard")
