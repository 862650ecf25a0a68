"""Language-model scoring by deleted interpolation of n-grams up to ``order``: trigrams, bigrams and unigrams.

The probability of a token is a mixture of its trigram, bigram and unigram maximum-likelihood estimates and a uniform
one; with ``order`` 2 there are no trigrams.  The mixture weights depend on how often the context occurs: buckets of powers of two of the trigram context's
count or, where that context was never seen, of the bigram context's.  They are learned by expectation-maximisation on
held-out counts: every training token is deleted from the counts once and predicted from the rest.

Counting is one exchange of packed blocks instead of a row for each token.  Documents are packed into chunks; a chunk
sends its distinct words, word pairs and word triples with their training counts to hash buckets; a bucket adds the
counts of all chunks and sends each chunk the totals back in the order it asked.  A frequent word is one entry a chunk,
so no bucket is hot.  A chunk sends a bucket nothing if it has no key for it, so there are at most as many requests as
keys and what travels is linear in the tokens; the number of buckets follows the number of tokens, so a bucket's size is
bounded.

In a bucket, which is named by the first bits of a hash and holds about two million tokens, words are told apart by 48
further bits and pairs and triples by 32 (about two of those in 10,000 are so mixed up); totals hold 48 bits.
Defined results: null and empty texts are one end token; very long texts make a chunk of their own; a null key is in fold
0, so it trains; equal rows score alike; an empty table gives no rows; without training documents every count is zero;
only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.sources.scratch import release

from .common import _BASE, ascii_lower, fold, materialise, mix64, pack, table, unpack, word_hashes

CHUNK_TOKENS = 200_000
BUCKET_TOKENS = 2_000_000
#: Bit lengths that a context's count can have, 0 to 48.
LEVELS = 49
#: Before expectation-maximisation, estimates are put on a grid of half powers of two.
GRID, GRID_STEPS = 2, 98
ROUNDS, LEAST_UNIFORM = 60, 1e-3
#: Orders of the mixture's parts: triple, pair, word, uniform.
PARTS = 4
END, START = np.uint64(0x5DEECE66D1234567), np.uint64(0xA24BAED4963EE407)
#: Bits of a word's and of another key beside its bucket's bits, and bytes of a total.
WORD_BITS, KEY_BITS, TOTAL_BYTES = 48, 32, 6
KINDS = ("words", "pairs", "triples")
ORDER = 3


CHUNK = "chunk long, ids array<long>, train binary, lengths binary, tokens binary, vocab binary, n long, n_train long, docs_train long"


def to_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, serial = TaskContext.get().partitionId(), 0
    schema = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("train", pa.binary()), ("lengths", pa.binary()), ("tokens", pa.binary()), ("vocab", pa.binary()), ("n", pa.int64()), ("n_train", pa.int64()), ("docs_train", pa.int64())])
    ids, train, hashes, held = [], [], [], 0

    def close() -> pa.RecordBatch:
        lengths = np.array([len(h) for h in hashes], np.uint64)
        flags = np.array(train, bool)
        vocab, back = np.unique(np.concatenate(hashes), return_inverse=True)
        row = [(task << 32) + serial, ids, flags.astype(np.uint8).tobytes(), pack(lengths, 4), shut(back.astype(np.uint64), 4), squeeze(vocab, 0, 64), int(lengths.sum()), int(lengths[flags].sum()), int(flags.sum())]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    for b in batches:
        for k, t, learn in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
            h = np.append(word_hashes(ascii_lower(t.as_py()))[0], END)
            ids.append(k)
            train.append(learn)
            hashes.append(h)
            held += len(h)
            if held >= CHUNK_TOKENS:
                yield close()
                serial += 1
                ids, train, hashes, held = [], [], [], 0
    if ids:
        yield close()


def one_by_one(b: pa.RecordBatch) -> Iterator[dict]:
    """The rows as dictionaries, one at a time: a row holds megabytes."""
    for i in range(b.num_rows):
        yield b.slice(i, 1).to_pylist()[0]


class Chunk:
    """A chunk's tokens, word pairs and triples, the same each time it is read."""

    def __init__(self, train: bytes, lengths: bytes, tokens: bytes, vocab: bytes, order: int):
        self.order = order
        self.vocab = stretch(vocab, 64)
        self.tokens = opened(tokens, 4).astype(np.int64)
        self.lengths = unpack(lengths, 4).astype(np.int64)
        self.flags = np.frombuffer(train, np.uint8).astype(bool)
        self.starts = starts_of(self.lengths)
        self.learn = np.repeat(self.flags, self.lengths)

    def keys(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distinct keys in ascending order and each token's place among them: of words, pairs and, by the order, triples."""
        own = self.vocab[self.tokens]
        yield self.vocab, self.tokens
        pairs = mix64(shifted(own, self.starts, START) * _BASE + own)
        yield np.unique(pairs, return_inverse=True)
        if self.order < 3:
            return
        yield np.unique(mix64(shifted(pairs, self.starts, START) * _BASE + own), return_inverse=True)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)


def shifted(a: np.ndarray, starts: np.ndarray, first) -> np.ndarray:
    """What precedes each element in its document; ``first`` at the documents' starts."""
    out = np.concatenate((a[:1], a[:-1]))
    out[starts] = first
    return out


def slices(keys: np.ndarray, bits: int) -> np.ndarray:
    """Edges of the buckets in sorted keys; a bucket holds the keys with the same ``bits`` high bits."""
    inner = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(0, np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, inner), [len(keys)])).astype(np.int64)


def shut(a: np.ndarray, width: int) -> bytes:
    """Packed numbers, compressed: keys' differences and counts are mostly small, which the exchange's own codec leaves long."""
    planes = pack(a, width)
    return len(planes).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def opened(data: bytes, width: int) -> np.ndarray:
    size = int.from_bytes(data[:4], "little")
    return unpack(pa.decompress(data[4:], size, codec="zstd", asbytes=True), width)


def squeeze(keys: np.ndarray, bits: int, kept: int) -> bytes:
    """Sorted keys of one bucket as differences of the ``kept`` bits after the bucket's."""
    rest = ((keys << np.uint64(bits)) if bits else keys) >> np.uint64(64 - kept)
    return shut(np.diff(rest, prepend=np.uint64(0)), -(-kept // 8))


def stretch(data: bytes, kept: int) -> np.ndarray:
    return np.cumsum(opened(data, -(-kept // 8)), dtype=np.uint64)


def bits_of(kind: str) -> int:
    return WORD_BITS if kind == "words" else KEY_BITS


def request_schema(order: int) -> str:
    return "bucket int, chunk long, " + ", ".join(f"{k} binary, {k}_counts binary" for k in KINDS[:order])


def requests(bits: int, order: int = ORDER):
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64())] + [(n, pa.binary()) for k in KINDS[:order] for n in (k, f"{k}_counts")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in one_by_one(b):
                c = Chunk(r["train"], r["lengths"], r["tokens"], r["vocab"], order)
                cols, used = [], np.zeros(1 << bits, bool)
                for kind, (keys, back) in zip(KINDS[:order], c.keys(), strict=True):
                    counts = np.bincount(back, weights=c.learn, minlength=len(keys)).astype(np.uint64)
                    at = slices(keys, bits)
                    used |= at[1:] > at[:-1]
                    cols.append([squeeze(keys[a:z], bits, bits_of(kind)) for a, z in zip(at, at[1:], strict=False)])
                    cols.append([shut(counts[a:z], 4) for a, z in zip(at, at[1:], strict=False)])
                some = np.flatnonzero(used)
                row = [some, np.full(len(some), r["chunk"]), *([col[i] for i in some] for col in cols)]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    return run


def reply_schema(order: int) -> str:
    return "chunk long, bucket int, " + ", ".join(f"{k} binary" for k in KINDS[:order]) + ", v long, n long"


def totals(order: int = ORDER):
    """Counts of a bucket's keys over all chunks, for each chunk in its own order; the row without a chunk has V and N."""
    kinds = KINDS[:order]
    schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), *((k, pa.binary()) for k in kinds), ("v", pa.int64()), ("n", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        def add(kind: str) -> tuple[list[bytes], np.ndarray]:
            own = [stretch(k.as_py(), bits_of(kind)) for k in group[kind]]
            keys, back = np.unique(np.concatenate(own), return_inverse=True)
            got = np.zeros(len(keys), np.uint64)
            np.add.at(got, back, np.concatenate([opened(c.as_py(), 4) for c in group[f"{kind}_counts"]]))
            return [shut(x, TOTAL_BYTES) for x in np.split(got[back], np.cumsum([len(x) for x in own])[:-1])], got

        chunks, bucket = group["chunk"].to_pylist(), group["bucket"][0].as_py()
        sent = {kind: add(kind) for kind in kinds}
        got = sent["words"][1]
        cols = [[*chunks, None], [bucket] * (len(chunks) + 1), *([*sent[k][0], None] for k in kinds), [*[None] * len(chunks), int((got > 0).sum())], [*[None] * len(chunks), int(got.sum())]]
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(cols, schema, strict=True)], schema=schema)

    return run


def counted_schema(order: int) -> str:
    return "ids array<long>, train binary, lengths binary, " + ", ".join(f"{k} binary" for k in KINDS[:order])


def counted(order: int = ORDER):
    """Each token's count and those of the pair and the triple it ends, from the totals sent back."""
    kinds = KINDS[:order]
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("train", pa.binary()), ("lengths", pa.binary()), *((k, pa.binary()) for k in kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in one_by_one(b):
                c = Chunk(r["train"], r["lengths"], r["tokens"], r["vocab"], order)
                replies = sorted(r["replies"], key=lambda x: x["bucket"])
                row = [r["ids"], r["train"], r["lengths"]]
                for kind, (_, back) in zip(kinds, c.keys(), strict=True):
                    row.append(shut(np.concatenate([opened(x[kind], TOTAL_BYTES) for x in replies])[back], TOTAL_BYTES))
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    return run


class Tokens:
    """Counts of a chunk's tokens and of their contexts."""

    def __init__(self, r: dict, docs_train: int):
        self.lengths = unpack(r["lengths"], 4).astype(np.int64)
        self.starts = starts_of(self.lengths)
        self.train = np.frombuffer(r["train"], np.uint8).astype(bool)
        self.own, self.pair = (opened(r[k], TOTAL_BYTES).astype(np.int64) for k in KINDS[:2])
        # Without triples every wide context counts as never seen.
        self.triple = opened(r["triples"], TOTAL_BYTES).astype(np.int64) if "triples" in r else np.zeros_like(self.own)
        # A word or pair is the context of as many tokens as it occurs; the start of a document, of its first token.
        self.context = shifted(self.own, self.starts, docs_train)
        self.wide_context = shifted(self.pair, self.starts, docs_train) if "triples" in r else np.zeros_like(self.own)


def bucket_of(wide: np.ndarray, narrow: np.ndarray) -> np.ndarray:
    """Number of the weights' bucket: the level of the pair before the token, or below LEVELS that of the word before it."""
    level = lambda x: np.frexp(np.maximum(x, 0).astype(float))[1]
    return np.where(wide > 0, LEVELS + level(wide), level(narrow))


def grid(p: np.ndarray) -> np.ndarray:
    """0 for nothing, else the place of log2 p on the grid."""
    safe = np.where(p > 0, p, 1.0)
    return np.where(p > 0, np.clip(GRID_STEPS - 1 + np.rint(GRID * np.log2(safe)), 1, GRID_STEPS - 1), 0).astype(np.int64)


def deleted_cells(n: int, docs_train: int):
    """(cell, tokens) of the training tokens, each predicted from the counts without itself."""
    schema = pa.schema([("cell", pa.int64()), ("tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in one_by_one(b):
                t = Tokens(r, docs_train)
                learn = np.repeat(t.train, t.lengths)
                less = lambda a: a[learn] - 1  # noqa: B023, E731
                wide, narrow = less(t.wide_context), less(t.context)
                cell = bucket_of(wide, narrow)
                for count, of in ((t.triple, wide), (t.pair, narrow), (t.own, np.int64(n - 1))):
                    cell = cell * GRID_STEPS + grid(np.maximum(less(count), 0) / np.maximum(of, 1))
                cell, tokens = np.unique(cell, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(tokens, pa.int64())], schema=schema)

    return run


def allowed() -> np.ndarray:
    """Which parts a bucket can use: none of a context that was never seen."""
    out = np.ones((2 * LEVELS, PARTS), bool)
    out[:LEVELS, 0] = False
    out[0, :2] = False
    return out


def learn_weights(cells: list[tuple[int, int]], v: int, rounds: int = ROUNDS) -> np.ndarray:
    """Expectation-maximisation: weights (triple, pair, word, uniform) of each bucket.

    The uniform part keeps at least ``LEAST_UNIFORM``, so that no token has probability zero.
    """
    use = allowed()
    weights = use / use.sum(axis=1, keepdims=True)
    if cells:
        cell, count = (np.array(x, np.int64) for x in zip(*cells, strict=True))
        value = lambda g: np.where(g > 0, 2.0 ** ((g - GRID_STEPS + 1) / GRID), 0.0)
        at = cell // GRID_STEPS**3
        parts = np.column_stack([value(cell // GRID_STEPS**2 % GRID_STEPS), value(cell // GRID_STEPS % GRID_STEPS), value(cell % GRID_STEPS), np.full(len(cell), 1.0 / (v + 1))])
        for _ in range(rounds):
            share = weights[at] * parts
            share *= (count / share.sum(axis=1))[:, None]
            new = 1e-3 * use
            np.add.at(new, at, share)
            weights = floor_uniform(new / new.sum(axis=1, keepdims=True))
    return floor_uniform(weights)


def floor_uniform(weights: np.ndarray) -> np.ndarray:
    """``weights`` with the uniform part raised to its least value at the cost of the others."""
    last = np.maximum(weights[:, 3:], LEAST_UNIFORM)
    rest = weights[:, :3]
    total = rest.sum(axis=1, keepdims=True)
    return np.hstack([rest * np.where(total > 0, (1 - last) / np.where(total > 0, total, 1), 0), np.where(total > 0, last, 1.0)])


def probabilities(t: Tokens, weights: np.ndarray, v: int, n: int) -> np.ndarray:
    w = weights[bucket_of(t.wide_context, t.context)]
    return w[:, 0] * t.triple / np.maximum(t.wide_context, 1) + w[:, 1] * t.pair / np.maximum(t.context, 1) + w[:, 2] * t.own / max(n, 1) + w[:, 3] / (v + 1)


SCORED = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def score_tokens(weights: np.ndarray, v: int, n: int, docs_train: int):
    schema = pa.schema([("doc_id", pa.int64()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in one_by_one(b):
                t = Tokens(r, docs_train)
                base = np.log10((t.own + 0.5) / (n + 0.5 * (v + 1)))
                add = lambda x: np.add.reduceat(x, t.starts)  # noqa: B023, E731
                cols = [pa.array(r["ids"], pa.int64()), pa.array(t.train), pa.array(t.lengths), pa.array(add((t.own > 0).astype(np.int64))), pa.array(add(base)), pa.array(add(np.log10(probabilities(t, weights, v, n))))]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return run


class Counts(NamedTuple):
    """Every token's counts in packed chunks; V, N and the number of training documents."""

    chunks: DataFrame
    v: int
    n: int
    docs_train: int


def count(docs: DataFrame, train, key: str = "doc_id", text: str = "text", order: int = ORDER) -> Counts:
    """``train``: a boolean column over ``docs``."""
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), train.alias("learn"))
    chunks = materialise(rows.mapInArrow(to_chunks, CHUNK), "op10-chunks")
    size = chunks.agg(F.sum("n").alias("n"), F.sum("docs_train").alias("d")).first()
    bits = max(4, int(np.ceil(np.log2(max(1, (size["n"] or 0) / BUCKET_TOKENS)))))

    packed = chunks.select("chunk", "train", "lengths", "tokens", "vocab")
    asked = packed.mapInArrow(requests(bits, order), request_schema(order))
    replies = materialise(asked.groupBy("bucket").applyInArrow(totals(order), reply_schema(order)), "op10-totals")
    del asked
    known = replies.where("chunk is null").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).first()
    release(docs.sparkSession)
    back = replies.where("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct("bucket", *KINDS[:order])).alias("replies"))
    joined = chunks.select("chunk", "ids", "train", "lengths", "tokens", "vocab").join(back, "chunk")
    counts = materialise(joined.mapInArrow(counted(order), counted_schema(order)), "op10-counts")
    del joined, back
    return Counts(counts, known["v"] or 0, known["n"] or 0, size["d"] or 0)


def fit(counts: Counts) -> np.ndarray:
    """The mixture weights; what reaches the driver is bounded by the grid."""
    cells = counts.chunks.mapInArrow(deleted_cells(counts.n, counts.docs_train), "cell long, tokens long").groupBy("cell").agg(F.sum("tokens").alias("tokens"))
    return learn_weights(sorted((r["cell"], r["tokens"]) for r in cells.collect()), counts.v)


def score(docs: DataFrame, train, key: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """Per row: key, train, n_tokens, n_known, base_score, score and train_tokens; ``train``: a boolean column over ``docs``."""
    counts = count(docs, train, key, text, order)
    out = counts.chunks.mapInArrow(score_tokens(fit(counts), counts.v, counts.n, counts.docs_train), SCORED)
    return out.withColumn("train_tokens", F.lit(counts.n).cast("long")).withColumnRenamed("doc_id", key)


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability; learned from the rows outside fold 1."""
    out = score(table(spark, sf_dir, "documents"), fold(F.col("doc_id")) != 1)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
