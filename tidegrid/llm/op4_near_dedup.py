"""Near-duplicate documents by an LSH forest over MinHash signatures.

1. A document's set is its distinct five-word shingles (lower-cased A-Z); documents with equal sets form a class and one
   member stands for it.  ``FUNCTIONS`` MinHash values make a class's signature.
2. The forest: ``ORDERS`` orders, each a different sequence of ``DEPTH`` signature values.  Each order is sorted as a
   whole, with the class's number as the last key, and dealt by range, so that even classes of one signature are spread
   over ranges.  Neighbours in an order that share a prefix of at least ``LEAST_DEPTH`` values are candidates.  The depth adapts to the region: where few classes share
   the least prefix, all of them are paired; where many do, the region is split at greater depths until few are left, and
   each class is also paired with its longest-common-prefix neighbours.
3. Candidates are confirmed on the full sets: 100 * intersection >= 75 * union.  First each class is held against the
   partner that most orders propose; pairs that these links already join need no test, all others are tested.
4. Components come from contraction rounds over tables; nothing is collected on the driver.
   A region at the edge of a range may go on in the next one: its classes are counted over all ranges, paired if they are
   few and treated as crowded if not.
5. Crowded regions, those where more than ``FEW`` classes share a least prefix: one round holds every class against the
   region's class with the most links, and what is still in different components is cut into blocks and tested pair by
   pair on the full sets.  Only pairs that are in one component already go untested.

So two classes that share a prefix of three values in any order are tested or joined.  At a similarity of 0.75 they do in
one order with probability 0.42, so all 32 orders miss them with probability 3e-8; sharing functions between the orders
brings it to about 1e-5.

Defined results: null texts and texts without words have an empty set, are linked with nothing and are kept; texts under
five words count as one shingle; very long texts are shingled whole, their signature in slices; equal rows are all kept or
all dropped; a null key is never a component's smallest; an empty table gives no rows.  ``representatives`` keeps one
of rows with equal key and text, by the smallest hash of their other columns; it adds no column, so none can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.operators.graph import components, extend
from tidegrid.sources.scratch import release

from .common import ascii_lower, materialise, mix64, ngram_hashes, pack, row_id, table, unpack, word_hashes

SHINGLE = 5
PER_CENT = 75
FUNCTIONS, ORDERS, DEPTH, LEAST_DEPTH = 64, 32, 8, 3
#: A region of at most this many classes has all its pairs tested.
FEW = 4
ROWS_PER_RANGE = 400_000
#: Shingles in a block of a crowded region; a class counts as 400 at least, so a block has at most 1000 classes.
BLOCK_SHINGLES = 400_000

_rng = np.random.default_rng(77001)
_MUL = _rng.integers(0, 2**63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**64, FUNCTIONS, dtype=np.uint64)
#: Each permutation of the functions is cut into orders, so every function leads somewhere.
_SEQUENCES = np.concatenate([_rng.permutation(FUNCTIONS).reshape(-1, DEPTH) for _ in range(ORDERS * DEPTH // FUNCTIONS)])


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's five-word shingles."""
    h = word_hashes(ascii_lower(text))[0]
    if not len(h):
        return h
    return np.unique(ngram_hashes(h, min(SHINGLE, len(h))) + np.uint64(min(SHINGLE, len(h))))


def signature(s: np.ndarray) -> np.ndarray:
    """16 bits of each MinHash value."""
    least = np.full(FUNCTIONS, np.uint64(2**64 - 1))
    for at in range(0, len(s), 4096):
        least = np.minimum(least, (s[at : at + 4096, None] * _MUL + _ADD).min(axis=0))
    return (mix64(least) >> np.uint64(48)).astype("<u2")


SIGNED = "id binary, k long, tie long, n int, set_id binary, sig binary"


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.binary()), ("k", pa.int64()), ("tie", pa.int64()), ("n", pa.int32()), ("set_id", pa.binary()), ("sig", pa.binary())])
    for b in batches:
        n, ids, sigs = [], [], []
        for t in b.column(3):
            s = shingle_set(t.as_py())
            n.append(len(s))
            ids.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
            sigs.append(signature(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int32()), pa.array(ids, pa.binary()), pa.array(sigs, pa.binary())], schema=schema)


ORDERED = "tree int, k1 long, k2 long, node long, n int"


def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each class and order: the order's signature values as two longs."""
    schema = pa.schema([("tree", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("node", pa.int64()), ("n", pa.int32())])
    for b in batches:
        if not b.num_rows:
            continue
        sig = np.frombuffer(b"".join(b.column(2).to_pylist()), "<u2").reshape(b.num_rows, FUNCTIONS).astype(np.uint64)
        node, n = b.column(0).to_numpy(), b.column(1).to_numpy()
        for at in range(0, b.num_rows, 2000):
            own = sig[at : at + 2000][:, _SEQUENCES]
            keys = [sum(own[:, :, 4 * half + j] << np.uint64(48 - 16 * j) for j in range(4)).ravel().view(np.int64) for half in (0, 1)]
            m = len(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(ORDERS, dtype=np.int32), m)), pa.array(keys[0]), pa.array(keys[1]), pa.array(np.repeat(node[at : at + m], ORDERS)), pa.array(np.repeat(n[at : at + m], ORDERS).astype(np.int32))], schema=schema)


def candidates(tree: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of candidate pairs in rows sorted by (tree, k1, k2)."""
    rows = len(tree)
    if rows < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = tree[1:] == tree[:-1]
    lcp = np.zeros(rows - 1, np.int64)
    for key in (k1.view(np.uint64), k2.view(np.uint64)):
        differ = key[1:] ^ key[:-1]
        for j in range(4):
            same = same & (((differ >> np.uint64(48 - 16 * j)) & np.uint64(0xFFFF)) == 0)
            lcp += same
    # The region of each row at the least depth at which few classes share it.
    region, open_ = np.full(rows, -1, np.int64), np.ones(rows, bool)
    for depth in range(LEAST_DEPTH, DEPTH + 1):
        group = np.concatenate(([0], np.cumsum(lcp < depth)))
        few = open_ & (np.bincount(group)[group] <= FEW)
        region[few] = group[few] * (DEPTH + 1) + depth
        open_ &= ~few
    near = lcp >= LEAST_DEPTH
    pairs = [np.flatnonzero(near)]
    others = [pairs[0] + 1]
    for step in range(2, FEW):
        i = np.flatnonzero((region[step:] == region[:-step]) & (region[step:] >= 0))
        pairs.append(i)
        others.append(i + step)
    # Where even the deepest region is large: the neighbour after the next as well.
    i = np.flatnonzero(near[:-1] & near[1:] & (open_[:-2] | open_[2:]))
    return np.concatenate([*pairs, i]), np.concatenate([*others, i + 2])


def crowded(tree: np.ndarray, k1: np.ndarray) -> np.ndarray:
    """Which rows of a sorted range stand in a crowded region or in one that may go on in the ranges beside it."""
    if not len(tree):
        return np.zeros(0, bool)
    prefix = k1.view(np.uint64) >> np.uint64(16 * (4 - LEAST_DEPTH))
    group = np.concatenate(([0], np.cumsum((tree[1:] != tree[:-1]) | (prefix[1:] != prefix[:-1]))))
    return (np.bincount(group)[group] > FEW) | (group == 0) | (group == group[-1])


PROPOSED = "a long, b long, tree int, prefix long, node long, n int"


def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (a < b) of a range, and the rows of regions that are crowded or reach the range's edges."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("tree", pa.int32()), ("prefix", pa.int64()), ("node", pa.int64()), ("n", pa.int32())])
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    tree, k1, k2, node, n = (np.concatenate([b.column(i).to_numpy() for b in got]) for i in range(5))
    i, j = candidates(tree, k1, k2)
    fit = 100 * np.minimum(n[i], n[j]).astype(np.int64) >= PER_CENT * np.maximum(n[i], n[j]).astype(np.int64)
    a, b = np.minimum(node[i], node[j])[fit], np.maximum(node[i], node[j])[fit]
    if len(a):
        pairs = np.unique(np.column_stack([a, b]), axis=0)
        none = [pa.nulls(len(pairs), f.type) for f in list(schema)[2:]]
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), *none], schema=schema)
    at = np.flatnonzero(crowded(tree, k1))
    prefix = (k1[at].view(np.uint64) >> np.uint64(16 * (4 - LEAST_DEPTH))).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int64()), pa.array(tree[at], pa.int32()), pa.array(prefix), pa.array(node[at]), pa.array(n[at], pa.int32())], schema=schema)


def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.int64()), ("s", pa.binary())])
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([pack(shingle_set(t.as_py()) >> np.uint64(16), 6) for t in b.column(1)], pa.binary())], schema=schema)


def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets are similar enough."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for b in batches:
        hit = []
        for x, y in zip(b.column(2), b.column(3), strict=True):
            s, t = unpack(x.as_py(), 6), unpack(y.as_py(), 6)
            both = len(s) + len(t) - len(np.unique(np.concatenate([s, t])))
            hit.append(100 * both >= PER_CENT * (len(s) + len(t) - both))
        yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(hit, pa.bool_())), b.column(1).filter(pa.array(hit, pa.bool_()))], schema=schema)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.withColumnsRenamed({"node": "a", "s": "sa"})
    right = sets.withColumnsRenamed({"node": "b", "s": "sb"})
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(confirm, "a long, b long")


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, by products of slabs of their 0/1 matrices."""
    sets = left + right
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    first = row < len(left)
    both = np.zeros(len(values), bool)
    both[at[first]] = True
    met = np.zeros(len(values), bool)
    met[at[~first]] = True
    place = np.cumsum(both & met) - 1
    keep = (both & met)[at]
    row, col = row[keep], place[at[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int((both & met).sum()), 4096):
        a, b = np.searchsorted(col, [lo, lo + 4096])
        slab = np.zeros((len(sets), 4096), np.float32)
        slab[row[a:b], col[a:b] - lo] = 1
        out += slab[: len(left)] @ slab[len(left) :].T
    return out.astype(np.int64)


def join_blocks(rows: pa.Table) -> pa.Table:
    """Similar pairs of different components in one pair of blocks; side 0 alone is a block met by itself."""
    node, root, n, side = (rows.column(c).to_numpy() for c in ("node", "root", "n", "side"))
    sets = [unpack(x, 6) for x in rows.column("s").to_pylist()]
    i = np.flatnonzero(side == 0)
    j = np.flatnonzero(side == 1) if (side == 1).any() else i
    hits = []
    if len(i) and len(j):
        both = intersections([sets[x] for x in i], [sets[x] for x in j])
        n = n.astype(np.int64)
        near = (100 * both >= PER_CENT * (n[i][:, None] + n[j][None, :] - both)) & (root[i][:, None] != root[j][None, :])
        x, y = np.nonzero(near)
        hits = np.unique(np.column_stack([np.minimum(node[i[x]], node[j[y]]), np.maximum(node[i[x]], node[j[y]])]), axis=0)
    hits = np.asarray(hits, np.int64).reshape(-1, 2)
    return pa.table({"a": hits[:, 0], "b": hits[:, 1]})


def untested(crowd: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (tree, prefix, node, n, root) of the crowded regions that hold more than one component."""
    rooted = crowd.join(labels, "node", "left").select("tree", "prefix", "node", "n", F.coalesce("root", "node").alias("root"))
    open_ = rooted.groupBy("tree", "prefix").agg(F.count("*").alias("m"), F.min("root").alias("least"), F.max("root").alias("most")).where((F.col("m") > FEW) & (F.col("least") != F.col("most")))
    return rooted.join(open_.select("tree", "prefix"), ["tree", "prefix"])


def against_hubs(crowd: DataFrame, links: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of every class with its region's class that has the most links, the original of a star of copies."""
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    rows = materialise(untested(crowd, labels).join(degree, "node", "left"), "op4-crowded")
    hubs = rows.groupBy("tree", "prefix").agg(F.max_by(F.struct("node", "root", "n"), F.struct(F.coalesce("degree", F.lit(0)), "node")).alias("hub"))
    fit = 100 * F.least(F.col("n"), F.col("hub.n")) >= PER_CENT * F.greatest(F.col("n"), F.col("hub.n"))
    pairs = rows.join(hubs, ["tree", "prefix"]).where((F.col("root") != F.col("hub.root")) & fit)
    pairs = pairs.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()
    return materialise(confirmed(pairs, sets), "op4-hub-links")


BLOCKED = "tree int, prefix long, node long, n int, root long, block long"


def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the number of their block; a block ends with its region or at ``BLOCK_SHINGLES``."""
    from pyspark import TaskContext

    block, held, last = TaskContext.get().partitionId() << 32, 0, None
    for b in batches:
        out = []
        for region, n in zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True), b.column(3).to_pylist(), strict=True):
            weight = max(n, BLOCK_SHINGLES // 1000)
            if region != last or held + weight > BLOCK_SHINGLES:
                block, held, last = block + 1, 0, region
            held += weight
            out.append(block)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], names=[*b.schema.names, "block"])


def against_all(crowd: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the components that are left in crowded regions: each region in blocks, each pair of blocks a task's work."""
    order = ["tree", "prefix", "root", "node"]
    rows = materialise(untested(crowd, labels), "op4-open")
    ranges = max(8, -(-rows.count() // ROWS_PER_RANGE))
    rows = materialise(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("tree", "prefix", "node", "n", "root").mapInArrow(cut_blocks, BLOCKED), "op4-blocks")
    blocks = rows.groupBy("tree", "prefix", "block").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    x, y = blocks.alias("x"), blocks.alias("y")
    met = x.join(y, (F.col("x.tree") == F.col("y.tree")) & (F.col("x.prefix") == F.col("y.prefix")) & (F.col("x.block") <= F.col("y.block")))
    # Blocks are cut in the order of the roots, so a large component's blocks hold nothing else and needn't meet.
    met = met.where(F.greatest("x.most", "y.most") != F.least("x.least", "y.least"))
    sides = F.when(F.col("x.block") == F.col("y.block"), F.array(F.struct(F.lit(0).alias("side"), F.col("x.block").alias("block")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("x.block").alias("block")), F.struct(F.lit(1).alias("side"), F.col("y.block").alias("block")))
    )
    met = met.select(F.col("x.block").alias("bi"), F.col("y.block").alias("bj"), F.explode(sides).alias("e")).select("bi", "bj", "e.*")
    work = met.join(rows, "block").join(sets, "node").select("bi", "bj", "side", "node", "root", "n", "s")
    return work.groupBy("bi", "bj").applyInArrow(join_blocks, "a long, b long")


def edge_pairs(edge: DataFrame, counts: DataFrame) -> DataFrame:
    """All pairs of the regions at edges of ranges that turn out to hold few classes."""
    few = edge.join(counts.where((F.col("m") > 1) & (F.col("m") <= FEW)).select("tree", "prefix"), ["tree", "prefix"])
    held = few.groupBy("tree", "prefix").agg(F.sort_array(F.collect_list(F.struct("node", "n"))).alias("c"))
    pairs = F.flatten(F.transform("c", lambda x, i: F.transform(F.slice("c", i + 2, F.lit(FEW)), lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b"), F.least(x["n"], y["n"]).alias("low"), F.greatest(x["n"], y["n"]).alias("high")))))
    return held.select(F.explode(pairs).alias("p")).where(100 * F.col("p.low") >= PER_CENT * F.col("p.high")).select("p.a", "p.b")


def near_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id (see ``row_id``), tie (a hash of the other columns), k (key), n_shingles, component_id and kept."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (key, text)]
    tie = F.xxhash64(F.struct(*others).cast("string")) if others else F.lit(0).cast("long")
    rows = docs.select(row_id(F.col(key), F.col(text)).alias("id"), F.col(key).cast("long").alias("k"), tie.alias("tie"), F.col(text).alias("t"))
    signed = materialise(rows.mapInArrow(sign, SIGNED), "op4-signatures")
    # Classes are numbered as they are written, so no two share a number.
    classes = signed.where("set_id is not null").groupBy("set_id").agg(F.min("id").alias("id"), F.min("k").alias("k"), F.min("n").alias("n"), F.first("sig").alias("sig"))
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "op4-classes")

    forest = classes.select("node", "n", "sig").mapInArrow(plant, ORDERED)
    ranges = max(8, -(-classes.count() * ORDERS // ROWS_PER_RANGE))
    order = ["tree", "k1", "k2", "node"]
    proposed = materialise(forest.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(propose, PROPOSED), "op4-proposed")
    edge = proposed.where("a is null").select("tree", "prefix", "node", "n")
    counts = materialise(edge.groupBy("tree", "prefix").agg(F.count("*").alias("m")).where("m > 1"), "op4-regions")
    both = proposed.where("a is not null").select("a", "b").unionByName(edge_pairs(edge, counts))
    pairs = materialise(both.groupBy("a", "b").agg(F.count("*").alias("votes")), "op4-pairs")
    crowd = materialise(edge.join(counts.where(F.col("m") > FEW).select("tree", "prefix"), ["tree", "prefix"]), "op4-crowd")

    release(docs.sparkSession)
    # Shingle sets of the classes that have any partner or stand in a crowded region.  The list of those grows with the input, so the texts are always
    # dealt out by id and never met by a broadcast of a list that happens to be short.
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(crowd.select("node")).distinct()
    wanted = classes.select("id", "node").join(nodes, "node", "left_semi")
    sets = materialise(rows.select("id", "t").join(wanted.hint("merge"), "id").dropDuplicates(["id"]).select("node", "t").mapInArrow(sets_of, "node long, s binary"), "op4-sets")

    # Round one: the partner that most orders propose.
    ways = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"), "votes").unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v"), "votes"))
    best = ways.groupBy("u").agg(F.max_by("v", F.struct("votes", "v")).alias("v")).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    best = materialise(best, "op4-best")
    first = materialise(confirmed(best, sets), "op4-links")
    joined = components(first)

    release(docs.sparkSession)
    # Round two: every other pair that these links don't join already.
    label = lambda c: joined.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
    rest = pairs.select("a", "b").join(best, ["a", "b"], "left_anti").join(label("a"), "a", "left").join(label("b"), "b", "left")
    rest = rest.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")
    second = materialise(confirmed(rest, sets), "op4-links")
    links, labels = first, joined
    if not second.isEmpty():
        links, labels = first.unionByName(second), extend(joined, second)

    release(docs.sparkSession)
    # Round three: what is in different components of a crowded region, first with its hub, then all of it.
    hubbed = against_hubs(crowd, links, labels, sets)
    if not hubbed.isEmpty():
        labels = extend(labels, hubbed)
    release(docs.sparkSession)
    found = materialise(against_all(crowd, labels, sets), "op4-block-links")
    if not found.isEmpty():
        labels = extend(labels, found)
    release(docs.sparkSession)

    rooted = classes.select("set_id", "node", "k").join(labels, "node", "left").select("set_id", "k", F.coalesce("root", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("k").alias("component_id"))
    named = rooted.join(smallest, "root").select("set_id", "component_id")
    # Texts without words are their own component; they have no set, so they take no part in the join.
    own = F.col("n").cast("long").alias("n_shingles")
    named_rows = signed.where("set_id is not null").join(named, "set_id").select("id", "tie", "k", own, "component_id")
    alone = signed.where("set_id is null").select("id", "tie", "k", own, F.col("k").alias("component_id"))
    return named_rows.unionByName(alone).withColumn("kept", F.col("k").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_shingles, component_id and kept."""
    return near_rows(docs, key, text).withColumnRenamed("k", key).select(key, "n_shingles", "component_id", "kept")


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component."""
    kept = near_rows(docs, key, text).where("kept").groupBy("id").agg(F.min("tie").alias("tie"))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (key, text)]
    tie = F.xxhash64(F.struct(*others).cast("string")) if others else F.lit(0).cast("long")
    rows = docs.select(row_id(F.col(key), F.col(text)).alias("id"), tie.alias("tie"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(kept, ["id", "tie"]).dropDuplicates(["id"]).select("row.*")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near copies."""
    return near_duplicates(table(spark, sf_dir, "documents"))
