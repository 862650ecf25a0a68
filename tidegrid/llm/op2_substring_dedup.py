"""Substring deduplication by suffix automata of reference shards.

Every word covered by a window of ``WINDOW`` consecutive words that starts anywhere else too is removed.

1. Routing.  The least hash of the word runs in a window owns the window (runs of ``RUN`` words, the rightmost of equal
   ones), so equal windows have equal owners.  Consecutive windows with the same owner form a piece: a stretch of words
   whose windows are exactly those the owner owns.  Owners met once in the corpus cannot own a repeated window.
2. Reference.  The distinct pieces of the owners met again, each with the number of its occurrences, are the reference.
   It is split by owner into shards of a bounded number of words; the pieces of an owner with more than ``MANY`` distinct
   ones are cut into single windows, dealt by window hash, so no shard and no task is hot.
3. Matching.  A shard's suffix automaton carries the number of occurrences of every state.  Streaming a piece through it
   gives matching statistics: for each word, the longest run ending there that occurs twice or more.  Spans that reach
   the threshold are maximal repeated spans.
4. The spans return to every occurrence of their piece, and the covered words are dropped.

Shards go to the documents' pieces they can match and not to all executors: a corpus-wide automaton has no size bound
that would allow a broadcast.  Whether words repeat is decided by the automata, which compare the words themselves, on
both ways of cutting; hashes only bring together what may be equal.  Lists that rows are joined with are written first,
so that both sides of a join are plain exchanges and Spark splits the rows of a hot owner.

Defined results: null and empty texts have no words; texts under the window length lose nothing; very long texts are cut
like any other; equal rows are occurrences of each other; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.sources.scratch import release

from .common import _BASE, _BASE_INV, _powers, materialise, mix64, ngram_hashes, table, word_hashes

WINDOW = 35
RUN = 6
#: Owners with more distinct pieces than this are routed window by window.
MANY = 64
SHARD_WORDS = 50_000

#: A place holds, from the low end, the number of windows, the first word, and 26 bits more of its document's hash.
COUNT_BITS, CHECK_AT = 6, 37
OWNED = "owner long, piece long, uid long, place long"


def range_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words start..end of each range, alike wherever the range lies."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * _powers(_BASE, len(h)), dtype=np.uint64)))
    return mix64((sums[end] - sums[start]) * _powers(_BASE_INV, len(h))[start] + (end - start).astype(np.uint64))


def rightmost_least(values: np.ndarray, wide: int) -> np.ndarray:
    """Place of the least value, the last of equal ones, in each window of ``wide`` values.

    In blocks as long as a window, every window is the end of one block and the beginning of the next: running minima from
    either side of the blocks give it in a few passes, whatever the width.
    """
    n = len(values)
    rows = -(-n // wide)
    v = np.full(rows * wide, np.uint64(2**64 - 1))
    v[:n] = values
    v, at = v.reshape(rows, wide), np.arange(rows * wide).reshape(rows, wide)
    low = np.minimum.accumulate(v, axis=1)
    low_at = np.maximum.accumulate(np.where(v == low, at, 0), axis=1)
    back = np.minimum.accumulate(v[:, ::-1], axis=1)
    first = np.ones(v.shape, bool)
    first[:, 1:] = back[:, 1:] < back[:, :-1]
    back_at = np.minimum.accumulate(np.where(first, at[:, ::-1], rows * wide), axis=1)[:, ::-1].ravel()
    back, low, low_at = back[:, ::-1].ravel(), low.ravel(), low_at.ravel()
    starts = np.arange(n - wide + 1)
    ends = starts + wide - 1
    return np.where(low[ends] <= back[starts], low_at[ends], back_at[starts])


def owned_pieces(texts: list[bytes], window: int = WINDOW, run: int = RUN) -> tuple[np.ndarray, ...]:
    """(owner, piece, text, start, number of windows) of the pieces of some texts, all texts in one pass.

    The texts are laid end to end; windows that reach into the next text are left out.
    """
    none = np.zeros(0, np.int64)
    h, first_byte, _ = word_hashes(b"\n".join(texts))
    if len(h) < window:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    text_of = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), first_byte, side="right")
    kept = np.flatnonzero(text_of[: len(h) - window + 1] == text_of[window - 1 :])
    if not len(kept):
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    runs = ngram_hashes(h, run)
    at = rightmost_least(runs, window - run + 1)[kept]
    new = np.ones(len(kept), bool)
    new[1:] = (at[1:] != at[:-1]) | (kept[1:] != kept[:-1] + 1)
    edge = np.flatnonzero(new)
    count = np.diff(np.append(edge, len(kept)))
    start, at = kept[edge], at[edge]
    piece = mix64(range_hashes(h, start, start + count + window - 1) + (at - start).astype(np.uint64) * _BASE)
    first_word = np.searchsorted(text_of, np.arange(len(texts)))
    text = text_of[start]
    return runs[at], piece, text, start - first_word[text], count


def in_groups(texts: Iterator[pa.Scalar], size: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, texts) of consecutive texts of about ``size`` bytes together."""
    group, held, first = [], 0, 0
    for i, t in enumerate(texts):
        data = t.as_py() or b""
        group.append(data)
        held += len(data)
        if held >= size:
            yield first, group
            group, held, first = [], 0, i + 1
    if group:
        yield first, group


def find_owners(window: int):
    """The owner of each piece."""
    schema = pa.schema([("owner", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in in_groups(b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(owned_pieces(texts, window)[0].view(np.int64))], schema=schema)

    return run


def find_pieces(window: int):
    """Pieces with their packed places."""
    schema = pa.schema([("owner", pa.int64()), ("piece", pa.int64()), ("uid", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            uid, chk = b.column(0).to_numpy(), b.column(2).to_numpy()
            for first, texts in in_groups(b.column(1)):
                owner, piece, text, start, count = owned_pieces(texts, window)
                text = text + first
                place = (chk[text] << CHECK_AT) + (start << COUNT_BITS) + count
                yield pa.RecordBatch.from_arrays([pa.array(owner.view(np.int64)), pa.array(piece.view(np.int64)), pa.array(uid[text]), pa.array(place)], schema=schema)

    return run


LINES = "route long, pid long, owner long, piece long, off int, n long, words binary"


def cut_lines(window: int):
    """The words of the reference pieces of a document; window by window where the owner has many pieces."""
    schema = pa.schema([("route", pa.int64()), ("pid", pa.int64()), ("owner", pa.int64()), ("piece", pa.int64()), ("off", pa.int32()), ("n", pa.int64()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in schema]
            for t, places in zip(b.column(1), b.column(2), strict=True):
                ws = t.as_py().split()
                h = None
                for p in places.as_py():
                    s, k = divmod(p["place"] & ((1 << CHECK_AT) - 1), 1 << COUNT_BITS)
                    if not p["many"]:
                        rows = [(p["owner"], p["piece"], p["owner"], p["piece"], 0, p["n"], b" ".join(ws[s : s + k + window - 1]))]
                    else:
                        h = word_hashes(t.as_py())[0] if h is None else h
                        at = np.arange(s, s + k)
                        ids = range_hashes(h[s : s + k + window - 1], at - s, at - s + window).view(np.int64).tolist()
                        rows = [(i, i, p["owner"], p["piece"], j, p["n"], b" ".join(ws[s + j : s + j + window])) for j, i in enumerate(ids)]
                    for r in rows:
                        for col, v in zip(cols, r, strict=True):
                            col.append(v)
                if len(cols[0]) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
                    cols = [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return run


class SuffixAutomaton:
    """Generalised suffix automaton over words, or numbers that stand for them; each text has a weight, its occurrences."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def add(self, text: list, weight: int) -> None:
        nxt, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for w in text:
            q = nxt[last].get(w)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._clone(last, q, w)
            else:
                new, p = len(link), last
                nxt.append({})
                length.append(length[last] + 1)
                link.append(0)
                count.append(0)
                while p >= 0:
                    q = nxt[p].setdefault(w, new)
                    if q != new:
                        link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
                        break
                    p = link[p]
                last = new
            count[last] += weight

    def _clone(self, p: int, q: int, w) -> int:
        """The part of state q that is as long as p and w; p and its suffixes lead there from now on."""
        nxt, link = self.next, self.link
        copy = len(link)
        nxt.append(nxt[q].copy())
        self.length.append(self.length[p] + 1)
        link.append(link[q])
        self.count.append(0)
        link[q] = copy
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def repeated(self) -> list[int]:
        """For each state the length of its longest suffix that occurs twice or more."""
        order = np.argsort(self.length, kind="stable").tolist()
        count, link = self.count, self.link
        for s in reversed(order[1:]):
            if link[s] > 0:
                count[link[s]] += count[s]
        best = [0] * len(order)
        for s in order[1:]:
            best[s] = self.length[s] if count[s] >= 2 else best[link[s]]
        return best


def repeated_spans(automaton: SuffixAutomaton, best: list[int], text: list, window: int) -> list[tuple[int, int]]:
    """Maximal spans of words covered by repeated runs of at least ``window`` words, by matching statistics."""
    spans: list[tuple[int, int]] = []
    state, nxt = 0, automaton.next
    for e, w in enumerate(text, 1):
        state = nxt[state][w]
        if best[state] >= window:
            s = e - best[state]
            while spans and s <= spans[-1][1]:
                s = min(s, spans.pop()[0])
            spans.append((s, e))
    return spans


def match_shards(window: int, shard_words: int):
    schema = pa.schema([("pid", pa.int64()), ("route", pa.int64()), ("los", pa.list_(pa.int32())), ("his", pa.list_(pa.int32()))])

    def solve(shard: list[tuple[int, int, int, list[bytes]]]) -> pa.RecordBatch:
        # Equal words are one number from here on: what the automaton compares is as exact and quicker.
        number: dict[bytes, int] = {}
        shard = [(route, pid, n, [number.setdefault(w, len(number)) for w in text]) for route, pid, n, text in shard]
        a = SuffixAutomaton()
        for _, _, n, text in shard:
            a.add(text, n)
        best = a.repeated()
        got = [(pid, route, spans) for route, pid, _, text in shard if (spans := repeated_spans(a, best, text, window))]
        cols = [[g[0] for g in got], [g[1] for g in got], [[s for s, _ in g[2]] for g in got], [[e for _, e in g[2]] for g in got]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, last = [], 0, None
        for b in batches:
            for route, pid, n, ws in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                if held > shard_words and route != last:
                    yield solve(shard)
                    shard, held = [], 0
                text = ws.as_py().split()
                shard.append((route, pid, n, text))
                held += len(text)
                last = route
        if shard:
            yield solve(shard)

    return run


CLEANED = "doc_id long, n_words long, n_removed long, kept binary"


def drop_spans(with_text: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], []]
            held = 0
            for k, t, los, his in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                ws = (t.as_py() or b"").split()
                n = len(ws)
                if los:
                    cover = np.zeros(n + 1, np.int64)
                    np.add.at(cover, los, 1)
                    np.add.at(cover, his, -1)
                    ws = [ws[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]
                text = b" ".join(ws)
                held += len(text)
                for col, v in zip(cols, (k, n, n - len(ws), text if with_text else hashlib.sha256(text).hexdigest().encode()), strict=True):
                    col.append(v)
                if held > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
                    cols, held = [[], [], [], []], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return run


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, many: int = MANY, shard_words: int = SHARD_WORDS, with_text: bool = True) -> DataFrame:
    """Per row: key, n_words, n_removed and ``kept`` (the kept words joined by a space, or with ``with_text`` off their SHA-256)."""
    # Two hashes, of 64 and 26 bits, stand for a row.
    chk = F.pmod(F.xxhash64(F.lit(7), F.col(key), F.col(text)), F.lit(1 << 26)).alias("chk")
    rows = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(F.col(key), F.col(text)).alias("uid"), F.col(text).cast("binary").alias("t"), chk)
    row = ["uid", "chk"]
    by_row = lambda place: F.shiftright(place, CHECK_AT).alias("chk")

    # Owners met twice or more, then their pieces; the many others are never shuffled with their places.
    met = materialise(rows.select("t").mapInArrow(find_owners(window), "owner long").groupBy("owner").agg(F.count("*").alias("met")).where("met > 1").select("owner"), "op2-owners")
    pieces = materialise(rows.select("uid", "t", "chk").mapInArrow(find_pieces(window), OWNED).join(met, "owner"), "op2-pieces")

    release(docs.sparkSession)
    # The reference: distinct pieces with their number of occurrences and one place.
    distinct = pieces.groupBy("owner", "piece").agg(F.count("*").alias("n"), F.min(F.struct("uid", "place")).alias("at"))
    distinct = materialise(distinct.select("owner", "piece", "n", "at.uid", "at.place"), "op2-distinct")
    crowded = distinct.groupBy("owner").agg(F.count("*").alias("pieces")).where(F.col("pieces") > many).select("owner", F.lit(True).alias("many"))
    reference = materialise(distinct.join(materialise(crowded, "op2-crowded"), "owner", "left").withColumn("many", F.coalesce("many", F.lit(False))), "op2-reference")

    release(docs.sparkSession)
    # The texts are dealt by row twice in one plan: Spark shuffles them once and reuses the exchange.
    def lines(wanted: DataFrame) -> DataFrame:
        places = wanted.groupBy("uid", by_row("place")).agg(F.collect_list(F.struct("owner", "piece", "n", "place", "many")).alias("places"))
        return rows.join(places, row).select("k", "t", "places").mapInArrow(cut_lines(window), LINES)

    # A window that many pieces share is one line of the reference.
    whole = lines(reference.where("not many")).select("route", "pid", "n", "words")
    windows = lines(reference.where("many"))
    shared = windows.groupBy("route", "pid", "words").agg(F.sum("n").alias("n")).select("route", "pid", "n", "words")
    shards = whole.unionByName(shared).repartition("route").sortWithinPartitions("route")
    spans = shards.mapInArrow(match_shards(window, shard_words), "pid long, route long, los array<int>, his array<int>")

    own = reference.where("not many").select(F.col("owner").alias("route"), F.col("piece").alias("pid"), "owner", "piece", F.lit(0).alias("off"))
    shift = lambda c, by: F.transform(c, lambda x: x + by)
    found = own.unionByName(windows.select("route", "pid", "owner", "piece", "off")).join(spans, ["route", "pid"])
    found = found.select("owner", "piece", shift("los", F.col("off")).alias("los"), shift("his", F.col("off")).alias("his"))
    found = materialise(found.groupBy("owner", "piece").agg(F.flatten(F.collect_list("los")).alias("los"), F.flatten(F.collect_list("his")).alias("his")), "op2-found")
    del whole, windows, shared, shards, spans, own
    release(docs.sparkSession)
    start = F.shiftright(F.col("place").bitwiseAND(F.lit((1 << CHECK_AT) - 1)), COUNT_BITS).cast("int")
    placed = pieces.join(found, ["owner", "piece"]).select("uid", by_row("place"), shift("los", start).alias("los"), shift("his", start).alias("his"))
    by_doc = placed.groupBy(*row).agg(F.flatten(F.collect_list("los")).alias("los"), F.flatten(F.collect_list("his")).alias("his"))
    return rows.join(by_doc, row, "left").select("k", "t", "los", "his").mapInArrow(drop_spans(with_text), CLEANED).withColumnRenamed("doc_id", key)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, the words removed and the digest of what is kept."""
    out = dedup(table(spark, sf_dir, "documents"), with_text=False)
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("kept_sha256"))
