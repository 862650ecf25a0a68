"""Toxicity by a weighted finite-state pattern grammar.

Five transducers over word classes are composed into one.  ``reported`` damps what stands in reported speech, ``negation``
what follows a negation; ``target`` raises what comes after a person addressed; ``threat`` holds an announced harm back
until its target is met; ``insult`` raises insults that are heaped on one another and turns a target that follows an
insult into one more, lighter one.  The composed machine reads a clause (the words between marks of punctuation).  A heavy
output (I or H) carries the last heavy word read, times the weights of the arcs of all five machines; a clause's weight
is the sum of its heavy outputs.  A document's features are the sum, the greatest and the rate of its clauses' weights.

Which words insult or harm, in whatever language, and how much is learned from labelled rows: words with large smoothed
log odds of a toxic label are heavy, and those that mostly stand in a threat's frame (after a word of intent, before a
target) announce harm.  Only the grammar's function words are given.  Labels, lang, source and the key are never inputs of
a score.

The fit uses a bounded sample: at most ``FIT_ROWS`` labelled rows of either label, drawn by a seeded hash of the key.  Its
texts are read whole, on the executors; the driver gets counts of words and three features a row.  Scoring reads every
whole text.  Defined results: null and empty texts score the sigmoid of the bias (no clause has weight); very long texts
are split into clauses like any other; equal texts score alike; of conflicting labels of one key the least counts; rows
with a null label or key are not learned from; without labelled rows of both labels no word is heavy and every score is
the same; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, materialise, table

FIT_ROWS = 3000

#: Function words of the grammar in four languages.
INTENT = "will shall gonna going must should werde werden vais va voy vamos"
TARGET = "you your yours he she they them him her his their u du ihr dich euch sie tu vous toi te ils elles usted ustedes ti ellos ellas"
NEGATION = "not never no isn't aren't wasn't don't doesn't didn't nicht kein keine nie pas jamais aucun nunca ningún jamás"
REPORT = "said says say called calls quoted quotes reported claims claimed wrote sagte sagt nannte dit disait écrit dijo dice llamó"

CLASSES = {w: c for c, ws in (("R", REPORT), ("N", NEGATION), ("T", TARGET), ("F", INTENT)) for w in ws.split()}
#: A word is learned where it stands in so many toxic documents at least and its log odds reach LEAST_ODDS.
LEAST_DOCUMENTS, LEAST_ODDS, MOST_ODDS = 3, 2.0, 6.0
#: The map to a score is fitted to features by words that were learned without the document's own part.
PARTS = 5
_CLAUSE = re.compile(r"[.,;:!?\n\r|()\[\]\"]+")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


class Transducer:
    """Deterministic weighted transducer over symbols: ``arcs[state][symbol] = (next state, output, weight)``.

    A symbol without an arc takes the state's arc for ``*`` and, failing that, passes unchanged.
    """

    def __init__(self, start: str, arcs: dict[str, dict[str, tuple[str, str, float]]]):
        self.start, self.arcs = start, arcs

    def step(self, state: str, symbol: str) -> tuple[str, str, float]:
        own = self.arcs.get(state, {})
        if symbol in own:
            return own[symbol]
        if "*" in own:
            to, _, weight = own["*"]
            return to, symbol, weight
        return state, symbol, 1.0


class Composed:
    """The output of each transducer feeds the next and weights multiply; product states are built when first met."""

    def __init__(self, *parts: Transducer):
        self.parts, self.start = parts, tuple(p.start for p in parts)
        self.seen: dict[tuple, tuple[tuple, str, float]] = {}

    def step(self, state: tuple, symbol: str) -> tuple[tuple, str, float]:
        if (arc := self.seen.get((state, symbol))) is None:
            out, weight, to = symbol, 1.0, []
            for p, s in zip(self.parts, state, strict=True):
                s, out, w = p.step(s, out)
                to.append(s)
                weight *= w
            arc = self.seen[state, symbol] = tuple(to), out, weight
        return arc


def transducers() -> tuple[Transducer, ...]:
    """reported, negation, target, threat and insult, in the order of their composition."""
    reported = Transducer("plain", {"plain": {"R": ("quote", "R", 1.0)}, "quote": {"I": ("quote", "I", 0.6), "H": ("quote", "H", 0.6)}})
    negation = Transducer("0", {
        "0": {"N": ("3", "N", 1.0)},
        **{str(k): {"N": ("3", "N", 1.0), "I": (str(k - 1), "I", 0.6), "H": (str(k - 1), "H", 0.6), "*": (str(k - 1), "", 1.0)} for k in (3, 2, 1)},
    })
    target = Transducer("none", {"none": {"T": ("aimed", "T", 1.0)}, "aimed": {"I": ("aimed", "I", 1.2), "H": ("aimed", "H", 1.2)}})
    threat = Transducer("idle", {"idle": {"F": ("set", "F", 1.0), "H": ("idle", "-", 1.0)}, "set": {"H": ("struck", "-", 1.0), "N": ("idle", "N", 1.0)}, "struck": {"T": ("idle", "H", 1.0)}})
    insult = Transducer("cold", {"cold": {"I": ("hot", "I", 1.0)}, "hot": {"I": ("hot", "I", 1.1), "T": ("hit", "I", 0.2)}, "hit": {"I": ("hot", "I", 1.1)}})
    return reported, negation, target, threat, insult


def grammar() -> Composed:
    """reported o negation o target o threat o insult."""
    return Composed(*transducers())


class Lexicon(dict):
    """Weights of learned words; ``harm`` holds those that announce harm, all others insult."""

    def __init__(self, weights: dict[str, float] | None = None, harm: frozenset[str] = frozenset()):
        super().__init__(weights or {})
        self.harm = harm

    def __reduce__(self):
        return Lexicon, (dict(self), self.harm)

    def symbol(self, word: str) -> str:
        """The word's class: function words first."""
        return CLASSES.get(word) or ("-" if word not in self else "H" if word in self.harm else "I")


def clause_weight(found: list[str], lexicon: Lexicon, machine: Composed) -> float:
    """Weight of one clause's words."""
    state, total, insult, harm = machine.start, 0.0, 0.0, 0.0
    for w in found:
        symbol = lexicon.symbol(w)
        state, emitted, factor = machine.step(state, symbol)
        # A heavy word that is read is held with the arcs it met, for the output that carries it.
        if symbol == "I":
            insult = lexicon[w] * factor
            total += insult if emitted == "I" else 0.0
        elif symbol == "H":
            harm = lexicon[w] * factor
            total += harm if emitted == "H" else 0.0
        elif emitted == "I":
            total += insult * factor
        elif emitted == "H":
            total += harm * factor
    return total


def clause_weights(text: str, lexicon: Lexicon, machine: Composed) -> list[float]:
    """Weight of each clause that has any; the rest weigh nothing."""
    out = []
    for clause in _CLAUSE.split(text):
        found = _WORD.findall(clause)
        if any(w in lexicon for w in found) and (weight := clause_weight(found, lexicon, machine)):
            out.append(weight)
    return out


def text_features(text: str | None, lexicon: Lexicon, machine: Composed) -> tuple[float, float, float]:
    low = (text or "").lower()
    if lexicon.keys().isdisjoint(_WORD.findall(low)):
        return 0.0, 0.0, 0.0
    got = clause_weights(low, lexicon, machine)
    total = sum(got)
    return math.log1p(total), max(got, default=0.0), 100.0 * total / (100.0 + len(low))


def part_of(text: str | None) -> int:
    return zlib.crc32((text or "").encode("utf-8", "surrogatepass")) % PARTS


def word_counts(sample: DataFrame) -> tuple[np.ndarray, dict[str, tuple[np.ndarray, np.ndarray]]]:
    """Documents by (part, label), and for each word in enough toxic ones the same and in how many it is announced, by part."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t, y in zip(b["text"], b["label"], strict=True):
                low, part = (t or "").lower(), part_of(t)
                own = set(_WORD.findall(low)) - CLASSES.keys()
                struck = announced(low) if y else set()
                rows += [("", part, int(y), 0), *((w, part, int(y), int(w in struck)) for w in own)]
            yield pd.DataFrame(rows, columns=["w", "part", "label", "struck"])

    counted = sample.mapInPandas(run, "w string, part int, label int, struck int")
    cell = lambda p, y: F.count(F.when((F.col("part") == p) & (F.col("label") == y), 1))
    counts = F.array(*[cell(p, y) for p in range(PARTS) for y in (0, 1)]).alias("n")
    struck = F.array(*[F.coalesce(F.sum(F.when(F.col("part") == p, F.col("struck"))), F.lit(0)) for p in range(PARTS)]).alias("struck")
    toxic = F.count(F.when(F.col("label") == 1, 1)).alias("toxic")
    got = counted.groupBy("w").agg(counts, struck, toxic).where((F.col("toxic") >= LEAST_DOCUMENTS) | (F.col("w") == "")).collect()
    table_ = {r["w"]: (np.array(r["n"], float).reshape(PARTS, 2), np.array(r["struck"], float)) for r in got}
    totals = table_.pop("", (np.zeros((PARTS, 2)), None))[0]
    return totals, table_


def learn(totals: np.ndarray, words: dict[str, tuple[np.ndarray, np.ndarray]], without: int | None = None) -> Lexicon:
    """Heavy words of all parts but one: smoothed log odds, shrunk where a word is rare."""
    use = np.arange(PARTS) != without
    n0, n1 = totals[use].sum(axis=0)
    weights, harm = {}, set()
    for w, (n, struck) in words.items():
        a, b = n[use].sum(axis=0)
        odds = math.log((b + 0.5) / (n1 + 1.0)) - math.log((a + 0.5) / (n0 + 1.0))
        if b >= LEAST_DOCUMENTS and odds >= LEAST_ODDS:
            weights[w] = min(MOST_ODDS, odds * (a + b) / (a + b + 2.0))
            if 2 * struck[use].sum() > b:
                harm.add(w)
    return Lexicon(weights, frozenset(harm))


def fit(labelled: DataFrame) -> tuple[Lexicon, list[float]]:
    """Heavy words and the logistic coefficients (bias first), from a bounded sample (text, label)."""
    sample = materialise(labelled.select("text", F.col("label").cast("int").alias("label")).where("label is not null"), "op1-sample")
    totals, words = word_counts(sample)
    if (totals.sum(axis=0) == 0).any():
        return Lexicon(), [-4.0, 0.0, 0.0, 0.0]
    parts = [learn(totals, words, p) for p in range(PARTS)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = grammar()
        for b in batches:
            x = np.array([text_features(t, parts[part_of(t)], machine) for t in b["text"]], float).reshape(len(b), 3)
            yield pd.DataFrame({"x0": x[:, 0], "x1": x[:, 1], "x2": x[:, 2], "y": b["label"].to_numpy()})

    got = np.array(sorted(map(tuple, sample.mapInPandas(run, "x0 double, x1 double, x2 double, y int").collect())), float)
    return learn(totals, words), logistic(got[:, :3], got[:, 3])


def announced(text: str) -> set[str]:
    """Words that stand after a word of intent and before a target in a clause, as a threat's harm does."""
    out = set()
    for clause in _CLAUSE.split(text):
        found = _WORD.findall(clause)
        kinds = [CLASSES.get(w) for w in found]
        if "F" in kinds and "T" in kinds[kinds.index("F") :]:
            last = len(kinds) - 1 - kinds[::-1].index("T")
            out |= set(found[kinds.index("F") + 1 : last])
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> list[float]:
    """Ridge logistic regression by Newton's method; either label weighs as it occurs."""
    a = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(a.shape[1])
    pull = ridge * np.eye(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (p - y) + pull @ beta
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + pull + 1e-9 * np.eye(len(beta)), grad)
        norm = np.abs(step).max()
        beta -= step * min(1.0, 5.0 / max(norm, 1e-12))
        if norm < 1e-6:
            break
    return [float(b) for b in beta]


def score(docs: DataFrame, model: tuple[Lexicon, list[float]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, clause_weight): every whole text through the composed machine."""
    weights, beta = model

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = grammar()
        for b in batches:
            x = np.array([text_features(t, weights, machine) for t in b["t"]], float).reshape(len(b), 3)
            z = np.clip(beta[0] + x @ np.array(beta[1:]), -30, 30)
            yield pd.DataFrame({"k": b["k"].astype("Int64"), "score": 1 / (1 + np.exp(-z)), "clause_weight": np.expm1(x[:, 0])})

    return docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).mapInPandas(run, "k long, score double, clause_weight double").withColumnRenamed("k", key)


def reject(docs: DataFrame, model: tuple[Lexicon, list[float]], text: str = "text", limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``limit`` or more."""
    weights, beta = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = grammar()
        for b in batches:
            z = np.array([beta[0] + np.dot(beta[1:], text_features(t.as_py(), weights, machine)) for t in b.column(text)])
            yield b.filter(pa.array(z < np.log(limit / (1 - limit)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def labelled_train(docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, label) of a bounded sample of the rows that the fold rule lets one learn from.

    The sample is drawn from the labels, at most ``rows`` of either label by a seeded hash of the key, and is small enough
    to be broadcast, so no text is shuffled.
    """
    known = labels.where((fold(F.col(key)) != 0) & F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias(label))
    draw = F.xxhash64(F.lit(5), F.col(key))
    picked = known.where(F.col(label) == 0).orderBy(draw, key).limit(rows).unionByName(known.where(F.col(label) == 1).orderBy(draw, key).limit(rows))
    return docs.select(F.col(key), F.col(text)).join(F.broadcast(picked), key).select(F.col(text).alias("text"), F.col(label).alias("label"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; learned from the rows outside fold 0."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score(docs, fit(labelled_train(docs, labels, "toxic")))
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "clause_weight")
