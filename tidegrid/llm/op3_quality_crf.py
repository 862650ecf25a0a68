"""Document quality from a linear-chain conditional random field over lines.

Every line is a position of the chain and is labelled good or bad.  A line's features describe its own shape and that of
the lines before and after it; forward-backward gives each line's marginal, and the marginals weighted by the lines'
lengths give the document's share of good text, which a logistic curve turns into the score.

Lines have no labels of their own: they are latent, and a document's label tells each line's through a channel that is
wrong with probability ``FLIP``.  Learning climbs the likelihood of the documents' labels by generalised
expectation-maximisation: forward-backward on the chain held to the channel gives the expected counts of line labels and
of neighbouring pairs, forward-backward on the free chain what the field expects, and the weights follow the difference.
So good documents may hold bad lines and the weights of neighbouring pairs learn how labels change along a text.

The fit uses a bounded sample: at most ``FIT_ROWS`` labelled rows of either label, drawn by a seeded hash of the key.  Their
lines are described on the executors, all lines of whole texts; to learn, chains over ``SEGMENT`` lines are cut into
segments, which lose the weight of the pair at a cut and nothing else.  Scoring reads every line of every whole text as
one chain.  Labels, lang, source and the key are never inputs.  Defined results: a null or empty text is one empty line;
equal texts score alike; of conflicting labels of one key the least counts; without labelled rows of both labels every
score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _GAP, fold, mix64, ngram_hashes, table, word_hashes
from .op1_toxicity import labelled_train, logistic

FIT_ROWS = 1000
SEGMENT = 128
FLIP = 0.1
ROUNDS = 80
_KINDS = {"symbol": b"#*$%&|<>@^~=+_{}[]\\/", "call": b"!?", "digit": b"0123456789", "upper": bytes(range(65, 91)), "stop": b".,;:", "lower": bytes(range(97, 123))}
_TABLE = np.zeros((len(_KINDS), 256), np.float32)
for _i, _cs in enumerate(_KINDS.values()):
    _TABLE[_i, list(_cs)] = 1
#: Own features of a line.
WIDTH = len(_KINDS) + 6


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x WIDTH features, length of each line in bytes)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data, np.uint8)
    cut = np.flatnonzero(raw == 10)
    start, end = np.concatenate(([0], cut + 1)), np.concatenate((cut, [len(raw)]))
    size = (end - start).astype(float)
    out = np.zeros((len(start), WIDTH), np.float32)
    safe = np.maximum(size, 1)
    for i in range(len(_KINDS)):
        sums = np.concatenate(([0.0], np.cumsum(_TABLE[i][raw])))
        out[:, i] = (sums[end] - sums[start]) / safe
    h, first, last = word_hashes(data)
    line_of = np.searchsorted(start, first, side="right") - 1
    n_words = np.bincount(line_of, minlength=len(start)).astype(float)
    k = len(_KINDS)
    out[:, k] = np.log1p(size) / 8
    out[:, k + 1] = np.minimum(size / np.maximum(n_words, 1), 40) / 20
    if len(h) >= 3:
        three = ngram_hashes(h, 3)
        _, back, count = np.unique(three, return_inverse=True, return_counts=True)
        hit = np.zeros(len(h), bool)
        again = count[back] > 1
        for j in range(3):
            hit[j : j + len(three)] |= again
        out[:, k + 2] = np.bincount(line_of, weights=hit, minlength=len(start)) / np.maximum(n_words, 1)
    if len(h):
        whole = np.zeros(len(start), np.uint64)
        np.add.at(whole, line_of, mix64(h + line_place(line_of)))
        _, back, count = np.unique(whole, return_inverse=True, return_counts=True)
        out[:, k + 3] = (count[back] > 1) & (n_words > 0)
    out[:, k + 4] = n_words == 0
    out[:, k + 5] = _GAP[raw].sum() / max(len(raw), 1)
    return out, size + 1


def line_place(line_of: np.ndarray) -> np.ndarray:
    """Place of each word within its line."""
    at = np.arange(len(line_of))
    new = np.concatenate(([True], line_of[1:] != line_of[:-1]))
    return (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)


def with_neighbours(x: np.ndarray) -> np.ndarray:
    """Bias, own features, those of the line before and of the line after (zero beyond the ends)."""
    pad = np.zeros((1, x.shape[1]), x.dtype)
    return np.hstack([np.ones((len(x), 1), x.dtype), x, np.vstack([pad, x[:-1]]), np.vstack([x[1:], pad])])


def marginals(unary: np.ndarray, trans: np.ndarray, lengths: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward of many chains at once; ``unary``: chains x lines x 2, padded.

    Node marginals, and the expected number of each pair of neighbouring labels, summed over chains with their weights.
    """
    n, t, _ = unary.shape
    e = np.exp(trans)
    psi = np.exp(unary - unary.max(axis=2, keepdims=True))
    fwd, bwd = np.zeros_like(psi), np.ones_like(psi)
    fwd[:, 0] = psi[:, 0] / psi[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, t):
        a = (fwd[:, i - 1] @ e) * psi[:, i]
        fwd[:, i] = a / a.sum(axis=1, keepdims=True)
    for i in range(t - 2, -1, -1):
        b = (psi[:, i + 1] * bwd[:, i + 1]) @ e.T
        b /= b.sum(axis=1, keepdims=True)
        bwd[:, i] = np.where((i + 1 < lengths)[:, None], b, 1.0)
    node = fwd * bwd
    node /= node.sum(axis=2, keepdims=True)
    edges = np.zeros((2, 2))
    if t > 1:
        pair = fwd[:, :-1, :, None] * e * (psi[:, 1:] * bwd[:, 1:])[:, :, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        real = (np.arange(1, t)[None, :] < lengths[:, None]) * (1.0 if weight is None else weight[:, None])
        edges = (pair * real[:, :, None, None]).sum(axis=(0, 1))
    return node, edges


def padded(parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(parts), max(map(len, parts)), parts[0].shape[1]))
    for i, p in enumerate(parts):
        out[i, : len(p)] = p
    return out


class Field:
    """Weights of the field: per feature and label, per pair of neighbouring labels, and the final curve."""

    def __init__(self, w: np.ndarray, trans: np.ndarray, curve: list[float]):
        self.w, self.trans, self.curve = w, trans, curve

    def good_share(self, parts: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
        """Length-weighted mean of the lines' good marginals; chains of like length run together."""
        out = np.zeros(len(parts))
        order = np.argsort([len(p) for p in parts], kind="stable")
        at = 0
        while at < len(order):
            top, group = max(1, len(parts[order[at]])), [order[at]]
            while at + len(group) < len(order) and len(parts[order[at + len(group)]]) <= 1.3 * top + 2 and len(group) < 512:
                group.append(order[at + len(group)])
            at += len(group)
            lengths = np.array([len(parts[g]) for g in group])
            unary = padded([with_neighbours(parts[g]) @ self.w for g in group])
            node, _ = marginals(unary, self.trans, lengths)
            for j, g in enumerate(group):
                out[g] = np.average(node[j, : len(parts[g]), 1], weights=sizes[g])
        return out

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        made = [line_features(t) for t in texts]
        share = self.good_share([m[0] for m in made], [m[1] for m in made])
        z = np.clip(self.curve[0] + self.curve[1] * logit(share), -30, 30)
        return 1 / (1 + np.exp(-z)), share


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def segments(x: np.ndarray) -> list[np.ndarray]:
    """A chain with its neighbours' features, in pieces of at most ``SEGMENT`` lines."""
    whole = with_neighbours(x)
    return [whole[i : i + SEGMENT] for i in range(0, len(whole), SEGMENT)]


def gradient(w: np.ndarray, trans: np.ndarray, data: list[tuple[np.ndarray, np.ndarray, np.ndarray]], share: np.ndarray) -> np.ndarray:
    """Derivative of the weighted log likelihood of the documents' labels by all weights.

    ``data``: blocks of (chains x lines x features, lengths, labels); ``share``: the weight of a line of either label.
    """
    channel = np.log(np.array([[1 - FLIP, FLIP], [FLIP, 1 - FLIP]]))
    gw, gt = np.zeros_like(w), np.zeros_like(trans)
    for x, n, y in data:
        unary, weight = x @ w, share[y]
        real = (np.arange(x.shape[1])[None, :] < n[:, None]) * weight[:, None]
        held, held_pairs = marginals(unary + channel[y][:, None, :], trans, n, weight)
        free, free_pairs = marginals(unary, trans, n, weight)
        gw += x.reshape(-1, x.shape[2]).T @ ((held - free) * real[:, :, None]).reshape(-1, 2)
        gt += held_pairs - free_pairs
    return np.concatenate([gw.ravel(), gt.ravel()])


def train(made: list[tuple[np.ndarray, np.ndarray]], ys: np.ndarray, rounds: int = ROUNDS) -> Field:
    """Gradient ascent (Adam) on the likelihood of the documents' labels, either label weighing the same.

    ``made``: features and lengths of each document's lines.
    """
    parts = [(p, int(y)) for (x, _), y in zip(made, ys, strict=True) for p in segments(x)]
    parts.sort(key=lambda p: len(p[0]))
    blocks = [parts[i : i + 512] for i in range(0, len(parts), 512)]
    data = [(padded([p for p, _ in b]), np.array([len(p) for p, _ in b]), np.array([y for _, y in b])) for b in blocks]
    lines = np.array([sum(n[y == label].sum() for _, n, y in data) for label in (0, 1)], float)
    share = 1.0 / (2 * np.maximum(lines, 1.0))
    k = 1 + 3 * WIDTH
    theta, m, v = np.zeros(2 * k + 4), np.zeros(2 * k + 4), np.zeros(2 * k + 4)
    for r in range(1, rounds + 1):
        g = gradient(theta[: 2 * k].reshape(k, 2), theta[2 * k :].reshape(2, 2), data, share) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + 0.1 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    out = Field(theta[: 2 * k].reshape(k, 2), theta[2 * k :].reshape(2, 2), [0.0, 1.0])
    good = out.good_share([x for x, _ in made], [s for _, s in made])
    out.curve = logistic(logit(good)[:, None], ys)
    return out


def described(labelled: DataFrame) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Lines' features and lengths of a bounded sample (text, label), made on the executors; in a definite order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [line_features(t) for t in b["text"]]
            yield pd.DataFrame({"y": b["label"].to_numpy(), "x": [x.astype("<f4").tobytes() for x, _ in made], "s": [s.astype("<f4").tobytes() for _, s in made]})

    rows = labelled.select("text", F.col("label").cast("int").alias("label")).where("label is not null")
    got = sorted((r["y"], bytes(r["x"]), bytes(r["s"])) for r in rows.mapInPandas(run, "y int, x binary, s binary").collect())
    return [(np.frombuffer(x, "<f4").reshape(-1, WIDTH), np.frombuffer(s, "<f4")) for _, x, s in got], np.array([y for y, _, _ in got], float)


def fit(labelled: DataFrame) -> Field:
    """The field learned from a bounded sample (text, label)."""
    made, ys = described(labelled)
    if len(set(ys.tolist())) < 2:
        return Field(np.zeros((1 + 3 * WIDTH, 2)), np.zeros((2, 2)), [0.0, 0.0])
    return train(made, ys)


def score(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, good_share) of every whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at : at + 512]
                s, share = field.scores(part["t"].tolist())
                yield pd.DataFrame({"k": part["k"].astype("Int64"), "score": s, "good_share": share})

    return docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).mapInPandas(run, "k long, score double, good_share double").withColumnRenamed("k", key)


def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality; learned from the rows outside fold 0."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score(docs, fit(labelled_train(docs, labels, "quality", FIT_ROWS)))
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "good_share")
