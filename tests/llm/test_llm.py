"""Training-data operators against brute force on small tables, with nulls, empty texts, ties, repeats and clashing names."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import common, op1_toxicity, op3_quality_crf, op4_near_dedup, op5_mixing, op6_quality_rules, op7_warc, op8_decontaminate, op9_sharding, op10_language_model
from tidegrid.llm import op2_substring_dedup as op2

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = [a + b for a in "ka lo mi nu pe ra so tu".split() for b in "ban cel dor fim gun".split()]


def words(seed, n):
    rng = random.Random(seed)
    return [rng.choice(VOCAB) for _ in range(n)]


def corpus():
    base = words(1, 300)
    near = [w if i % 40 else "changed" for i, w in enumerate(base)]
    texts = [" ".join(base), " ".join(base), " ".join(near), None, "", " \n\t ", "one two", "one two", "One TWO", " ".join(words(2, 120)), " ".join(words(3, 60) + base[100:160]), "é ü x " * 30, "same " * 100, " ".join(words(9, 2000))]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}", 0) for i, t in enumerate(texts)]
    return rows + [rows[0], (None, "null key", "en", "s0", 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).withColumns({"row": F.lit(1), "size": F.lit("x"), "uid": F.lit(2), "n": F.lit(3), "k": F.lit(4), "kept": F.lit("y"), "shard": F.lit(0), "tokens": F.lit("q"), "key": F.lit("z")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(13)], "doc_id long, quality int, toxic int")


def toks(t):
    return (t or "").encode().split()


# --- 1 and 3 -----------------------------------------------------------------


def lexicon(insults="idiot", harm="kill"):
    return op1_toxicity.Lexicon(dict.fromkeys([*insults.split(), *harm.split()], 2.0), frozenset(harm.split()))


def test_grammar_scores_clauses_not_words():
    m, w = op1_toxicity.grammar(), lexicon()
    weigh = lambda t: sum(op1_toxicity.clause_weights(t, w, m))
    assert weigh("you idiot") > weigh("an idiot") > weigh("not an idiot") > 0
    assert weigh("he said idiot") < weigh("you idiot") and weigh("idiot that you are") > weigh("idiot that is")
    assert weigh("an idiot idiot") > 2 * weigh("an idiot")
    assert weigh("i will kill you") > weigh("i will not kill you") >= 0 and not weigh("kill the lights")
    assert not op1_toxicity.clause_weights("no harm here. none", w, m)


def test_composition_equals_the_cascade():
    """The composed machine against one transducer after another over the whole clause."""
    rng, composed = random.Random(6), op1_toxicity.grammar()
    vocab = ["idiot", "kill", "you", "will", "not", "said", "tree", "moss"]
    lex = lexicon("idiot", "kill")
    for _ in range(400):
        clause = [rng.choice(vocab) for _ in range(rng.randint(1, 9))]
        tape, weights = [lex.symbol(w) for w in clause], [1.0] * len(clause)
        read = list(tape)
        for t in op1_toxicity.transducers():
            state, out = t.start, []
            for i, x in enumerate(tape):
                state, y, w = t.step(state, x)
                out.append(y)
                weights[i] *= w
            tape = out
        state, got = composed.start, []
        for x in read:
            state, y, w = composed.step(state, x)
            got.append((y, w))
        assert [y for y, _ in got] == tape and np.allclose([w for _, w in got], weights)
        held, total = {"I": 0.0, "H": 0.0}, 0.0
        for w, x, y, f in zip(clause, read, tape, weights, strict=True):
            if x in held:
                held[x] = 2.0 * f
                total += held[x] if y == x else 0.0
            elif y in held:
                total += held[y] * f
        assert math.isclose(op1_toxicity.clause_weight(clause, lex, composed), total, abs_tol=1e-12)


def test_toxicity_learns_and_scores_every_row(spark, docs, labels, empty):
    rows = [(i, f"{' '.join(words(i, 20))} {'you idiot' if i % 4 == 0 else ''}", int(i % 4 == 0)) for i in range(100)]
    d = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    y = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    model = op1_toxicity.fit(op1_toxicity.labelled_train(d, y, "toxic"))
    got = {r.doc_id: r.score for r in op1_toxicity.score(d, model).collect()}
    assert all((got[i] >= 0.5) == bool(x) for i, _, x in rows)
    lex, beta = model
    for i, t, _ in rows:
        x = op1_toxicity.text_features(t, lex, op1_toxicity.grammar())
        assert math.isclose(got[i], 1 / (1 + math.exp(-(beta[0] + sum(b * v for b, v in zip(beta[1:], x, strict=True))))), rel_tol=1e-9)
    wide = docs.withColumns({c: F.lit(1) for c in ("score", "clause_weight", "t", "x0")})
    assert op1_toxicity.score(wide, model).count() == 16 and op1_toxicity.score(empty, model).count() == 0
    assert op1_toxicity.reject(d, model).count() == 75 and op1_toxicity.reject(empty, model).count() == 0
    assert op1_toxicity.reject(wide, model).columns == wide.columns
    nothing, bias = op1_toxicity.fit(op1_toxicity.labelled_train(empty, labels.limit(0), "toxic"))
    assert not nothing and op1_toxicity.score(docs, (nothing, bias)).where("score >= 0.5").count() == 0


def test_toxic_words_are_learned_from_labels(spark):
    bad = ["blork", "schnurz", "grøft"]
    rows = [(i, f"{' '.join(words(i, 20))} {'you ' + bad[i // 4 % 3] if i % 4 == 0 else ''}", int(i % 4 == 0)) for i in range(160)]
    d = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    y = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    model = op1_toxicity.fit(op1_toxicity.labelled_train(d, y, "toxic"))
    got = {r.doc_id: r.score for r in op1_toxicity.score(d, model).collect()}
    assert set(bad) <= model[0].keys() and all((got[i] >= 0.5) == bool(x) for i, _, x in rows)
    threats = [(f"{' '.join(words(i, 20))}. i will blork you", 1.0) if i % 2 else (" ".join(words(i, 20)), 0.0) for i in range(60)]
    learned, _ = op1_toxicity.fit(spark.createDataFrame(threats, "text string, label double"))
    assert "blork" in learned.harm and not op1_toxicity.clause_weights("blork the lights", learned, op1_toxicity.grammar())


def test_toxic_words_far_into_a_long_text_count(spark):
    """Learned and found beyond any prefix; conflicting labels of a key count as the least."""
    long = " ".join(words(3, 30_000))
    rows = [(i, f"{long} {i}. you blork" if i % 2 else f"{long} {i}", i % 2) for i in range(24)]
    d = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    y = spark.createDataFrame([(i, x) for i, _, x in rows] + [(1, 0)], "doc_id long, toxic int")
    model = op1_toxicity.fit(op1_toxicity.labelled_train(d, y, "toxic"))
    assert "blork" in model[0]
    got = {r.doc_id: r.clause_weight for r in op1_toxicity.score(d, model).collect()}
    assert all((got[i] > 0) == bool(x) for i, _, x in rows)


def test_held_out_toxicity(spark):
    d = "/root/testdata/sf0.01"
    out = op1_toxicity.op1_toxicity(spark, d).join(common.table(spark, d, "labels"), "doc_id").where("held_out").groupBy("toxic").agg(F.avg("predicted").alias("hit")).collect()
    hit = {r.toxic: r.hit for r in out}
    assert hit[0] <= 0.02 and hit[1] >= 0.6


def test_crf_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    unary, trans = rng.normal(size=(1, 4, 2)), rng.normal(size=(2, 2))
    node, edges = op3_quality_crf.marginals(unary, trans, np.array([4]))
    z, want, pairs = 0.0, np.zeros((4, 2)), np.zeros((2, 2))
    for code in range(16):
        y = [(code >> i) & 1 for i in range(4)]
        p = math.exp(sum(unary[0, i, y[i]] for i in range(4)) + sum(trans[y[i], y[i + 1]] for i in range(3)))
        z += p
        for i in range(4):
            want[i, y[i]] += p
        for i in range(3):
            pairs[y[i], y[i + 1]] += p
    assert np.allclose(node[0], want / z) and np.allclose(edges, pairs / z)


def test_crf_pair_counts_are_weighted_by_chain():
    rng = np.random.default_rng(1)
    unary, trans = rng.normal(size=(3, 5, 2)), rng.normal(size=(2, 2))
    lengths, weight = np.array([5, 2, 1]), np.array([0.5, 2.0, 3.0])
    _, both = op3_quality_crf.marginals(unary, trans, lengths, weight)
    alone = sum(w * op3_quality_crf.marginals(unary[i : i + 1, :n], trans, np.array([n]))[1] for i, (n, w) in enumerate(zip(lengths, weight, strict=True)))
    assert np.allclose(both, alone)


def test_crf_separates_shapes_of_lines(spark, docs, empty):
    good = [" ".join(words(i, 30)) + ".\n" + " ".join(words(i + 500, 25)) + "." for i in range(60)]
    bad = [" ".join(w + "%%%" for w in words(i, 40)) for i in range(60)]
    field = op3_quality_crf.train([op3_quality_crf.line_features(t) for t in good[:40] + bad[:40]], np.array([1.0] * 40 + [0.0] * 40), rounds=60)
    s, _ = field.scores(good[40:] + bad[40:])
    assert (s[:20] > 0.5).all() and (s[20:] < 0.3).all()
    got = op3_quality_crf.score(docs.withColumns({c: F.lit(1) for c in ("score", "good_share", "t")}), field)
    assert got.count() == 16 and got.where("score is null or isnan(score)").count() == 0
    assert op3_quality_crf.score(empty, field).count() == 0


def test_crf_score_is_the_weighted_marginal(spark):
    """Scores of short texts against the enumeration of all labellings of their lines."""
    rng = np.random.default_rng(2)
    field = op3_quality_crf.Field(rng.normal(size=(1 + 3 * op3_quality_crf.WIDTH, 2)), rng.normal(size=(2, 2)), [0.3, 0.7])
    texts = ["a b c.\nd e!\n\n## x", "one line", "", "p q\np q\nr"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.score, r.good_share) for r in op3_quality_crf.score(d, field).collect()}
    for i, t in enumerate(texts):
        x, sizes = op3_quality_crf.line_features(t)
        unary, n = op3_quality_crf.with_neighbours(x) @ field.w, len(x)
        z, good = 0.0, np.zeros(n)
        for code in range(1 << n):
            y = [(code >> j) & 1 for j in range(n)]
            p = math.exp(sum(unary[j, y[j]] for j in range(n)) + sum(field.trans[y[j], y[j + 1]] for j in range(n - 1)))
            z, good = z + p, good + p * np.array(y)
        share = float((good / z * sizes).sum() / sizes.sum())
        q = min(max(share, 1e-4), 1 - 1e-4)
        assert np.allclose(got[i], (1 / (1 + math.exp(-(0.3 + 0.7 * math.log(q / (1 - q))))), share), atol=1e-5)


def test_crf_climbs_the_likelihood_of_latent_lines():
    """The gradient against differences of the likelihood, which is summed over all labellings of the lines."""
    rng = np.random.default_rng(7)
    x, n, y = rng.normal(size=(3, 4, 2)), np.array([4, 2, 1]), np.array([0, 1, 1])
    share = np.array([0.5, 2.0])

    def likelihood(theta):
        w, trans, total = theta[:4].reshape(2, 2), theta[4:].reshape(2, 2), 0.0
        for chain, m, label in zip(x, n, y, strict=True):
            z, seen = 0.0, 0.0
            for code in range(1 << m):
                ls = [(code >> j) & 1 for j in range(m)]
                p = math.exp(sum((chain[j] @ w)[ls[j]] for j in range(m)) + sum(trans[ls[j], ls[j + 1]] for j in range(m - 1)))
                z += p
                seen += p * math.prod(1 - op3_quality_crf.FLIP if v == label else op3_quality_crf.FLIP for v in ls)
            total += share[label] * math.log(seen / z)
        return total

    theta = rng.normal(size=8)
    got = op3_quality_crf.gradient(theta[:4].reshape(2, 2), theta[4:].reshape(2, 2), [(x, n, y)], share)
    step = 1e-5 * np.eye(8)
    assert np.allclose(got, [(likelihood(theta + e) - likelihood(theta - e)) / 2e-5 for e in step], atol=1e-6)


def test_long_chains_are_learned_whole(spark):
    """A text of many lines whose bad ones come late."""
    plain = "\n".join(" ".join(words(i, 8)) + "." for i in range(1500))
    texts = [(plain, 1)] * 4 + [(plain[:3000] + "\n" + "\n".join("%% ## 11 $$" for _ in range(2000)), 0)] * 4
    made, ys = op3_quality_crf.described(spark.createDataFrame(texts, "text string, label int"))
    assert sorted(len(x) for x, _ in made)[-1] > 1900
    field = op3_quality_crf.train(made, ys, rounds=40)
    s, _ = field.scores([t for t, _ in texts])
    assert s[:4].min() > 0.5 > s[4:].max()


def test_held_out_quality(spark):
    d = "/root/testdata/sf0.01"
    out = op3_quality_crf.op3_quality_crf(spark, d).join(common.table(spark, d, "labels"), "doc_id").where("held_out").groupBy("quality").agg(F.avg("predicted").alias("hit")).collect()
    hit = {r.quality: r.hit for r in out}
    assert hit[1] >= 0.95 and hit[0] <= 0.25


# --- 2 -----------------------------------------------------------------------


def removed(texts, window):
    count = Counter(tuple(w[s : s + window]) for w in texts for s in range(len(w) - window + 1))
    out = []
    for w in texts:
        cover = [False] * len(w)
        for s in range(len(w) - window + 1):
            if count[tuple(w[s : s + window])] > 1:
                cover[s : s + window] = [True] * window
        out.append([x for x, c in zip(w, cover, strict=True) if not c])
    return out


@pytest.mark.parametrize("many", [64, 0])
def test_substring_dedup_is_exact(docs, many):
    docs = docs.withColumns({c: F.lit(1) for c in ("t", "chk", "place", "owner", "piece", "los", "his")})
    rows = [(r.doc_id, toks(r.text)) for r in docs.collect()]
    want = Counter((i, len(w), len(w) - len(k), b" ".join(k)) for (i, w), k in zip(rows, removed([w for _, w in rows], 35), strict=True))
    got = op2.dedup(docs, many=many, shard_words=200)
    assert Counter((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in got.collect()) == want


def test_substring_dedup_of_very_long_texts(spark):
    """A passage far inside two long texts, and one owner with more distinct pieces than MANY."""
    shared, hub = words(71, 50), words(72, 34)
    texts = [words(73, 60_000) + shared + words(74, 100), words(75, 40) + shared + words(76, 60_000)]
    texts += [hub + [f"tail{i // 2}"] + words(100 + i, 20) for i in range(200)]
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept).decode().split() for r in op2.dedup(d).collect()}
    assert [got[i] for i in range(len(texts))] == removed(texts, 35)


def test_least_values_of_windows():
    rng = np.random.default_rng(4)
    for n, wide, top in ((30, 30, 9), (31, 30, 9), (200, 7, 4), (95, 30, 2**62), (60, 1, 5)):
        v = rng.integers(0, top, n).astype(np.uint64)
        seen = np.lib.stride_tricks.sliding_window_view(v, wide)[:, ::-1]
        assert (op2.rightmost_least(v, wide) == np.arange(len(seen)) + wide - 1 - seen.argmin(axis=1)).all()


def test_substring_dedup_of_nothing(empty):
    assert op2.dedup(empty).count() == 0


def test_automaton_matching_statistics():
    rng = random.Random(5)
    texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(5, 40))] for _ in range(12)]
    a = op2.SuffixAutomaton()
    for t in texts:
        a.add(t, 1)
    best = a.repeated()
    for t, kept in zip(texts, removed(texts, 5), strict=True):
        spans = op2.repeated_spans(a, best, t, 5)
        cover = {i for s, e in spans for i in range(s, e)}
        assert [w for i, w in enumerate(t) if i not in cover] == kept


# --- 4 -----------------------------------------------------------------------


def shingles(t):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(k, len(sets[i]), least.get(find(i)) if sets[i] else k) for i, (k, _) in enumerate(rows)]


def test_near_duplicates_match_brute_force(spark, docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = op4_near_dedup.near_duplicates(docs)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == Counter(components(rows))
    assert op4_near_dedup.near_duplicates(empty).count() == 0


def test_a_large_group_of_near_copies_is_one_component(spark):
    base, rng = words(77, 200), random.Random(3)
    texts = []
    for _ in range(150):
        w = list(base)
        w[rng.randrange(200)] = f"x{rng.random()}"
        texts.append(" ".join(w))
    d = spark.createDataFrame(list(enumerate(texts + [" ".join(words(i, 80)) for i in range(900, 950)])), "doc_id long, text string")
    assert op4_near_dedup.near_duplicates(d).where("kept").count() == 51
    assert op4_near_dedup.representatives(d).count() == 51


def star(n, seed=5):
    """A base and copies with ten scattered edits each, similar to the base but hardly to each other."""
    base, rng = words(78, 400), random.Random(seed)
    texts = [" ".join(base)]
    for _ in range(n):
        w = list(base)
        for i in range(10):
            w[20 + 40 * i + rng.randrange(-10, 11)] = f"y{rng.random()}"
        texts.append(" ".join(w))
    return texts


def test_a_star_of_copies_is_one_component(spark):
    texts = star(1500)
    sets = [shingles(t) for t in texts]
    assert all(100 * len(sets[0] & s) >= 75 * len(sets[0] | s) for s in sets)
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert op4_near_dedup.near_duplicates(d).where("kept").count() == 1


def test_blocks_of_a_region_find_every_similar_pair(spark, monkeypatch):
    monkeypatch.setattr(op4_near_dedup, "BLOCK_SHINGLES", 4000)
    texts = star(40) + star(40, 6)[1:] + [" ".join(words(i, 60)) for i in range(20)]
    sets = [sorted(op4_near_dedup.shingle_set(t) >> np.uint64(16)) for t in texts]
    rows = [(i, op4_near_dedup.pack(np.array(s, np.uint64), 6)) for i, s in enumerate(sets)]
    packed = spark.createDataFrame(rows, "node long, s binary")
    crowd = spark.createDataFrame([(0, 7, i, len(s)) for i, s in enumerate(sets)], "tree int, prefix long, node long, n int")
    nothing = spark.createDataFrame([], "node long, root long")
    want = {(i, j) for j, t in enumerate(sets) for i, s in enumerate(sets[:j]) if 100 * len(set(s) & set(t)) >= 75 * len(set(s) | set(t))}
    assert {(r.a, r.b) for r in op4_near_dedup.against_all(crowd, nothing, packed).collect()} == want and len(want) >= 80


def test_classes_of_one_signature_spread_over_ranges(spark, monkeypatch):
    """Many classes under one node of the forest: ranges cut through their region and no pair is lost."""
    monkeypatch.setattr(op4_near_dedup, "ROWS_PER_RANGE", 300)
    base = words(79, 150)
    texts = [" ".join(base[:i] + [f"v{i}"] + base[i + 1 :]) for i in range(0, 150, 3)] + [" ".join(words(i, 40)) for i in range(30)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = op4_near_dedup.near_duplicates(d)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == Counter(components(list(enumerate(texts))))


def test_near_duplicates_of_very_long_texts(spark):
    long = words(80, 80_000)
    other = [w if i % 500 else "changed" for i, w in enumerate(long)]
    d = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(other)), (3, " ".join(words(81, 80_000)))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in op4_near_dedup.near_duplicates(d).collect()} == {1: 1, 2: 1, 3: 3}


def test_representatives_keep_one_of_equal_rows(spark, docs):
    wide = spark.createDataFrame([(1, "a b c", 5), (1, "a b c", 6), (2, None, 7)], "doc_id long, text string, _uid long").withColumns({"id": F.lit(0), "tie": F.lit(0), "row": F.lit(0)})
    kept = op4_near_dedup.representatives(wide)
    assert kept.columns == wide.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    got = op4_near_dedup.representatives(docs)
    assert got.columns == docs.columns and got.where("doc_id = 0").count() == 1


# --- 5 -----------------------------------------------------------------------


def test_rates_reach_the_targets(spark):
    rows = [(float(10 + i % 7), [0.9, 0.1] if i % 3 else [0.2, 0.8]) for i in range(600)]
    m = spark.createDataFrame(rows, "tokens double, p array<double>")
    rate, report = op5_mixing.fit_rates(m, ["a", "b"], {"a": 0.5, "b": 0.5}, 1.0)
    got = m.withColumn("r", rate).agg(*[F.sum(F.col("r") * F.col("tokens") * F.get("p", F.lit(k))) for k in (0, 1)]).first()
    assert np.allclose(list(got), report["targets"], rtol=2e-3) and abs(got[0] - got[1]) < 0.01 * got[0]
    assert m.withColumn("r", rate).where("r < 0 or r > 1").count() == 0


def bounded_least_squares(a, goal, top, sweeps=20000):
    """min sum (a r - goal)^2 / (2 goal), 0 <= r <= top, one coordinate after another."""
    r, left = np.zeros(a.shape[1]), -goal.copy()
    for s in range(sweeps):
        i = s % len(r)
        col = a[:, i]
        new = min(top, max(0.0, r[i] - (col / goal) @ left / ((col / goal) @ col)))
        left = left + (new - r[i]) * col
        r[i] = new
    return (left**2 / (2 * goal)).sum()


def test_rates_are_the_least_squares_optimum(spark):
    rng = random.Random(4)
    kinds = [[rng.random() ** 2 for _ in range(3)] for _ in range(6)]
    kinds = [[round(x / sum(p), 3) for x in p] for p in kinds]
    rows = [(float(rng.randint(5, 60)), kinds[rng.randrange(6)]) for _ in range(300)]
    m = spark.createDataFrame(rows, "tokens double, p array<double>")
    for targets, top in (({"a": 2.0, "b": 1.0, "c": 1.0}, 1.0), ({"a": 1.0, "b": 1.0, "c": 9.0}, 4.0)):
        rate, report = op5_mixing.fit_rates(m, ["a", "b", "c"], targets, top)
        goal = np.array(report["targets"])
        a = np.array([[sum(n for n, p in rows if p == kind) * kind[k] for kind in kinds] for k in range(3)])
        best = bounded_least_squares(a, goal, top)
        own = ((np.array(report["totals"]) - goal) ** 2 / (2 * goal)).sum()
        assert own <= best + 1e-3 * goal.sum()
        assert np.allclose(goal / goal.sum(), np.array(list(targets.values())) / sum(targets.values()))


def test_posteriors_match_a_gaussian_classifier(spark):
    texts = [" ".join(words(i, 30)) + ("." if i % 2 else " ### | $$ 12 ") * (i % 5 + 1) for i in range(40)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    y = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    members, domains = op5_mixing.classify(d, y, "doc_id", "text", ("quality",))
    x = {r.doc_id: np.array([v for v in r[1:]]) for r in d.select("doc_id", *[c.alias(n) for n, c in op5_mixing.features(F.col("text")).items()]).collect()}
    logs = {i: [] for i in x}
    for k in (0, 1):
        own = np.array([x[i] for i in range(30) if i % 2 == k])
        mean, var = own.mean(axis=0), own.var(axis=0) + 0.02
        for i in x:
            logs[i].append(math.log(0.5) - ((x[i] - mean) ** 2 / (2 * var)).sum() - 0.5 * np.log(var).sum())
    for r in members.select("row.doc_id", "p").collect():
        e = np.exp(np.maximum(np.array(logs[r.doc_id]) - max(logs[r.doc_id]), -50))
        assert domains == ["0", "1"] and np.allclose(r.p, np.round(e / e.sum(), 3), atol=1.1e-3)


def test_mixing_rows_and_columns(docs, empty, labels):
    wide = docs.withColumns({"_copies": F.lit(1), "_uid": F.lit(2), "_n": F.lit(3), "row": F.lit(4), "p": F.lit(5), "draw": F.lit(6)})
    assert op5_mixing.mix(wide, labels).count() == 16
    assert op5_mixing.mixed(wide, labels).columns == wide.columns
    assert op5_mixing.mixed(empty, labels).count() == 0
    assert op5_mixing.mixed(wide, labels.limit(0)).count() == 16
    taken = Counter(r.doc_id for r in op5_mixing.mixed(wide, labels.limit(0), targets={"all": 1.0}).collect())
    assert taken == Counter(r.doc_id for r in wide.collect())


# --- 6 -----------------------------------------------------------------------


def base_counts(t):
    t = t or ""
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", t) if x]
    at = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + j for i in range(len(w) - 2) if at[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if __import__("re").search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


def test_rule_counts(spark, docs, empty):
    extra = spark.createDataFrame([(100, "a b c a b c a b", "en", "s", 0), (101, "x x x x x\nx\n \nx\nq", "en", "s", 0), (102, "a#b $$ | <p>\n\n", "en", "s", 0)], SCHEMA)
    d = docs.select(*extra.columns).unionByName(extra)
    got = op6_quality_rules.judge(op6_quality_rules.measure(d)).collect()
    want = Counter((r.doc_id, *base_counts(r.text)) for r in d.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in got)
    assert op6_quality_rules.judge(op6_quality_rules.measure(empty)).count() == 0


def test_sketch_keeps_leading_digits_of_any_value(spark):
    values = [0, 1, 1023, 1024, 1025, 50_000, 50_049, 123_456_789, 2**61 + 12345]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v long").select(op6_quality_rules._bin(F.col("v"))).collect()]
    assert got == [v >> max(v.bit_length() - 10, 0) << max(v.bit_length() - 10, 0) for v in values]
    assert all(v * (1 - 2**-9) <= g <= v for v, g in zip(values, got, strict=True))


def test_ratios_far_out_are_judged(spark):
    """Words of 60 characters are a source's habit and kept there; one of 4000 a word is not."""
    rows = [(i, " ".join("x" * (50 + (i * 7 + j * 3) % 20) + str(j) for j in range(60)), "zh", "s", 0) for i in range(300)]
    rows.append((999, " ".join("y" * 4000 + str(j) for j in range(60)), "zh", "s", 0))
    got = {r.doc_id: r for r in op6_quality_rules.judge(op6_quality_rules.measure(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert not got[999].kept and all(r.kept for i, r in got.items() if i != 999)
    assert {r.thresholds_of for r in got.values()} == {"source"}


# --- 7 -----------------------------------------------------------------------


def split_members(data):
    """Each gzip member of a file, read alone from its offset."""
    out = []
    while data:
        d = zlib.decompressobj(31)
        out.append(d.decompress(data))
        assert d.eof
        data = d.unused_data
    return out


def test_warc_of_bytes_and_repeated_rows(spark, tmp_path):
    raw = bytes(range(256)) * 700
    rows = [(1, "u", bytearray(raw)), (1, "u", bytearray(raw)), (2, "u", bytearray(raw)), (3, "u", None), (None, "u", bytearray(b"\x00"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html binary").repartition(2)
    op7_warc.write_archives(pages, f"file://{tmp_path}/w")
    got = op7_warc.read_archives(spark, f"file://{tmp_path}/w").collect()
    assert Counter((r.page, r.kind, r.refers, r.n) for r in got) == Counter({(1, "response", None, len(raw)): 2, (2, "revisit", 1, len(raw)): 1, (3, "response", None, 0): 1, (None, "response", None, 1): 1})
    assert all(bytes(r.payload) == raw for r in got if r.page == 1) and len({r.record_id for r in got}) == 5


def test_warc_round_trip(spark, tmp_path):
    long = "añb\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9000
    rows = [(3, "u", "same"), (1, None, "same"), (2, "u\r\nx", long), (5, "u", None), (4, "u", ""), (6, "u", "é" * 5000), (None, "u", "lone"), (7, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("n", F.lit(1)).withColumn("sha", F.lit("x"))
    op7_warc.write_archives(pages, f"file://{tmp_path}/w", segment_bytes=1000, records_per_file=50)
    got = {r.page: r for r in op7_warc.read_archives(spark, f"file://{tmp_path}/w").collect()}
    assert {r.refers_to_record for r in got.values()} - {None} <= {r.record_id for r in got.values() if r.kind == "response"}
    members = [m for f in tmp_path.glob("w/part-*") for m in split_members(f.read_bytes())]
    assert len(members) > 300 and all(m.startswith(b"WARC/1.1") and m.count(b"WARC-Record-ID") == 1 for m in members)
    assert len(got) == len(rows)
    first = {1: 1, 3: 1, 7: 1, 4: 4, 5: 4}
    for k, _, h in rows:
        data = (h or "").encode()
        assert (got[k].sha, got[k].n) == (op7_warc.digest(data), len(data))
        if first.get(k, k) == k:
            assert got[k].kind == "response" and bytes(got[k].payload) == data
        else:
            assert (got[k].kind, got[k].refers, got[k].payload) == ("revisit", first[k], None)


def test_warc_of_nothing(spark, tmp_path):
    op7_warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}/w")
    assert op7_warc.read_archives(spark, f"file://{tmp_path}/w").count() == 0


def test_chunked_framing():
    for data in (b"", b"x", "é€😀".encode() * 3000):
        assert op7_warc.unchunked(op7_warc.chunked(data, 100)) == data
    with pytest.raises(ValueError):
        op7_warc.unchunked(b"5\r\nabc")


# --- 8 -----------------------------------------------------------------------


def leaks(text, item):
    def bag(w):
        return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()

    w, q = (text or "").lower().split(), item.lower().split()
    goal = bag(q)
    m = sum(goal.values())
    for s in range(max(1, len(w) - len(q) + 1)):
        own = bag(w[s : s + len(q)])
        both = sum((own & goal).values())
        if own and 100 * both >= 75 * (sum(own.values()) + m - both):
            return True
    return False


def test_decontamination_matches_brute_force(spark, docs, empty):
    items = [(i, " ".join(words(40 + i, 12 + 5 * i))) for i in range(6)] + [(6, "tiny item"), (7, "")]
    texts = []
    for i in range(40):
        q = items[i % 6][1].split()
        if i % 4 == 1:
            q[len(q) // 2] = "edited"
        if i % 4 == 2:
            q = q[: len(q) // 2]
        if i % 4 == 3:
            q = q[: len(q) * 9 // 10] + ["tail"] * 3
        texts.append(" ".join(words(200 + i, 50) + q + words(300 + i, 30)))
    texts += ["tiny item", "TINY item", None, "", items[2][1]]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.n_items > 0 for r in op8_decontaminate.contaminated(d, b).select("row.doc_id", "n_items").collect()}
    want = {i: any(leaks(t, q) for _, q in items if q) for i, t in enumerate(texts)}
    assert got == want and any(want.values()) and not all(want.values())
    wide = docs.withColumns({c: F.lit(1) for c in ("_items", "_row", "_similarity", "_n", "id", "items", "n_items", "row", "similarity")})
    kept = op8_decontaminate.contaminated(wide, b).where("n_items = 0").select("row.*")
    assert kept.count() == 16 and kept.columns == wide.columns
    assert op8_decontaminate.contaminated(d, b.limit(0)).where("n_items > 0").count() == 0
    assert op8_decontaminate.contaminated(empty, b).count() == 0


def test_block_search_finds_every_fingerprint_within_the_radius(spark):
    """Windows and items by their exact shared shingles: the search over blocks loses none that the radius holds."""
    base = words(61, 60)
    texts = [base[: 30 + i % 30] for i in range(60)]
    for i, w in enumerate(texts):
        for j in range(i % 6):
            w[(7 * i + 11 * j) % len(w)] = f"z{i}{j}"
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "item_id long, text string")
    table = op8_decontaminate.item_table(items, "item_id", "text").select("iid", "m", "s")
    windows = table.select("m", F.col("iid").alias("w1"), F.lit(0).alias("w2"), "s")
    prints = {r.iid: (r.m, r.lo, r.hi) for r in op8_decontaminate.fingerprints(table.select("iid", "m", F.explode("s").alias("sh")), ["iid", "m"], "sh").collect()}
    mask = (1 << 64) - 1
    apart = lambda x, y: ((x[1] ^ y[1]) & mask).bit_count() + ((x[2] ^ y[2]) & mask).bit_count()
    want = {(a, b) for a, x in prints.items() for b, y in prints.items() if x[0] == y[0] and apart(x, y) <= op8_decontaminate.RADIUS}
    got = {(r.w1, r.iid) for r in op8_decontaminate.nearby(windows, table).collect()}
    assert got == want and len(want) > len(prints)


def test_simhash_votes_by_bit(spark):
    rng = random.Random(8)
    bag = [rng.getrandbits(63) for _ in range(9)] * 2 + [rng.getrandbits(63)]
    got = op8_decontaminate.fingerprints(spark.createDataFrame([(1, x) for x in bag], "g int, sh long"), ["g"], "sh").first()
    assert got.lo & ((1 << 64) - 1) == sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in bag) > len(bag))


def test_a_long_text_leaks_one_passage(spark):
    item = " ".join(words(41, 40))
    long = " ".join(words(42, 60_000) + item.split() + words(43, 60_000))
    d = spark.createDataFrame([(1, long), (2, " ".join(words(44, 60_000)))], "doc_id long, text string")
    b = spark.createDataFrame([(5, item)], "item_id long, text string")
    got = {r.doc_id: r.n_items for r in op8_decontaminate.contaminated(d, b).select("row.doc_id", "n_items").collect()}
    assert got == {1: 1, 2: 0}


# --- 9 -----------------------------------------------------------------------


def test_sharding_laws(spark, docs, empty):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    got = op9_sharding.shard(d, bucket_bytes=2000).select("row.doc_id", "size", "shard", "slot", "grown_shard").collect()
    assert len(got) == 3000 and all(r.grown_shard in (r.shard, 8) for r in got)
    for s in range(8):
        own = sorted((r.slot, r.doc_id) for r in got if r.shard == s)
        assert [x for x, _ in own] == list(range(len(own))) and [k for _, k in own] != sorted(k for _, k in own)
    again = op9_sharding.shard(d.repartition(5), bucket_bytes=2000).select("row.doc_id", "shard", "slot").collect()
    assert {(r.doc_id, r.shard) for r in again} == {(r.doc_id, r.shard) for r in got}
    first = op9_sharding.shard(d, bucket_bytes=2000).select("row.doc_id", "shard", "slot")
    assert sorted(map(tuple, first.collect())) == sorted((r.doc_id, r.shard, r.slot) for r in got)
    assert op9_sharding.shard(docs).select("row.*").columns == docs.columns
    assert sorted((r.size, r.text or "") for r in op9_sharding.shard(docs).select("size", "row.text").collect()) == sorted((len((r.text or "").encode()) + 1, r.text or "") for r in docs.collect())
    assert op9_sharding.shard(docs).count() == 16 and op9_sharding.shard(empty).count() == 0


def test_a_hot_key_is_spread_over_buckets(spark):
    rows = [(None if i % 3 else i, "same text" if i % 2 else f"text {i}") for i in range(6000)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = op9_sharding.scatter(d, 8, 17, "doc_id", "text", 2000)[0].groupBy("shard", "bucket").agg(F.sum("item.size").alias("n"))
    assert held.agg(F.max("n")).first()[0] < 2 * 2000
    got = op9_sharding.shard(d, bucket_bytes=2000).select("row.doc_id", "shard", "slot").collect()
    assert len(got) == 6000 and len({r.shard for r in got if r.doc_id is None}) == 1
    for s, n in Counter(r.shard for r in got).items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))


# --- 10 ----------------------------------------------------------------------

END = "\0end"


def test_language_model(spark, docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    tk = [[*(w.decode() for w in (t or "").encode().lower().split()), END] for _, t in rows]
    learn = [k is None or zlib.crc32(str(k).encode()) % 5 != 1 for k, _ in rows]
    count = Counter(w for w, y in zip(tk, learn, strict=True) if y for w in w)
    n, v = sum(count.values()), len(count)
    want = Counter((k, y, len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)) for (k, _), w, y in zip(rows, tk, learn, strict=True))
    got = op10_language_model.score(docs, common.fold(F.col("doc_id")) != 1).collect()
    assert Counter((r.doc_id, r.train, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert op10_language_model.score(empty, F.lit(True)).count() == 0
    assert op10_language_model.score(docs, F.lit(False)).where("train_tokens = 0 and score < 0").count() == 16


class Interpolated:
    """The model by dictionaries: counts of words, pairs and triples, and one token's mixture."""

    def __init__(self, texts, learn):
        self.tk = [[*(t or "").lower().split(), END] for t in texts]
        self.w, self.p, self.t, self.c, self.cc = Counter(), Counter(), Counter(), Counter(), Counter()
        for w in (w for w, y in zip(self.tk, learn, strict=True) if y):
            for a, b, c in self.grams(w):
                self.w[c] += 1
                self.p[b, c] += 1
                self.t[a, b, c] += 1
                self.c[b] += 1
                self.cc[a, b] += 1
        self.n, self.v = sum(self.w.values()), len(self.w)

    @staticmethod
    def grams(w):
        padded = ["\0s", "\0s", *w]
        return list(zip(padded, padded[1:], w, strict=False))

    def mixture(self, gram, less=0):
        a, b, c = gram
        wide, narrow = self.cc[a, b] - less, self.c[b] - less
        row = op10_language_model.LEVELS + wide.bit_length() if wide > 0 else max(narrow, 0).bit_length()
        parts = [max(self.t[a, b, c] - less, 0) / max(wide, 1), max(self.p[b, c] - less, 0) / max(narrow, 1), max(self.w[c] - less, 0) / max(self.n - less, 1), 1 / (self.v + 1)]
        return row, parts


def model_rows():
    rng = random.Random(12)
    return [(i, " ".join(rng.choice(VOCAB[: 3 + i % 9]) for _ in range(rng.randint(0, 60)))) for i in range(80)] + [(900, None), (901, "A a A unseen")]


def test_scores_are_the_interpolated_probabilities(spark):
    rows = model_rows()
    learn = [zlib.crc32(str(k).encode()) % 5 != 1 for k, _ in rows]
    brute = Interpolated([t for _, t in rows], learn)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counts = op10_language_model.count(d, common.fold(F.col("doc_id")) != 1)
    weights = op10_language_model.fit(counts)
    assert (counts.n, counts.v) == (brute.n, brute.v)
    got = {r.doc_id: r.score for r in op10_language_model.score(d, common.fold(F.col("doc_id")) != 1).collect()}
    for (k, _), w in zip(rows, brute.tk, strict=True):
        mixed = [brute.mixture(g) for g in brute.grams(w)]
        assert math.isclose(got[k], sum(math.log10(float(np.dot(weights[row], parts))) for row, parts in mixed), rel_tol=1e-9)
    # Of one context the probabilities of all known words and an unknown one sum to one.
    for a, b in [("\0s", "\0s"), (VOCAB[0], VOCAB[1]), *list(brute.cc)[:40]]:
        if b != END and brute.c[b]:
            row, _ = brute.mixture((a, b, END))
            total = sum(float(np.dot(weights[row], brute.mixture((a, b, c))[1])) for c in brute.w) + weights[row][3] / (brute.v + 1)
            assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_without_trigrams_the_word_before_is_the_context(spark):
    rows = model_rows()
    learn = [zlib.crc32(str(k).encode()) % 5 != 1 for k, _ in rows]
    brute = Interpolated([t for _, t in rows], learn)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    fold = common.fold(F.col("doc_id")) != 1
    weights = op10_language_model.fit(op10_language_model.count(d, fold, order=2))
    got = {r.doc_id: r.score for r in op10_language_model.score(d, fold, order=2).collect()}
    for (k, _), w in zip(rows, brute.tk, strict=True):
        total = 0.0
        for a, b, c in brute.grams(w):
            parts = [0.0, brute.p[b, c] / max(brute.c[b], 1), brute.w[c] / brute.n, 1 / (brute.v + 1)]
            total += math.log10(float(np.dot(weights[brute.c[b].bit_length()], parts)))
        assert math.isclose(got[k], total, rel_tol=1e-9)


def test_weights_climb_the_held_out_likelihood(spark):
    """Learned weights against plain expectation-maximisation on every deleted token, without the grid."""
    rows = model_rows()
    brute = Interpolated([t for _, t in rows], [True] * len(rows))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    weights = op10_language_model.fit(op10_language_model.count(d, F.lit(True)))
    tokens = [brute.mixture(g, 1) for w in brute.tk for g in brute.grams(w)]
    likelihood = lambda w: sum(math.log(float(np.dot(w[row], parts))) for row, parts in tokens)
    own = op10_language_model.floor_uniform(op10_language_model.allowed() / op10_language_model.allowed().sum(axis=1, keepdims=True))
    start = likelihood(own)
    for _ in range(60):
        new = np.full(own.shape, 1e-9)
        for row, parts in tokens:
            share = own[row] * parts
            new[row] += share / share.sum()
        own = op10_language_model.floor_uniform(op10_language_model.allowed() * new / (op10_language_model.allowed() * new).sum(axis=1, keepdims=True))
    assert start < likelihood(weights) and likelihood(weights) > likelihood(own) - 0.01 * len(tokens)


def test_interpolation_weights_sum_to_one():
    steps = op10_language_model.GRID_STEPS
    w = op10_language_model.learn_weights([((3 * steps + 20) * steps**2 + 30 * steps + 40, 50), (40, 10)], 100)
    assert np.allclose(w.sum(axis=1), 1) and not w[0, :2].any() and not w[: op10_language_model.LEVELS, 0].any()


def test_chunks_ask_only_where_they_have_keys(spark, monkeypatch):
    """A request a chunk and bucket with keys, so that requests stay linear in the tokens."""
    monkeypatch.setattr(op10_language_model, "CHUNK_TOKENS", 3)
    d = spark.createDataFrame([(i, f"w{i}") for i in range(40)], "doc_id long, text string").coalesce(1)
    rows = d.select(F.col("doc_id").alias("k"), F.col("text").alias("t"), F.lit(True).alias("learn"))
    chunks = rows.mapInArrow(op10_language_model.to_chunks, op10_language_model.CHUNK).select("chunk", "train", "lengths", "tokens", "vocab")
    asked = chunks.mapInArrow(op10_language_model.requests(8), op10_language_model.request_schema(3)).collect()
    assert 0 < len(asked) < 20 * 20 and all(r.words or r.pairs or r.triples for r in asked)


def test_squeezed_keys_come_back():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**63, 500, dtype=np.uint64))
    at = op10_language_model.slices(keys, 3)
    for a, z in zip(at, at[1:], strict=False):
        for kept in (32, 64):
            low = (keys[a:z] << np.uint64(3)) >> np.uint64(64 - kept)
            assert (op10_language_model.stretch(op10_language_model.squeeze(keys[a:z], 3, kept), kept) == low).all()


def test_packing():
    a = np.array([0, 5, 300, 70000], np.uint64)
    assert (common.unpack(common.pack(a, 4), 4) == a).all()


# --- shared ------------------------------------------------------------------


def test_word_hashes_are_the_same_wherever_a_word_stands():
    a, s, e = common.word_hashes("x  añb\ty x".encode())
    b, _, _ = common.word_hashes("añb x".encode())
    assert a[1] == b[0] and a[0] == a[3] == b[1] and len(set(a.tolist())) == 3
    assert common.word_hashes(b" \n")[0].size == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = common.table(spark, d, "documents")
    out = corpus_pipeline.run(spark, d)
    assert out.columns[: len(docs.columns)] == docs.columns and 0 < out.count() < docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontaminate", "mixing", "sharding"]


def test_pipeline_stages_against_brute_force(spark):
    """Each stage on what the one before kept, held against a plain version of its rule."""
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    stages = dict(corpus_pipeline.STAGES)
    docs = common.table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    lex, beta = op1_toxicity.fit(op1_toxicity.labelled_train(docs, common.table(spark, d, "labels"), "toxic"))
    machine = op1_toxicity.grammar()
    mild = {r.doc_id for r in docs.collect() if beta[0] + sum(b * x for b, x in zip(beta[1:], op1_toxicity.text_features(r.text, lex, machine), strict=True)) < 0}
    one = stages["toxicity"](spark, docs, d)
    assert {r.doc_id for r in one.collect()} == mild
    two = stages["near_dedup"](spark, one, d)
    rows = [(r.doc_id, r.text) for r in one.collect()]
    assert sorted(r.doc_id for r in two.collect()) == sorted(k for k, _, c in components(rows) if k == c)
    three = stages["decontaminate"](spark, two, d)
    items = [r.text for r in common.table(spark, d, "benchmark").collect() if toks(r.text)]
    assert {r.doc_id for r in three.collect()} == {r.doc_id for r in two.collect() if not any(leaks(r.text, q) for q in items)}
    four = stages["mixing"](spark, three, d)
    rates = {r.doc_id: (r.copies, r.rate) for r in op5_mixing.mix(three, common.table(spark, d, "labels").where(common.fold(F.col("doc_id")) != 0)).select("row.doc_id", "copies", "rate").collect()}
    assert Counter(r.doc_id for r in four.collect()) == Counter({k: c for k, (c, _) in rates.items() if c}) and all(c in (math.floor(x), math.floor(x) + 1) for c, x in rates.values())
    five = stages["sharding"](spark, four, d).collect()
    assert Counter(r.doc_id for r in five) == Counter(r.doc_id for r in four.collect())
    for s in range(8):
        assert sorted(r.slot for r in five if r.shard_no == s) == list(range(sum(r.shard_no == s for r in five)))


def test_pipeline_stages_take_nothing_and_clashing_names(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    extra = ("slot", "shard_no", "shard", "row", "id", "tie", "p", "rate", "copies", "n_items", "items", "draw", "tokens", "key", "k", "t", "_uid", "_n")
    docs = common.table(spark, d, "documents").limit(30).withColumns({c: F.lit(7) for c in extra})
    odd = spark.createDataFrame([(None, None, None, None, None, *[7] * len(extra)), (900001, "", "en", "s", 0, *[7] * len(extra)), (900001, "", "en", "s", 0, *[7] * len(extra))], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), d).count() == 0
        out = stage(spark, docs.unionByName(odd), d)
        assert out.columns[: len(docs.columns)] == docs.columns and out.where("doc_id is null").count() == 1
        assert out.where("doc_id = 900001").count() in ((1,) if name == "near_dedup" else (0, 2) if name == "mixing" else (2,))
        if name == "sharding":
            assert out.columns[len(docs.columns) :] == ["_shard_no", "_slot"] and {r.slot for r in out.collect()} == {7}


def test_digest_of_kept_words(spark):
    d = spark.createDataFrame([(1, "a  b\nc")], "doc_id long, text string")
    r = op2.dedup(d, with_text=False).first()
    assert bytes(r.kept).decode() == hashlib.sha256(b"a b c").hexdigest()
