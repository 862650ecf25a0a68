"""Mixing to target weights by soft membership, with DataFrame functions only.

1. A Gaussian classifier learned from the labelled table (one aggregate of moments over all labelled rows) gives every
   document posteriors over domains; a domain is a value of the labelled table's ``label_columns``.  The query's domains
   are the values of ``quality`` and its target weights are ``TARGETS``.
2. Nonnegative rates r_d are fitted by projected-gradient least squares: minimise the sum over domains of
   (E_k - T_k)^2 / (2 T_k), where E_k = sum over d of r_d * n_d * p_dk are the expected tokens and T_k the target total, by
   accelerated steps after each of which every rate is held in [0, ``max_rate``].  Posteriors are kept to three decimals, so documents with equal posteriors are
   added up once and the steps run over that table, however many documents there are; a document's rate is a function of
   its posteriors and of the sums of all steps.
3. A document is taken floor(rate) times and once more if a seeded hash of its key and text is below the rest.

With bounded rates the target weights fix the total: the largest of which no domain's own tokens fall short.  Where the
bound on rates keeps the steps from reaching it, because memberships overlap, the total is lowered to what the shortest
domain has reached, as long as that brings the weights nearer; the weights asked for never change.  Where no rates have
those weights, the result is the least squares, and in every case it states the largest relative miss of a target.

Defined results: null and empty texts count one token; very long texts count whole; a null key hashes as "null"; of
conflicting labels of one key the least counts; labels with a null key or null labels are not learned from; equal rows
fare alike; without labelled rows, or with one domain only, every document is kept; an empty table gives no rows; the
document's own columns travel inside ``row``, so no name of theirs can clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, let, materialise, table, words

#: Target weights of the query's domains: nine tokens of good text to one of the rest.
TARGETS = {"1": 9.0, "0": 1.0}
#: Steps at most; the relative miss of a target that ends them, and the relative change of all totals that does.
ITERATIONS, TOLERANCE, STILL = 200, 1e-3, 1e-4


def features(text: Column) -> dict[str, Column]:
    """Shape statistics of a text, on a scale near one."""
    t = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(t), F.lit(1))
    marks = lambda cs: sum((F.octet_length(t) - F.octet_length(F.replace(t, F.lit(c), F.lit("")))) for c in cs)
    lines = F.split(t, "\n")
    n_words = F.greatest(F.size(words(t)), F.lit(1))
    return {
        "f_symbols": F.log1p(100.0 * marks("#*$%&") / chars),
        "f_bars": F.log1p(100.0 * marks("|<>") / chars),
        "f_calls": F.log1p(100.0 * marks("!?") / chars),
        "f_stops": F.log1p(100.0 * marks(".,") / chars),
        "f_digits": F.log1p(100.0 * marks("0123456789") / chars),
        "f_length": F.log(chars.cast("double")),
        "f_word": F.log(chars / n_words),
        "f_lines": let(lines, lambda x: F.size(F.array_distinct(x)) / F.size(x)),
    }


def classify(docs: DataFrame, labels: DataFrame, key: str, text: str, label_columns: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """(row: all columns as a struct, draw: a hash of key and text, tokens, p: posteriors in the order of the domains' names)."""
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    made = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("key"), F.xxhash64(name, F.col(text)).alias("draw"), F.greatest(F.size(words(F.col(text))), F.lit(1)).cast("double").alias("tokens"), *[c.alias(n) for n, c in features(F.col(text)).items()])
    made = materialise(made, "op5-features")
    names = [c for c in made.columns if c.startswith("f_")]
    domain = F.concat_ws("/", *[F.col(c).cast("string") for c in label_columns])
    whole = labels.where(F.col(key).isNotNull())
    for c in label_columns:
        whole = whole.where(F.col(c).isNotNull())
    known = whole.select(F.col(key).alias("key"), domain.alias("domain")).groupBy("key").agg(F.min("domain").alias("domain"))
    moments = made.join(known, "key").groupBy("domain").agg(F.count("*").alias("n"), *[f(c).alias(f"{c}_{f.__name__}") for c in names for f in (F.avg, F.var_pop)]).where(F.col("n") >= 5).orderBy("domain").collect()
    if len(moments) < 2:
        return made.select("row", "draw", "tokens", F.array(F.lit(1.0)).alias("p")), [m["domain"] for m in moments] or ["all"]
    total = sum(m["n"] for m in moments)
    logs = []
    for m in moments:
        score = F.lit(math.log(m["n"] / total))
        for c in names:
            var = m[f"{c}_var_pop"] + 0.02
            score = score - (F.col(c) - m[f"{c}_avg"]) ** 2 / (2 * var) - 0.5 * math.log(var)
        logs.append(score)
    soft = let(F.array(*logs), lambda s: let(F.array_max(s), lambda top: F.transform(s, lambda x: F.exp(F.greatest(x - top, F.lit(-50.0))))))
    share = let(soft, lambda e: let(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda z: F.transform(e, lambda x: F.round(x / z, 3))))
    return made.select("row", "draw", "tokens", share.alias("p")), [m["domain"] for m in moments]


def fit_rates(members: DataFrame, domains: list[str], targets: dict[str, float], max_rate: float, iterations: int = ITERATIONS) -> tuple[Column, dict]:
    """The rate as a column over ``p``, and a report of targets, expected totals and the largest relative miss."""
    ks = range(len(domains))
    cells = materialise(members.groupBy("p").agg(F.sum("tokens").alias("tokens")), "op5-cells")
    sums = lambda rate: [x or 0.0 for x in cells.agg(*[F.sum(rate * F.col("tokens") * F.get("p", F.lit(k))) for k in ks]).first()]
    have = sums(F.lit(1.0))
    wish = [max(0.0, targets.get(d, 0.0)) for d in domains]
    if len(domains) < 2 or min(have) <= 0 or sum(wish) == 0:
        return F.lit(1.0), {"domains": domains, "targets": have, "totals": have, "miss": 0.0, "iterations": 0}
    wish = [w / sum(wish) for w in wish]
    budget = min(max_rate * h / w for h, w in zip(have, wish, strict=True) if w > 0)
    # A domain that nothing is wanted of weighs as if a millionth of all tokens were.
    goals = lambda total: [max(w * total, 1e-6 * sum(have)) for w in wish]
    goal = goals(budget)
    # Start at the rate that would fit if memberships were hard.
    first = F.least(F.lit(float(max_rate)), sum(F.get("p", F.lit(k)) * (wish[k] * budget / have[k]) for k in ks))
    state = _replay(first, [], max_rate)
    total = ahead = sums(first)
    pushes, still, since, best = [], 0, 0, None
    while True:
        miss = max(abs(t - g) / g for t, g in zip(total, goal, strict=True))
        if miss < TOLERANCE or still >= 3 or len(pushes) >= iterations:
            if best is None or miss < 0.98 * best[1]["miss"]:
                best = state["rate"], {"domains": domains, "targets": goal, "totals": total, "miss": miss, "iterations": len(pushes)}
            elif miss >= TOLERANCE:
                return best
            if miss < TOLERANCE or len(pushes) >= iterations:
                return best
            budget *= min(0.99, max(0.5, min(t / g for t, g in zip(total, goal, strict=True))))
            goal, still, since = goals(budget), 0, len(pushes)
        # The derivative by r_d is n_d * sum over k of p_dk * (E_k / T_k - 1); in the metric of the n_d no curvature
        # exceeds the greatest of have / target, whose reciprocal is the step.
        step = 1.0 / max(h / g for h, g in zip(have, goal, strict=True))
        pushes.append(([step * (t / g - 1) for t, g in zip(ahead, goal, strict=True)], (len(pushes) - since) / (len(pushes) - since + 3)))
        state = _replay(first, pushes, max_rate)
        got = cells.select("tokens", "p", state.alias("s")).agg(*[F.sum(F.col(f"s.{at}") * F.col("tokens") * F.get("p", F.lit(k))) for at in ("rate", "ahead") for k in ks]).first()
        moved = max(abs(x - t) / g for x, t, g in zip(got, total, goal, strict=False))
        still = still + 1 if moved < STILL else 0
        total, ahead = list(got[: len(domains)]), list(got[len(domains) :])


def _replay(first: Column, pushes: list[tuple[list[float], float]], max_rate: float) -> Column:
    """All accelerated projected steps so far as (rate, ahead), folded over a literal array: the expression stays small."""
    start = F.struct(first.alias("rate"), first.alias("ahead"))
    if not pushes:
        return start
    number = lambda x: f"CAST('{float(x)!r}' AS DOUBLE)"
    steps = F.expr(f"array({', '.join(f'named_struct("push", array({", ".join(map(number, push))}), "beta", {number(beta)})' for push, beta in pushes)})")
    p = F.col("p")

    def move(s: Column, g: Column) -> Column:
        slope = F.aggregate(F.zip_with(p, g["push"], lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
        new = F.greatest(F.lit(0.0), F.least(F.lit(float(max_rate)), s["ahead"] - slope))
        return let(new, lambda x: F.struct(x.alias("rate"), (x + g["beta"] * (x - s["rate"])).alias("ahead")))

    return F.aggregate(steps, start, move)


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, key: str = "doc_id", text: str = "text", label_columns: tuple[str, ...] = ("quality",), max_rate: float = 1.0, seed: int = 23) -> DataFrame:
    """Per row of ``docs``: ``row`` (the whole row as a struct), tokens, p, rate, copies (how often it is taken) and target_miss."""
    members, domains = classify(docs, labels, key, text, label_columns)
    rate, report = fit_rates(members, domains, targets or TARGETS, max_rate)
    # The rate is fitted once for each value of p and looked up, so that the steps are not replayed for every document.
    rated = materialise(members.select("p").distinct().withColumn("rate", F.round(rate, 6)), "op5-rates")
    out = members.join(rated, "p")
    part = F.pmod(F.xxhash64(F.lit(seed), "draw"), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor("rate") + F.when(part < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return out.select("row", F.col("tokens").cast("long").alias("tokens"), "p", "rate", copies.cast("int").alias("copies"), F.lit(float(report["miss"])).alias("target_miss"))


def mixed(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs``, each row as often as its copies say."""
    taken = mix(docs, labels, key=key, text=text, **options).where("copies > 0")
    return taken.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: tokens, its likeliest domain's posterior, its rate and how often it is taken."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id")) != 0)
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return out.select("row.doc_id", "tokens", F.round(F.array_max("p"), 3).alias("membership"), "rate", "copies", F.round("target_miss", 6).alias("target_miss"))
