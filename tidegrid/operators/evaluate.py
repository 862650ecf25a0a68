"""Agreement, confusion, field votes, cross-validation folds, bootstrap and small models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import seeded_share
from .vectors import require_few


def confusion(df: DataFrame, predicted: Column, actual: Column, groups: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(groups or [])).agg(*[F.count(F.when(cond, 1)).alias(n) for n, cond in (("tp", predicted & actual), ("fp", predicted & ~actual), ("fn", ~predicted & actual), ("tn", ~predicted & ~actual))])


def metrics(df: DataFrame) -> DataFrame:
    """Precision, recall, F1, accuracy and Cohen's kappa of tp, fp, fn, tn; undefined ones are NULL."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    seen = F.try_divide(tp + tn, n)
    chance = F.try_divide((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    return df.withColumns({"precision": F.try_divide(tp, tp + fp), "recall": F.try_divide(tp, tp + fn), "f1": F.try_divide(2 * tp, 2 * tp + fp + fn), "accuracy": seen, "kappa": F.try_divide(seen - chance, 1 - chance)})


def class_report(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Precision, recall and F1 of every class, from one count of (predicted, actual) pairs."""
    pairs = df.groupBy(F.col(predicted).alias("p"), F.col(actual).alias("a")).agg(F.count("*").alias("n"))
    sides = pairs.select(F.explode(F.array(F.struct(F.col("p").alias("class"), F.col("n").alias("called"), F.lit(0).cast("long").alias("real"), F.when(F.col("p") == F.col("a"), F.col("n")).otherwise(0).alias("hit")), F.struct(F.col("a").alias("class"), F.lit(0).cast("long").alias("called"), F.col("n").alias("real"), F.lit(0).cast("long").alias("hit")))).alias("s")).select("s.*")
    out = sides.groupBy("class").agg(F.sum("called").alias("called"), F.sum("real").alias("real"), F.sum("hit").alias("hit"))
    return out.withColumns({"precision": F.try_divide("hit", "called"), "recall": F.try_divide("hit", "real"), "f1": F.try_divide(2 * F.col("hit"), F.col("called") + F.col("real"))})


def fold_of(group: Column, folds: int, seed: int = 0) -> Column:
    """Whole groups in folds, by a seeded hash."""
    return F.pmod(F.xxhash64(F.lit(seed), group), F.lit(folds)).cast("int")


def bootstrap_mean(df: DataFrame, unit: str, value: str, replicas: int, seed: int) -> DataFrame:
    """Mean of ``value`` and a 95 % interval by a Poisson bootstrap over whole units.

    A unit's weight in a replica follows from a seeded hash, so a task that runs again draws the same; units are
    summed first, and only (unit, replica) sums are spread.
    """
    units = df.groupBy(unit).agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    draws = units.select("s", "n", F.col(unit), F.explode(F.sequence(F.lit(1), F.lit(replicas))).alias("replica"))
    u = seeded_share(seed, F.col(unit), F.col("replica"))
    # Poisson(1) by its cumulative probabilities, fixed values.
    cuts = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.9999167588507119]
    weight = sum((u >= c).cast("int") for c in cuts)
    means = draws.withColumn("w", weight).groupBy("replica").agg(F.try_divide(F.sum(F.col("w") * F.col("s")), F.sum(F.col("w") * F.col("n"))).alias("m"))
    whole = units.agg((F.sum("s") / F.sum("n")).alias("mean"))
    return whole.crossJoin(means.agg(F.percentile("m", F.lit(0.025)).alias("low"), F.percentile("m", F.lit(0.975)).alias("high")))


def leave_group_out(df: DataFrame, group: str, value: str, positive: Column, low: float = 0.1) -> DataFrame:
    """A threshold from all groups but one (a percentile of its positives), tested on the one left out.

    Groups are few (regions), which is checked; each row joins the thresholds of its own group only.
    """
    groups = require_few(df.select(F.col(group).alias("left_out")).distinct(), "groups")
    cuts = df.where(positive).join(F.broadcast(groups), F.col(group) != F.col("left_out")).groupBy("left_out").agg(F.percentile(value, F.lit(low)).alias("cut"))
    tested = df.join(cuts, F.col(group) == F.col("left_out"))
    return tested.groupBy("left_out", "cut").agg(F.avg(F.when(positive, (F.col(value) >= F.col("cut")).cast("int"))).alias("recall"), F.avg(F.when(~positive, (F.col(value) >= F.col("cut")).cast("int"))).alias("false_share"))


def poisson_folds_model(df: DataFrame, features: list[str], label: str, group: str, folds: int = 3, trees: int = 10, seed: int = 0) -> DataFrame:
    """Out-of-fold class of a random forest whose folds keep groups whole: (columns of df, prediction)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    made = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="skip").transform(df.withColumn("_fold", fold_of(F.col(group), folds, seed)))
    out = None
    for k in range(folds):
        model = RandomForestClassifier(featuresCol="_x", labelCol=label, numTrees=trees, seed=seed).fit(made.where(F.col("_fold") != k))
        own = model.transform(made.where(F.col("_fold") == k)).select(*df.columns, F.col("_fold").alias("fold"), "prediction")
        out = own if out is None else out.unionByName(own)
    return out


def cluster(df: DataFrame, vector: str, k: int, seed: int = 0) -> DataFrame:
    """K-means; clusters are numbered by size, the largest first."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import Window as W

    made = df.withColumn("_x", array_to_vector(F.col(vector).cast("array<double>")))
    got = KMeans(k=k, seed=seed, featuresCol="_x", predictionCol="_c").fit(made).transform(made).drop("_x")
    order = got.groupBy("_c").agg(F.count("*").alias("_n")).withColumn("cluster", F.row_number().over(W.orderBy(F.desc("_n"), "_c")) - 1)
    return got.join(F.broadcast(order.select("_c", "cluster")), "_c").drop("_c")


def first_able(df: DataFrame, models: list[tuple[str, list[str], Column]]) -> Column:
    """Name and prediction of the first model whose inputs are all known: models are (name, inputs, prediction)."""
    from ..functions.columns import finite

    out = None
    for name, inputs, value in models:
        able, got = finite(*[F.col(c).cast("double") for c in inputs]), F.struct(F.lit(name).alias("model"), value.cast("double").alias("prediction"))
        out = F.when(able, got) if out is None else out.when(able, got)
    return out.otherwise(F.struct(F.lit(None).cast("string").alias("model"), F.lit(None).cast("double").alias("prediction")))


def consensus(df: DataFrame, cluster_column: str, distance: str, maps: list[str], names: dict[int, str], q: float = 0.75) -> DataFrame:
    """A label only where the cluster's name and all maps agree and the row lies within its cluster's quantile of distances."""
    edges = df.groupBy(cluster_column).agg(F.percentile(distance, F.lit(q)).alias("_q"))
    name = F.coalesce(*[F.when(F.col(cluster_column) == c, n) for c, n in names.items()])
    x = df.join(edges, cluster_column).withColumn("_name", name)
    agree = F.col(distance) <= F.col("_q")
    for m in maps:
        agree = agree & (F.col(m) == F.col("_name"))
    return x.withColumn("label", F.when(F.coalesce(agree, F.lit(False)), F.col("_name"))).drop("_q", "_name")


def balanced_sample(df: DataFrame, label: str, group: str, key: str, per_class: int, per_group: int, seed: int) -> DataFrame:
    """At most ``per_group`` rows of a group in a class and ``per_class`` of a class, by a seeded hash of the key."""
    from .aggregate import seeded_cap

    return seeded_cap(seeded_cap(df, [label, group], key, per_group, seed), [label], key, per_class, seed + 1)


def settled_verdicts(reviews: DataFrame, checks: DataFrame, key: str, label: str, order: str) -> DataFrame:
    """A reviewer's verdict unless a user's check says otherwise: the last check wins, an empty one drops the row, and rows
    that only users know are added."""
    last = checks.groupBy(key).agg(F.max_by(F.coalesce(F.col(label), F.lit("")), F.col(order)).alias("_c"))
    both = reviews.select(key, F.col(label).alias("_r")).join(last, key, "full_outer")
    out = both.select(key, F.coalesce("_c", "_r").alias(label))
    return out.where(F.col(label).isNotNull() & (F.col(label) != ""))


def rater_agreement(a: DataFrame, b: DataFrame, key: str, label: str, merged: dict[str, str]) -> DataFrame:
    """Share of rows on which two raters agree, as named and with some names taken together."""
    joint = lambda c: F.coalesce(*[F.when(c == old, F.lit(new)) for old, new in merged.items()], c)
    x = a.select(key, F.col(label).alias("_a")).join(b.select(key, F.col(label).alias("_b")), key)
    return x.agg(F.count("*").alias("n"), F.avg((F.col("_a") == F.col("_b")).cast("int")).alias("exact"), F.avg((joint(F.col("_a")) == joint(F.col("_b"))).cast("int")).alias("merged"))


def review_sample(df: DataFrame, key: str, size: str, differ: Column, n: int, seed: int) -> DataFrame:
    """n rows to look at: the largest ones on which rule sets differ, up to half, and a seeded draw of the rest."""
    from pyspark.sql import Window as W

    x = df.withColumn("_d", F.coalesce(differ, F.lit(False)))
    by_size = F.row_number().over(W.partitionBy("_d").orderBy(F.desc(size), key))
    # The two windows hold one area's fields.
    first = x.withColumn("_r", by_size).withColumn("picked", F.col("_d") & (F.col("_r") <= n // 2))
    have = first.where("picked").count()
    draw = first.where(~F.col("picked")).orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n - have)
    return first.where("picked").unionByName(draw).select(*df.columns, F.when(F.col("picked"), "differ").otherwise("drawn").alias("why"))


def best_variant(scores: DataFrame, group: list[str], variant: str, value: str, half: Column, held: Column) -> DataFrame:
    """The variant best on one half, kept only if it beats the first variant on the held-out half as well."""
    per = scores.groupBy(*group, variant).agg(F.avg(F.when(half, F.col(value))).alias("_a"), F.avg(F.when(held, F.col(value))).alias("_b"))
    top = per.groupBy(*group).agg(F.max_by(F.struct(variant, "_b"), F.struct(F.round("_a", 9), -F.xxhash64(variant))).alias("t"), F.min_by("_b", variant).alias("base"), F.min(variant).alias("first"))
    return top.select(*group, F.when(F.col("t._b") > F.col("base"), F.col(f"t.{variant}")).otherwise(F.col("first")).alias(variant), F.col("base"), F.col("t._b").alias("held"))


def random_dates(keys: DataFrame, key: str, n: int, lo: int, hi: int, seed: int) -> DataFrame:
    """(key, draw, day): seeded random days, for what a statistic is where nothing happened."""
    x = keys.select(key, F.explode(F.sequence(F.lit(1), F.lit(n))).alias("draw"))
    return x.withColumn("day", (F.floor(seeded_share(seed, F.col(key), F.col("draw")) * (hi - lo + 1)) + lo).cast("int"))


def small_tree(df: DataFrame, features: list[str], label: str, depth: int = 3):
    """A decision tree over features whose unknown values take the training median; a pipeline model."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import Imputer, VectorAssembler

    filled = [f"_{c}" for c in features]
    steps = [Imputer(inputCols=features, outputCols=filled, strategy="median"), VectorAssembler(inputCols=filled, outputCol="_x"), DecisionTreeClassifier(featuresCol="_x", labelCol=label, maxDepth=depth, seed=0)]
    return Pipeline(stages=steps).fit(df)


def left_out_accuracy(df: DataFrame, features: list[str], label: str, group: str, groups: list) -> DataFrame:
    """Accuracy of a small tree on each of a few named groups that it was not trained on."""
    out = None
    for g in groups:
        got = small_tree(df.where(F.col(group) != g), features, label).transform(df.where(F.col(group) == g))
        own = got.agg(F.lit(g).alias(group), F.avg((F.col("prediction") == F.col(label)).cast("int")).alias("accuracy"), F.count("*").alias("n"))
        out = own if out is None else out.unionByName(own)
    return out


def cluster_scores(df: DataFrame, vector: str, ks: list[int], seed: int = 0) -> DataFrame:
    """(k, cost, silhouette) of k-means for a few k."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    made = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    rows = []
    for k in ks:
        model = KMeans(k=k, seed=seed).fit(made)
        rows.append((k, float(model.summary.trainingCost), float(ClusteringEvaluator().evaluate(model.transform(made)))))
    return df.sparkSession.createDataFrame(rows, "k int, cost double, silhouette double")


def tune_forest(df: DataFrame, features: list[str], label: str, group: str, grid: list[dict], folds: int, seed: int, done: DataFrame | None = None) -> DataFrame:
    """Grouped cross-validation of forests: one row a setting, named by its digest; settings among ``done`` are not run again."""
    import hashlib
    import json

    known = {r["spec"] for r in done.select("spec").collect()} if done is not None else set()
    rows = []
    for spec in grid:
        name = hashlib.sha256(json.dumps(spec, sort_keys=True).encode()).hexdigest()[:12]
        if name in known:
            continue
        got = poisson_folds_model(df, features, label, group, folds, spec["trees"], seed)
        accuracy = got.agg(F.avg((F.col("prediction") == F.col(label)).cast("int"))).first()[0]
        rows.append((name, json.dumps(spec, sort_keys=True), accuracy))
    out = df.sparkSession.createDataFrame(rows, "spec string, setting string, accuracy double")
    return out if done is None else done.unionByName(out)
