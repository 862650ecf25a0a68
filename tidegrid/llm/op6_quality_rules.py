"""Quality rules whose thresholds adapt to language and source, with DataFrame functions only.

Each rule is a ratio in thousandths.  Its distribution within a (language, source) is held in a log-linear quantile
sketch: values are kept to ``DIGITS`` binary digits and each kept value has a count.  Sketches merge by adding counts, in
whatever order with the same outcome; a quantile is at most one part in 2**(DIGITS - 1) too low; and since a value twice
as large opens only 2**(DIGITS - 1) more bins, a sketch has a bounded size though no value is clipped.  Thresholds belong
to the group that can bear them: a source with fewer than ``MIN_GROUP`` documents merges its sketch into its language's,
and a language with fewer into the whole table's; ``thresholds_of`` says which was used.  The threshold is the far
fence, q75 + 3 * (q75 - q25), moved outward by a least slack so that a distribution without spread does not reject its
own neighbours.  Documents are then joined with their thresholds.

Defined results: null and empty texts have no words and fail the base rule; a null language or source is a group of its
own; equal rows are judged alike; very long texts are measured whole; where no document of a group has enough words to
be sketched, its documents fail the base rule and ``thresholds_of`` is null; an empty table gives no rows; only the
named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let, materialise, table, words

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Groups below this many documents merge with the next wider one.
MIN_GROUP = 200
#: Rule: (numerator, denominator, least slack in thousandths, both sides?).
RULES = {
    "symbols": ("n_symbols", "n_words", 100, False),
    "word_length": ("word_chars", "n_words", 1500, True),
    "dup_lines": ("n_dup_lines", "n_lines", 500, False),
    "repeats": ("n_repeat_words", "n_words", 400, False),
}
#: Leading binary digits of a value that a sketch keeps.
DIGITS = 10


def _repeat_words(h: Column) -> Column:
    """Words that lie in three-word windows found twice or more; ``h``: hashes of the words in order."""
    windows = F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.struct(F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)).alias("t"), i.alias("i")))

    def places(s: Column) -> Column:
        """Starts of the windows that have an equal neighbour in sorted order."""
        return F.filter(s, lambda x, k: (F.get(s, k - 1)["t"] == x["t"]) | (F.get(s, k + 1)["t"] == x["t"]))

    def covered(p: Column) -> Column:
        """Each start covers three words or as many as there are to the next start."""
        return F.size(p) * 3 - F.aggregate(F.sequence(F.lit(1), F.size(p) - 1), F.lit(0), lambda a, k: a + F.greatest(F.lit(0), F.get(p, k - 1) + 3 - F.get(p, k)))

    def count(p: Column) -> Column:
        return F.when(F.size(p) > 1, covered(p)).otherwise(F.size(p) * 3)

    found = let(F.sort_array(windows), lambda s: F.sort_array(F.transform(places(s), lambda x: x["i"])))
    return F.when(F.size(h) >= 4, let(found, count)).otherwise(0).cast("long")


def base_columns(text: Column) -> dict[str, Column]:
    """Counts of one text; ``w`` and ``ls`` are bound once a row."""
    t = F.coalesce(text, F.lit(""))
    bare = t
    for c in SYMBOLS:
        bare = F.replace(bare, F.lit(c), F.lit(""))

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            _bound_repeats(w).alias("n_repeat_words"),
        )

    def _bound_repeats(w: Column) -> Column:
        return let(F.transform(w, lambda x: F.xxhash64(x)), _repeat_words)

    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    return {
        "_w": let(words(t), of),
        "_l": let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))),
        "n_symbols": (F.octet_length(t) - F.octet_length(bare)).cast("long"),
    }


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Per row: key, language, source and the counts."""
    out = docs.select(F.col(key).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), *[c.alias(n) for n, c in base_columns(F.col(text)).items()])
    return out.select("doc_id", "lang", "source", "_w.n_words", "_w.word_chars", "n_symbols", "_l.n_lines", "_l.n_dup_lines", "_w.n_repeat_words")


def _ratio(rule: str) -> Column:
    top, bottom, _, _ = RULES[rule]
    return F.floor(1000 * F.col(top) / F.greatest(F.col(bottom), F.lit(1))).cast("long")


def _bin(value: Column) -> Column:
    """``value`` with only its ``DIGITS`` leading binary digits."""
    drop = F.greatest(F.length(F.bin(value)) - DIGITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def thresholds(measured: DataFrame) -> DataFrame:
    """Per (lang, source, rule): the bounds in thousandths and whose they are, from sketches that merge by adding."""
    usable = measured.where(F.col("n_words") >= MIN_WORDS)
    values = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _bin(_ratio(r)).alias("value")) for r in RULES])).alias("x")
    own = usable.select("lang", "source", values).select("lang", "source", "x.*").groupBy("lang", "source", "rule", "value").agg(F.count("*").alias("n"))
    own = materialise(own, "op6-sketches")
    by_lang = own.groupBy("lang", "rule", "value").agg(F.sum("n").alias("n"))
    whole = by_lang.groupBy("rule", "value").agg(F.sum("n").alias("n"))

    def fences(sketch: DataFrame, by: list[str], tag: str) -> DataFrame:
        up = sketch.select(*by, "rule", "value", "n", F.sum("n").over(W.partitionBy(*by, "rule").orderBy("value")).alias("upto"), F.sum("n").over(W.partitionBy(*by, "rule")).alias("all"))
        q = [F.min(F.when(F.col("upto") * 4 >= F.col("all") * k, F.col("value"))).alias(f"{tag}_q{k}") for k in (1, 3)]
        return up.groupBy(*by, "rule").agg(*q, F.max("all").alias(f"{tag}_n"))

    out = fences(own, ["lang", "source"], "own").alias("o").join(fences(by_lang, ["lang"], "lang").alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.rule") == F.col("l.rule")))
    out = out.select("o.*", "lang_q1", "lang_q3", "lang_n").join(fences(whole, [], "all"), "rule")
    pick = lambda own, lang, whole: F.when(F.col("own_n") >= MIN_GROUP, own).when(F.col("lang_n") >= MIN_GROUP, lang).otherwise(whole)
    q1, q3 = (pick(F.col(f"own_q{k}"), F.col(f"lang_q{k}"), F.col(f"all_q{k}")) for k in (1, 3))
    slack = F.create_map(*[F.lit(v) for r, x in RULES.items() for v in (r, x[2])])[F.col("rule")]
    reach = F.greatest(3 * (q3 - q1), slack)
    return out.select("lang", "source", "rule", (q1 - reach).alias("low"), (q3 + reach).alias("high"), pick(F.lit("source"), F.lit("language"), F.lit("all")).alias("whose"))


def judge(measured: DataFrame) -> DataFrame:
    """``measured`` with ``base_failed``, ``kept`` (every ratio within its group's bounds) and ``thresholds_of``."""
    bounds = thresholds(measured).groupBy("lang", "source").pivot("rule", list(RULES)).agg(F.first("low").alias("low"), F.first("high").alias("high"), F.first("whose").alias("whose"))
    inside = F.lit(True)
    for r, (_, _, _, both) in RULES.items():
        inside = inside & F.coalesce(_ratio(r) <= F.col(f"{r}_high"), F.lit(True))
        if both:
            inside = inside & F.coalesce(_ratio(r) >= F.col(f"{r}_low"), F.lit(True))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    b = bounds.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = measured.join(b, measured["lang"].eqNullSafe(b["_lang"]) & measured["source"].eqNullSafe(b["_source"]), "left")
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & inside).withColumn("thresholds_of", F.col(f"{next(iter(RULES))}_whose")).select(*measured.columns, "base_failed", "kept", "thresholds_of")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, whether the base rule fails it and whether it is kept."""
    measured = materialise(measure(table(spark, sf_dir, "documents")), "op6-counts")
    return judge(measured).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "thresholds_of")


def oracle_sql() -> str:
    ratio = {r: f"1000 * {top} // greatest({bottom}, 1)" for r, (top, bottom, _, _) in RULES.items()}
    digits = f"((({{x}}) >> greatest(length(bin({{x}})) - {DIGITS}, 0)) << greatest(length(bin({{x}})) - {DIGITS}, 0))"
    values = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rule, {digits.format(x=x)} AS value FROM counts WHERE n_words >= {MIN_WORDS}" for r, x in ratio.items())
    pick = lambda k: f"CASE WHEN o.n >= {MIN_GROUP} THEN o.q{k} WHEN l.n >= {MIN_GROUP} THEN l.q{k} ELSE a.q{k} END"
    slack = "CASE o.rule " + " ".join(f"WHEN '{r}' THEN {x[2]}" for r, x in RULES.items()) + " END"
    quartiles = "quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3, count(*) AS n"
    inside = " AND ".join(f"coalesce((SELECT {x} <= high {f'AND {x} >= low' if RULES[r][3] else ''} FROM bounds b WHERE b.rule = '{r}' AND b.lang IS NOT DISTINCT FROM c.lang AND b.source IS NOT DISTINCT FROM c.source), true)" for r, x in ratio.items())
    return f"""
WITH toks AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents),
wins AS (
  SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM toks)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM wins) WHERE n > 1),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
counts AS (
  SELECT t.doc_id, lang, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(h.n, 0)::BIGINT AS n_repeat_words
  FROM toks t LEFT JOIN hit h USING (doc_id)),
vals AS ({values}),
o AS (SELECT lang, source, rule, {quartiles} FROM vals GROUP BY ALL),
l AS (SELECT lang, rule, {quartiles} FROM vals GROUP BY ALL),
a AS (SELECT rule, {quartiles} FROM vals GROUP BY ALL),
picked AS (
  SELECT o.lang, o.source, o.rule, CASE WHEN o.n >= {MIN_GROUP} THEN 'source' WHEN l.n >= {MIN_GROUP} THEN 'language' ELSE 'all' END AS whose, {pick(1)} AS q1, {pick(3)} AS q3, {slack} AS slack
  FROM o JOIN l ON o.lang IS NOT DISTINCT FROM l.lang AND o.rule = l.rule JOIN a ON a.rule = o.rule),
bounds AS (SELECT lang, source, rule, whose, q1 - greatest(3 * (q3 - q1), slack) AS low, q3 + greatest(3 * (q3 - q1), slack) AS high FROM picked),
flags AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND {inside}) AS kept,
  (SELECT any_value(whose) FROM bounds b WHERE b.lang IS NOT DISTINCT FROM c.lang AND b.source IS NOT DISTINCT FROM c.source) AS thresholds_of
FROM flags c"""
