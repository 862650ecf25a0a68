"""Queries over keys, classes, labels and logs: joins, aggregates, distribution statistics, evaluation, lifecycle."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import aggregate, evaluate, lifecycle, robust, rules
from ..sources.tables import observations, table
from .registry import registry

QUERIES, ORACLE_SQL, query = registry()
TRACKS = ["click", "error", "purchase", "signup", "view"]


def r(col, n=4):
    return F.round(col, n)


@query("""WITH e AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer),
b0 AS (SELECT least(floor((c_acctbal - lo) / (hi - lo) * 64), 63)::INT AS bin, count(*) AS n FROM customer, e GROUP BY 1), b AS (SELECT x.bin, coalesce(n, 0) AS n, lo, hi FROM (SELECT unnest(range(0, 64)) AS bin) x LEFT JOIN b0 USING (bin), e),
c AS (SELECT *, lo + (bin + 0.5) * (hi - lo) / 64 AS centre FROM b),
d AS (SELECT *, sum(n) OVER (ORDER BY bin) AS w0, sum(n * centre) OVER (ORDER BY bin) AS s0, sum(n) OVER () AS w, sum(n * centre) OVER () AS s FROM c),
f AS (SELECT *, w0 * (w - w0) * power(s0 / w0 - (s - s0) / nullif(w - w0, 0), 2) AS between_ FROM d WHERE w > w0 AND bin < 63)
SELECT round(avg(centre), 4) AS threshold FROM f WHERE between_ >= (SELECT max(between_) FROM f) * (1 - 1e-9)""")
def otsu_split(spark, d):
    return robust.otsu(table(spark, d, "customer"), "c_acctbal", 64).select(r("threshold").alias("threshold"))


AUC = """x AS (SELECT n_chars AS v, quality FROM documents JOIN labels USING (doc_id)),
t AS (SELECT v, count(*) AS n, count(*) FILTER (quality = 1) AS p FROM x GROUP BY v), u AS (SELECT *, coalesce(sum(n) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (n + 1) / 2 AS rk FROM t)"""


@query(f"WITH {AUC} SELECT round((sum(p * rk) - sum(p) * (sum(p) + 1) / 2) / (sum(p) * (sum(n) - sum(p))), 6) AS auc, sum(p)::BIGINT AS positives, (sum(n) - sum(p))::BIGINT AS negatives FROM u")
def auc_quality(spark, d):
    """Rank AUC of text length for quality, ties at their average rank."""
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    return robust.auc(x, [], "n_chars", F.col("quality") == 1).withColumn("auc", r("auc", 6))


@query("""WITH f AS (SELECT quality, n_chars::DOUBLE AS n_chars, (doc_id % 97)::DOUBLE AS id_mod, length(source)::DOUBLE AS source_len FROM documents JOIN labels USING (doc_id)),
x AS (SELECT quality, 'n_chars' AS feature, n_chars AS v FROM f UNION ALL SELECT quality, 'id_mod', id_mod FROM f UNION ALL SELECT quality, 'source_len', source_len FROM f),
t AS (SELECT feature, v, count(*) AS n, count(*) FILTER (quality = 1) AS p FROM x GROUP BY ALL), u AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (n + 1) / 2 AS rk FROM t),
a AS (SELECT feature, (sum(p * rk) - sum(p) * (sum(p) + 1) / 2) / (sum(p) * (sum(n) - sum(p))) AS auc FROM u GROUP BY feature)
SELECT feature, round(auc, 6) AS auc, round(abs(auc - 0.5) * 2, 6) AS strength FROM a""")
def rank_features_auc(spark, d):
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").withColumns({"id_mod": F.col("doc_id") % 97, "source_len": F.length("source")})
    return robust.rank_features(x, ["n_chars", "id_mod", "source_len"], F.col("quality") == 1).select("feature", r("auc", 6).alias("auc"), r("strength", 6).alias("strength"))


@query("""{obs}, b AS (SELECT k, day // 2 AS bin, avg(v) FILTER (track = 'view') AS x, avg(v) FILTER (track = 'click') AS y FROM obs GROUP BY ALL), j AS (SELECT * FROM b WHERE x IS NOT NULL AND y IS NOT NULL),
q AS (SELECT k, rank() OVER (PARTITION BY k ORDER BY x) + (count(*) OVER (PARTITION BY k, x) - 1) / 2 AS ra, rank() OVER (PARTITION BY k ORDER BY y) + (count(*) OVER (PARTITION BY k, y) - 1) / 2 AS rb FROM j)
SELECT k, round(CASE WHEN count(*) >= 5 AND var_pop(ra) > 0 AND var_pop(rb) > 0 THEN corr(ra, rb) END, 4) AS rho, count(*) AS n FROM q GROUP BY k""")
def spearman(spark, d):
    b = observations(spark, d).groupBy("k", F.floor(F.col("day") / 2).alias("bin")).agg(F.avg(F.when(F.col("track") == "view", F.col("v"))).alias("x"), F.avg(F.when(F.col("track") == "click", F.col("v"))).alias("y"))
    return robust.rank_correlation(b, ["k"], "x", "y").withColumn("rho", r("rho"))


CONF = "x AS (SELECT n_chars >= 800 AS p, quality = 1 AS a FROM documents JOIN labels USING (doc_id)), c AS (SELECT count(*) FILTER (p AND a) AS tp, count(*) FILTER (p AND NOT a) AS fp, count(*) FILTER (NOT p AND a) AS fn, count(*) FILTER (NOT p AND NOT a) AS tn FROM x)"


@query(f"WITH {CONF} SELECT * FROM c")
def confusion_matrix(spark, d):
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    return evaluate.confusion(x, F.col("n_chars") >= 800, F.col("quality") == 1)


@query(f"""WITH {CONF}, k AS (SELECT *, tp + fp + fn + tn AS n FROM c), s AS (SELECT *, (tp + tn) / n AS seen, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n::DOUBLE * n) AS chance FROM k)
SELECT round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(seen, 6) AS accuracy, round((seen - chance) / (1 - chance), 6) AS kappa FROM s""")
def metrics(spark, d):
    m = evaluate.metrics(confusion_matrix(spark, d))
    return m.select(*[r(x, 6).alias(x) for x in ("precision", "recall", "f1", "accuracy", "kappa")])


@query("""WITH t AS (SELECT l_returnflag AS before, l_linestatus AS after, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT before, after, n, round(n * 100 / 4046.8564224, 4) AS acres, round(n / sum(n) OVER (PARTITION BY before), 6) AS share FROM t""")
def transition_matrix(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("before"), F.col("l_linestatus").alias("after"))
    return aggregate.transitions(x, "before", "after").select("before", "after", "n", r("acres").alias("acres"), r("share", 6).alias("share"))


@query("""{obs}, c AS (SELECT k, track, count(*) AS n FROM obs GROUP BY ALL) SELECT k, first(track ORDER BY n DESC, track) AS majority, round(max(n) / sum(n), 6) AS share, sum(n)::BIGINT AS total FROM c GROUP BY k""")
def majority_label(spark, d):
    return aggregate.majority(observations(spark, d), ["k"], "track").withColumn("share", r("share", 6))


@query("""WITH c AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL) SELECT p_brand, first(p_type ORDER BY n DESC, p_type) AS majority, round(max(n) / sum(n), 6) AS share, sum(n)::BIGINT AS total FROM c GROUP BY p_brand""")
def field_majority_share(spark, d):
    return aggregate.majority(table(spark, d, "part"), ["p_brand"], "p_type").withColumn("share", r("share", 6))


@query("{obs} SELECT k, " + ", ".join(f"count(*) FILTER (track = '{t}') AS n_{t}" for t in TRACKS) + " FROM obs GROUP BY k")
def class_counts(spark, d):
    """Rows of each class per key: the zonal count."""
    return aggregate.class_counts(observations(spark, d), "k", "track", TRACKS)


@query("{obs} SELECT day, " + ", ".join(f"round(100 * count(*) FILTER (track = '{t}') / count(*), 1) AS pct_{t}" for t in TRACKS) + " FROM obs GROUP BY day")
def crosstab_shares(spark, d):
    return aggregate.crosstab_shares(observations(spark, d), "day", "track", TRACKS)


@query("""WITH t AS (SELECT p_size AS v, count(*) AS n, count(*) FILTER (p_brand <= 'Brand#2') AS p FROM part GROUP BY 1), c AS (SELECT v, sum(n) OVER w AS ln, sum(p) OVER w AS lp, sum(n) OVER () AS tn, sum(p) OVER () AS tp FROM t WINDOW w AS (ORDER BY v)),
u AS (SELECT v, round((greatest(lp, ln - lp) + greatest(tp - lp, tn - ln - tp + lp)) / tn, 6) AS purity FROM c WHERE ln >= 10 AND tn - ln >= 10)
SELECT v AS cut, purity FROM u ORDER BY purity DESC, v LIMIT 1""")
def best_cut_1d(spark, d):
    return robust.best_cut(table(spark, d, "part"), "p_size", F.col("p_brand") <= "Brand#2", 10)


@query("""WITH s AS (SELECT n_nationkey, m FROM nation, (SELECT unnest(range(1, 13)) AS m)), p AS (SELECT c_nationkey AS n_nationkey, month(o_orderdate) AS m, max(CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END) AS ok FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT n_nationkey, count(*) AS planned, count(*) FILTER (ok = 1) AS valid, round(100 * count(*) FILTER (ok = 1) / count(*), 4) AS valid_pct FROM s LEFT JOIN p USING (n_nationkey, m) GROUP BY n_nationkey""")
def valid_pct_scope(spark, d):
    """Share of the planned (nation, month) cells that hold a large order; empty cells count against it."""
    scope = table(spark, d, "nation").select("n_nationkey", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m"))
    have = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("n_nationkey"), F.month("o_orderdate").alias("m"), "o_totalprice")
    return aggregate.coverage(scope, have, ["n_nationkey", "m"], F.col("o_totalprice") > 450000, ["n_nationkey"]).withColumn("valid_pct", r("valid_pct"))


@query("""WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) SELECT c_custkey AS k, 'missing' AS issue FROM customer WHERE c_custkey NOT IN (SELECT k FROM a) UNION ALL SELECT k, 'low' FROM a WHERE n < 4""")
def qa_issues(spark, d):
    actual = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    return lifecycle.issues(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), actual, ["k"], "n", 4)


@query("""WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal > 0), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 300000)
SELECT CASE WHEN b.k IS NULL THEN 'only_a' WHEN a.k IS NULL THEN 'only_b' ELSE 'both' END AS side, count(*) AS n FROM a FULL JOIN b ON a.k = b.k GROUP BY 1""")
def crosscheck_sets(spark, d):
    a = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    return aggregate.compare_keys(a, table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("k")), "k")


@query("SELECT sha256(text) AS digest, count(*) AS n, min(doc_id) AS first_key FROM documents GROUP BY 1 HAVING count(*) > 1")
def dedupe_shapes(spark, d):
    """Groups of rows with equal content."""
    return aggregate.duplicates(table(spark, d, "documents"), F.col("text"), "doc_id")


@query("""{obs} SELECT k, arg_max(track, (ts, id)) AS track, round(arg_max(v, (ts, id)) FILTER (v > 10), 4) AS v, count(*) AS entries FROM obs GROUP BY k""")
def latest_manifest(spark, d):
    """The last known value of every field of a key's log."""
    log = observations(spark, d).withColumn("v", F.when(F.col("v") > 10, F.col("v")))
    return lifecycle.latest(log, "k", ["ts", "id"], ["track", "v"]).withColumn("v", r("v"))


@query("""{obs}, e AS (SELECT id, k, CASE track WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'done' WHEN 'signup' THEN 'too_large' WHEN 'click' THEN 'started' ELSE 'seen' END AS event, count(*) FILTER (track = 'error') OVER (PARTITION BY k ORDER BY ts, id) AS attempts FROM obs)
SELECT CASE WHEN event = 'done' THEN 'COMPLETED' WHEN event = 'too_large' THEN 'SPLIT' WHEN event = 'failed' AND attempts < 4 THEN 'PENDING' WHEN event = 'failed' THEN 'FAILED' WHEN event = 'started' THEN 'RUNNING' ELSE 'PENDING' END AS state, count(*) AS n FROM e GROUP BY 1""")
def state_machine(spark, d):
    """States after each log entry under the retry and split policy."""
    w = W.partitionBy("k").orderBy("ts", "id")
    names = F.create_map(*[F.lit(x) for x in ("error", "failed", "purchase", "done", "signup", "too_large", "click", "started", "view", "seen")])
    e = observations(spark, d).withColumns({"event": names[F.col("track")], "attempts": F.count(F.when(F.col("track") == "error", 1)).over(w)})
    return e.groupBy(lifecycle.next_state(F.lit("PENDING"), F.col("event"), F.col("attempts"), 4).alias("state")).agg(F.count("*").alias("n"))


@query("""SELECT coalesce(l_returnflag, 'all') AS l_returnflag, coalesce(l_linestatus, 'all') AS l_linestatus, round(sum(l_quantity), 2) AS total, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def totals_rollup(spark, d):
    return aggregate.with_totals(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus", "l_quantity").withColumn("total", r("total", 2))


@query("""SELECT l_returnflag AS before, CASE WHEN l_quantity < 5 THEN l_returnflag WHEN l_returnflag = 'N' AND l_discount > 0.05 THEN 'A' WHEN l_returnflag = 'R' THEN 'N' ELSE l_returnflag END AS after, count(*) AS n FROM lineitem GROUP BY ALL""")
def relabel_simultaneous(spark, d):
    """Rules that test the class as it came; rows of small quantity are kept."""
    after = rules.relabel("l_returnflag", [(F.lit(True), "R", "N"), (F.col("l_discount") > 0.05, "N", "A")], keep=F.col("l_quantity") < 5)
    return table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("before"), after.alias("after")).agg(F.count("*").alias("n"))


@query("""{obs}, a AS (SELECT k, day, avg(v) AS v FROM obs WHERE track = 'view' GROUP BY ALL), b AS (SELECT k, day, avg(v) AS v FROM obs WHERE track = 'click' GROUP BY ALL), j AS (SELECT b.v - a.v AS d FROM a JOIN b USING (k, day))
SELECT count(*) AS n, round(quantile_cont(d, 0.5), 4) AS median_signed, round(quantile_cont(abs(d), 0.5), 4) AS median_abs, round(quantile_cont(abs(d), 0.99), 4) AS p99_abs, round(avg(CASE WHEN abs(d) > 20 THEN 1 ELSE 0 END), 6) AS over_share FROM j""")
def diff_stats(spark, d):
    m = observations(spark, d).groupBy("k", "day", "track").agg(F.avg("v").alias("v"))
    s = aggregate.diff_stats(m.where("track = 'view'"), m.where("track = 'click'"), ["k", "day"], "v", 20.0)
    return s.select("n", *[r(x).alias(x) for x in ("median_signed", "median_abs", "p99_abs")], r("over_share", 6).alias("over_share"))


@query("""{obs}, m AS (SELECT track, day, round(avg(v), 6) AS a FROM obs GROUP BY ALL) SELECT track, round(quantile_cont(a, 0.5), 4) AS median_a, round(avg(CASE WHEN a > 50 THEN 1 ELSE 0 END), 6) AS share_high FROM m GROUP BY track""")
def typed_summary(spark, d):
    m = observations(spark, d).groupBy("track", "day").agg(F.round(F.avg("v"), 6).alias("a")).withColumn("high", F.col("a") > 50)
    return aggregate.typed_summary(m, ["track"], ["a"], ["high"], []).select("track", r("median_a").alias("median_a"), r("share_high", 6).alias("share_high"))


@query("""WITH l AS (SELECT 'p_brand' AS attribute, p_brand AS value FROM part UNION ALL SELECT 'p_type', p_type FROM part UNION ALL SELECT 'p_size', p_size::VARCHAR FROM part), c AS (SELECT attribute, value, count(*) AS n FROM l GROUP BY ALL)
SELECT * FROM (SELECT attribute, value, n, row_number() OVER (PARTITION BY attribute ORDER BY n DESC, value) AS rank FROM c) WHERE rank <= 3""")
def attribute_overview(spark, d):
    return aggregate.attribute_overview(table(spark, d, "part"), ["p_brand", "p_type", "p_size"]).withColumn("rank", F.col("rank").cast("long"))


SWEEP = [200.0, 500.0, 1000.0, 2000.0]


@query(f"""WITH x AS (SELECT n_chars AS v, (quality = 1)::INT AS p, unnest({SWEEP}) AS cut FROM documents JOIN labels USING (doc_id))
SELECT cut::DOUBLE AS cut, sum(CASE WHEN v >= cut THEN p ELSE 0 END)::BIGINT AS tp, sum(CASE WHEN v >= cut THEN 1 - p ELSE 0 END)::BIGINT AS fp, round(sum(CASE WHEN v >= cut THEN p ELSE 0 END) / sum(p), 6) AS recall, round(sum(CASE WHEN v >= cut THEN 1 - p ELSE 0 END) / sum(1 - p), 6) AS false_share FROM x GROUP BY cut""")
def threshold_sweep(spark, d):
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    return aggregate.thresholds_sweep(x, "n_chars", F.col("quality") == 1, SWEEP).select("cut", "tp", "fp", r("recall", 6).alias("recall"), r("false_share", 6).alias("false_share"))


@query("""WITH x AS (SELECT CASE WHEN n_chars >= 800 THEN 1 ELSE 0 END AS p, quality AS a FROM documents JOIN labels USING (doc_id)), c AS (SELECT unnest([0, 1]) AS class)
SELECT class::INT AS class, count(*) FILTER (p = class) AS called, count(*) FILTER (a = class) AS real, count(*) FILTER (p = class AND a = class) AS hit, round(count(*) FILTER (p = class AND a = class) / count(*) FILTER (p = class), 6) AS precision, round(count(*) FILTER (p = class AND a = class) / count(*) FILTER (a = class), 6) AS recall FROM x, c GROUP BY class""")
def class_report(spark, d):
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select(F.when(F.col("n_chars") >= 800, 1).otherwise(0).alias("p"), F.col("quality").cast("int").alias("a"))
    return evaluate.class_report(x, "p", "a").select("class", "called", "real", "hit", r("precision", 6).alias("precision"), r("recall", 6).alias("recall"))


@query("""WITH h AS (SELECT floor(l_quantity / 5) * 5 AS edge, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL), u AS (SELECT *, sum(n) OVER (PARTITION BY l_returnflag ORDER BY edge) AS upto, sum(n) OVER (PARTITION BY l_returnflag) * 0.9 AS goal FROM h)
SELECT l_returnflag, round(first(edge + 5 * (goal - (upto - n)) / n ORDER BY edge), 4) AS percentile FROM u WHERE upto >= goal GROUP BY l_returnflag""")
def histogram_percentile(spark, d):
    h = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus", (F.floor(F.col("l_quantity") / 5) * 5).alias("edge")).agg(F.count("*").alias("c"))
    return robust.histogram_percentile(h, ["l_returnflag"], "edge", "c", 5.0, 0.9).withColumn("percentile", r("percentile"))


@query("""{obs}, s AS (SELECT k, track, avg(v) AS m FROM obs GROUP BY ALL), a AS (SELECT *, quantile_cont(m, 0.5) OVER (PARTITION BY track) AS mid FROM s), b AS (SELECT *, quantile_cont(abs(m - mid), 0.5) OVER (PARTITION BY track) * 1.4826 AS mad FROM a)
SELECT k, track, round((m - mid) / mad, 4) AS z FROM b WHERE mad > 0 AND abs((m - mid) / mad) > 2""")
def outlier_flags(spark, d):
    """Series whose mean stands far from their track's median in robust units."""
    s = observations(spark, d).groupBy("k", "track").agg(F.avg("v").alias("m"))
    return robust.robust_z(s, ["track"], "m").where(F.abs("z") > 2).select("k", "track", r("z").alias("z"))


@query("""WITH RECURSIVE o AS (SELECT o_custkey, o_totalprice AS w, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders),
f AS (SELECT o_custkey, i, w AS held, 1 AS size, 0 AS batch FROM o WHERE i = 1 UNION ALL SELECT o.o_custkey, o.i, CASE WHEN held + w > 500000 OR size >= 4 THEN w ELSE held + w END, CASE WHEN held + w > 500000 OR size >= 4 THEN 1 ELSE size + 1 END, CASE WHEN held + w > 500000 OR size >= 4 THEN batch + 1 ELSE batch END FROM f JOIN o ON o.o_custkey = f.o_custkey AND o.i = f.i + 1)
SELECT o_custkey, batch, count(*) AS n FROM f GROUP BY ALL""")
def plan_batches(spark, d):
    got = lifecycle.greedy_batches(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], ["o_orderkey"], "o_totalprice", 500000, 4)
    return got.groupBy("o_custkey", "batch").agg(F.count("*").alias("n"))


@query("""WITH k AS (SELECT o_custkey, max(o_orderkey) AS last FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT o.o_orderkey, o.o_custkey FROM orders o LEFT JOIN k USING (o_custkey) WHERE last IS NULL OR o_orderkey > last""")
def newer_than_inputs(spark, d):
    """Orders after the last finished one of their customer."""
    orders = table(spark, d, "orders")
    return lifecycle.newer(orders.select("o_orderkey", "o_custkey"), orders.where("o_orderstatus = 'F'"), "o_custkey", "o_orderkey")


@query("""WITH a AS (SELECT c_custkey AS k, c_mktsegment AS seg, '' AS note FROM customer WHERE c_acctbal < 5000), b AS (SELECT c_custkey AS k, CASE WHEN c_nationkey < 9 THEN '' ELSE 'NEW' END AS seg, 'late' AS note FROM customer WHERE c_acctbal >= 3000)
SELECT coalesce(b.k, a.k) AS k, CASE WHEN b.k IS NOT NULL THEN coalesce(nullif(b.seg, ''), a.seg) ELSE a.seg END AS seg, CASE WHEN b.k IS NOT NULL THEN b.note ELSE a.note END AS note FROM a FULL JOIN b ON a.k = b.k""")
def upsert_labels(spark, d):
    """New rows win, blank segments keep the stored one."""
    cust = table(spark, d, "customer")
    old = cust.where("c_acctbal < 5000").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"), F.lit("").alias("note"))
    new = cust.where("c_acctbal >= 3000").select(F.col("c_custkey").alias("k"), F.when(F.col("c_nationkey") < 9, "").otherwise("NEW").alias("seg"), F.lit("late").alias("note"))
    return lifecycle.upsert(old, new, ["k"], ["seg"])


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN q IS NULL THEN -32768 ELSE least(greatest(floor(q * 100 + 0.5), -32767), 32767)::INT END AS code, round(CASE WHEN q IS NOT NULL THEN least(greatest(floor(q * 100 + 0.5), -32767), 32767) / 100 END, 4) AS back FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN 10 * log10(l_quantity) END AS q FROM lineitem)""")
def packed_decibels(spark, d):
    """Decibels as scaled integers and back; missing has a code of its own."""
    q = c.to_db(F.when(F.col("l_linenumber") != 3, F.col("l_quantity")))
    x = table(spark, d, "lineitem").withColumn("code", c.pack(q))
    return x.select("l_orderkey", "l_linenumber", "code", r(c.unpack(F.col("code"))).alias("back"))


@query("""SELECT chunk, count(*) AS n, min(prow) AS first_row, max(pcol) AS last_col FROM (SELECT 'r' || lpad(((o_orderkey // 100) // 16)::VARCHAR, 3, '0') || 'c' || lpad(((o_orderkey % 100) // 16)::VARCHAR, 3, '0') AS chunk, o_orderkey // 100 AS prow, o_orderkey % 100 AS pcol FROM orders) GROUP BY chunk""")
def chunk_of_pixels(spark, d):
    """Pixels of a 100-wide grid by the 16-pixel chunk that holds them."""
    pid = F.col("o_orderkey")
    x = table(spark, d, "orders").select(c.chunk_of(pid, 100, 16).alias("chunk"), c.pixel_row(pid, 100).alias("prow"), c.pixel_col(pid, 100).alias("pcol"))
    return x.groupBy("chunk").agg(F.count("*").alias("n"), F.min("prow").alias("first_row"), F.max("pcol").alias("last_col"))


@query("""SELECT CASE WHEN contains(lower(p_name), 'red') THEN 'warm' WHEN contains(lower(p_name), 'ring') THEN 'round' WHEN contains(lower(p_name), 'small') THEN 'little' ELSE 'other' END AS class, count(*) AS n FROM part GROUP BY 1""")
def text_verdicts(spark, d):
    verdict = c.ordered_match(F.col("p_name"), [("red", "warm"), ("ring", "round"), ("small", "little")], "other")
    return table(spark, d, "part").groupBy(verdict.alias("class")).agg(F.count("*").alias("n"))


@query("""SELECT c_nationkey, c_custkey, c_acctbal, rank FROM (SELECT c_nationkey, c_custkey, c_acctbal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer) WHERE rank <= 2""")
def ranked_choice(spark, d):
    got = aggregate.ranked_choice(table(spark, d, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 2)
    return got.select("c_nationkey", "c_custkey", "c_acctbal", F.col("rank").cast("long").alias("rank"))


@query("""WITH b AS (SELECT o_orderkey AS cell, l_suppkey AS owner, l_quantity AS pr FROM lineitem JOIN orders ON l_orderkey = o_orderkey), m AS (SELECT cell, min(pr) AS p, count(*) AS claims FROM b GROUP BY cell) SELECT b.cell, min(b.owner) AS owner, any_value(claims) AS claims FROM b JOIN m ON b.cell = m.cell AND b.pr = m.p GROUP BY b.cell""")
def overlap_claims(spark, d):
    """Contested cells go to the owner with the least priority value."""
    from ..operators import grid

    b = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderkey").alias("cell"), F.col("l_suppkey").alias("owner"), F.col("l_quantity").alias("pr"))
    return grid.overlap_claims(b, "cell", "owner", "pr")


@query("""WITH u AS (SELECT source, sum(quality)::DOUBLE AS s, count(quality) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1), d AS (SELECT s, n, rep, ('0x' || substr(md5('7|' || source || '|' || rep), 1, 10))::BIGINT / 1099511627776 AS x FROM u, (SELECT unnest(range(1, 201)) AS rep)),
w AS (SELECT *, (x >= 0.36787944117144233)::INT + (x >= 0.7357588823428847)::INT + (x >= 0.9196986029286058)::INT + (x >= 0.9810118431238462)::INT + (x >= 0.9963401531726563)::INT + (x >= 0.9994058151824183)::INT + (x >= 0.9999167588507119)::INT AS w FROM d), m AS (SELECT rep, sum(w * s) / nullif(sum(w * n), 0) AS m FROM w GROUP BY rep)
SELECT round((SELECT sum(s) / sum(n) FROM u), 4) AS mean, round(quantile_cont(m, 0.025), 4) AS low, round(quantile_cont(m, 0.975), 4) AS high FROM m""")
def bootstrap_quality(spark, d):
    """Mean quality with a bootstrap interval over whole sources."""
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    return evaluate.bootstrap_mean(x, "source", "quality", 200, 7).select(*[r(m).alias(m) for m in ("mean", "low", "high")])


@query("""WITH x AS (SELECT lang, n_chars, quality = 1 AS pos FROM documents JOIN labels USING (doc_id)), g AS (SELECT DISTINCT lang AS left_out FROM x), u AS (SELECT left_out, quantile_cont(n_chars, 0.1) AS cut FROM x JOIN g ON lang <> left_out WHERE pos GROUP BY 1)
SELECT left_out, round(cut, 4) AS cut, round(avg(CASE WHEN pos THEN (n_chars >= cut)::INT END), 6) AS recall, round(avg(CASE WHEN NOT pos THEN (n_chars >= cut)::INT END), 6) AS false_share FROM x JOIN u ON lang = left_out GROUP BY ALL""")
def leave_one_region_out(spark, d):
    """A length threshold from all languages but one, tested on that one."""
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    return evaluate.leave_group_out(x, "lang", "n_chars", F.col("quality") == 1).select("left_out", r("cut").alias("cut"), r("recall", 6).alias("recall"), r("false_share", 6).alias("false_share"))


@query()
def rf_grouped_cv(spark, d):
    """Out-of-fold classes of a forest whose folds keep sources whole."""
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").withColumn("lines", F.size(F.split("text", "\n")).cast("double"))
    x = x.withColumns({"marks": F.length(F.regexp_replace("text", r"[^#*$%&|!]", "")).cast("double"), "chars": F.col("n_chars").cast("double")})
    return evaluate.poisson_folds_model(x.select("doc_id", "source", "quality", "lines", "marks", "chars"), ["lines", "marks", "chars"], "quality", "source").select("doc_id", "fold", "prediction")
