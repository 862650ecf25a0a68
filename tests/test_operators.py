"""Operators on small hand-made tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.functions import columns as c
from tidegrid.operators import aggregate, classes, evaluate, events, geometry, graph, grid, joins, lifecycle, masks, reports, robust, rules, season, shapes, smooth, temporal
from tidegrid.sources import scans, tables


def test_composite_takes_clear_maximum_and_its_row(spark):
    rows = [(1, 1, 0, 0.3, 0.1, True), (2, 1, 2, 0.7, 0.2, True), (3, 1, 3, 0.9, 0.3, False), (4, 1, 7, 0.5, 0.4, True)]
    df = spark.createDataFrame(rows, "id long, k int, day int, ndvi double, lswi double, ok boolean")
    got = temporal.composite(df, ["k"], "day", "ndvi", F.col("ok"), 0, 15, 5, ("lswi",)).orderBy("win").collect()
    assert [(r.win, r.ndvi, r.lswi) for r in got] == [(0, 0.7, 0.2), (5, 0.5, 0.4), (10, None, None)]


def test_gap_days(spark):
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate([True, False, False, False, True, False])], "k int, i int, seen boolean")
    got = df.withColumn("g", temporal.gap_days(df, ["k"], "i", F.col("seen"), 5)).orderBy("i").collect()
    assert [r.g for r in got] == [0, 5, 10, 5, 0, 5]


def test_sessions_split_only_beyond_the_gap(spark):
    df = spark.sql("SELECT id, 1 AS k, TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,s) AS ts FROM VALUES (1, 0), (2, 900), (3, 1801) t(id, s)")
    assert [r.session for r in temporal.sessions(df, ["k"], "ts", "id", 900).orderBy("id").collect()] == [1, 1, 2]


def test_gaps_include_the_ends(spark):
    df = spark.createDataFrame([(1, 10), (1, 12), (1, 40)], "k int, day int")
    got = sorted(map(tuple, temporal.gaps(df, ["k"], "day", 9, 0, 60).collect()))
    assert got == [(1, 0, 10, 10), (1, 12, 40, 28), (1, 40, 60, 20)]


@pytest.mark.parametrize("values, labels, want", [([1, 2, 3, 4], [0, 0, 1, 1], 1.0), ([4, 3, 2, 1], [0, 0, 1, 1], 0.0), ([5, 5, 5, 5], [0, 1, 0, 1], 0.5), ([1, 2], [1, 1], None)])
def test_auc(spark, values, labels, want):
    df = spark.createDataFrame(list(zip(map(float, values), labels, strict=True)), "v double, y int")
    assert robust.auc(df, [], "v", F.col("y") == 1).first()["auc"] == want


def test_nearest_prefers_the_earlier_of_equally_near(spark):
    a = spark.createDataFrame([(1, 7, 10)], "id long, k int, day int")
    b = spark.createDataFrame([(7, 8, 1.0), (7, 12, 2.0), (7, 30, 3.0)], "k int, day int, v double")
    assert temporal.nearest(a, b, ["k"], "day", 5, "id", ["v"]).first()["other_v"] == 1.0
    assert temporal.nearest(a, b, ["k"], "day", 1, "id", ["v"]).count() == 0


def dense(y, lam, w=None, rows=None):
    """The same minimum by a full matrix."""
    d = np.diff(np.eye(len(y)), 2, axis=0) if rows is None else rows
    w = np.isfinite(y) * (1.0 if w is None else w)
    return np.linalg.solve(np.diag(w) + lam * d.T @ d, w * np.nan_to_num(y))


def test_whittaker_matches_the_dense_solve_and_keeps_lines():
    rng = np.random.default_rng(0)
    y = rng.normal(size=(6, 30))
    y[rng.random(y.shape) < 0.3] = np.nan
    w = rng.random(y.shape) + 0.1
    assert np.allclose(smooth.fit_all(y, 3.0), [dense(r, 3.0) for r in y])
    assert np.allclose(smooth.fit_all(y, 3.0, w), [dense(r, 3.0, v) for r, v in zip(y, w, strict=True)])
    for order in (1, 3):
        assert np.allclose(smooth.fit_all(y, 2.0, order=order), [dense(r, 2.0, rows=np.diff(np.eye(30), order, axis=0)) for r in y])
    line = np.array([[1.0, np.nan, 3.0, 4.0, 5.0]])
    assert np.allclose(smooth.fit_all(line, 10.0), [[1, 2, 3, 4, 5]], atol=1e-6)
    open_ = np.array([[np.nan] * 4, [np.nan, 2.0, np.nan, np.nan]])
    assert np.array_equal(smooth.fit_all(open_, 1.0), open_, equal_nan=True) and smooth.fit_all(np.ones((1, 2)), 1.0).tolist() == [[1, 1]]


def test_uneven_times_keep_lines_and_match_the_dense_solve():
    t = np.array([0.0, 1.0, 4.0, 5.0, 9.0, 10.0])
    rows = np.zeros((4, 6))
    for i, r in enumerate(smooth.curvature_rows(t)):
        rows[i, i : i + 3] = r
    assert np.allclose(rows @ (2 * t + 1), 0) and np.allclose(rows @ t**2, 2)
    y = np.random.default_rng(1).normal(size=(3, 6))
    assert np.allclose(smooth.fit_all(y, 4.0, times=t), [dense(r, 4.0, rows=rows) for r in y])


def test_envelope_follows_the_upper_values_and_holds_ends():
    days = np.arange(40)
    truth = 0.2 + 0.6 * np.exp(-(((days - 20) / 7.0) ** 2))
    y = truth.copy()
    y[[12, 18, 25]] -= 0.35
    y[[5, 30, 31, 32]] = np.nan
    plain, fit = smooth.fit_all(y[None], 0.5)[0], smooth.envelope_all(y[None], 0.5)[0]
    assert np.abs(fit - truth).max() < np.abs(plain - truth).max() / 2
    y[:2] = np.nan
    e = smooth.envelope_all(np.array([y, np.where(days < 2, 3.0, np.nan), np.full(40, np.nan)]), 2.0)
    assert e[0, 0] == e[0, 1] == e[0, 2] and (e[1] == 3.0).all() and np.isnan(e[2]).all()


def test_envelope_matches_reweighted_dense_solves():
    rng = np.random.default_rng(3)
    y = rng.normal(size=(4, 25))
    for got, r in zip(smooth.envelope_all(y, 2.0), y, strict=True):
        z = dense(r, 2.0)
        for _ in range(3):
            gap = np.maximum(z - r, 0)
            z = dense(r, 2.0, 1 - gap / gap.max())
        assert np.allclose(got, np.clip(z, r.min() - 0.05, r.max() + 0.05))


def test_smoothing_columns(spark):
    df = spark.createDataFrame([([1.0, None, 3.0, 4.0],), (None,), ([],), ([5.0, 5.0],)], "y array<double>")
    got = [r.z for r in df.select(smooth.whittaker(F.col("y"), 10.0).alias("z")).collect()]
    assert np.allclose(got[0], [1, 2, 3, 4]) and got[1:] == [None, [], [5.0, 5.0]]
    with pytest.raises(ValueError):
        smooth.whittaker(F.col("y"), -1.0)
    db = spark.createDataFrame([([-10.0, -12.0, -11.0, -10.5, -12.5],)], "y array<double>")
    power = 10 ** (np.array(db.first().y) / 10)
    assert np.allclose(db.select(smooth.whittaker_power(F.col("y"), 2.0).alias("z")).first().z, 10 * np.log10(dense(power, 2.0)))
    pulled = spark.createDataFrame([([5.0] * 7, [5.0, None, None, 1.0, None, 5.0, 5.0], [False, False, False, True, False, False, False])], "f array<double>, r array<double>, w array<boolean>")
    z = pulled.select(smooth.pull_to_water(F.col("f"), F.col("r"), F.col("w"), 2.0, 0.5).alias("z")).first().z
    assert np.allclose(z, [5, 5 - 4 / 3, 5 - 8 / 3, 1, 3, 5, 5])


def test_penalties_are_scored_on_left_out_values(spark):
    rng = np.random.default_rng(5)
    ys = [(np.sin(np.arange(40) / 6) + 0.3 * rng.normal(size=40)).tolist() for _ in range(4)]
    df = spark.createDataFrame([(y,) for y in ys], "y array<double>")
    lams = [0.01, 5.0, 1e6]
    got = {r.lam: r for r in smooth.penalty_errors(df, "y", lams).collect()}
    for lam in lams:
        miss = []
        for y in map(np.array, ys):
            for k in range(5):
                part = y.copy()
                part[k::5] = np.nan
                miss += np.abs(dense(part, lam)[k::5] - y[k::5]).tolist()
        assert np.isclose(got[lam].error, np.median(miss)) and np.isclose(got[lam]["mean"], np.mean(miss)) and got[lam].n == 160
    assert min(got, key=lambda x: got[x].error) == 5.0
    assert smooth.one_error_rule(smooth.penalty_errors(df, "y", lams)).first().lam == 5.0


def test_cycles_of_two_waves():
    t = np.arange(60)
    got = smooth.find_cycles(np.sin(2 * np.pi * t / 30))
    assert [abs(p[1] - x) <= 1 for p, x in zip(got, (7, 37), strict=False)] == [True, True]
    assert smooth.find_cycles(np.ones(10)) == []


def test_relabel_tests_the_original_class(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "x string")
    out = df.withColumn("y", rules.relabel("x", [(F.lit(True), "a", "b"), (F.lit(True), "b", "c")]))
    assert [r.y for r in out.orderBy("x").collect()] == ["b", "c", "c"]


def test_decide_treats_unknown_as_false(spark):
    df = spark.createDataFrame([(None,), (5,)], "x int")
    got = df.withColumn("y", rules.decide([(F.col("x") > 3, "big"), (~rules.sure(F.col("x") > 3), "rest")], "none")).collect()
    assert {r.x: r.y for r in got} == {None: "rest", 5: "big"}


def test_metrics_are_null_where_undefined(spark):
    m = evaluate.metrics(spark.createDataFrame([(0, 0, 0, 5)], "tp long, fp long, fn long, tn long")).first()
    assert m["precision"] is None and m["recall"] is None and m["accuracy"] == 1.0


def test_patches_and_sieve(spark):
    art = ["110", "010", "001", "100"]
    df = spark.createDataFrame([(i, j, int(v)) for i, line in enumerate(art) for j, v in enumerate(line)], "row int, col int, cls int")
    p = {(r.row, r.col): r.patch for r in grid.patches(df, [], "cls").collect()}
    assert p[0, 0] == p[0, 1] == p[1, 1] == p[2, 2] and p[3, 0] != p[0, 0]
    s = {(r.row, r.col): r.sieved for r in grid.sieve(df, [], "cls", 2).collect()}
    assert s[3, 0] == 0 and s[0, 0] == 1


def flood(cells):
    """Eight-connected patches by hand: cell to the smallest cell of its patch."""
    out = {}
    for start in sorted(cells):
        todo = [] if start in out else [start]
        while todo:
            cell = todo.pop()
            if cell in out:
                continue
            out[cell] = start
            r, col = cell
            todo += [(r + a, col + b) for a in (-1, 0, 1) for b in (-1, 0, 1) if cells.get((r + a, col + b)) == cells[cell]]
    return out


def test_patches_and_sieve_match_brute_force(spark):
    rng = np.random.default_rng(11)
    cells = {(i, j): int(v) for i, line in enumerate(rng.integers(0, 3, (12, 14))) for j, v in enumerate(line)}
    df = spark.createDataFrame([(i, j, v) for (i, j), v in cells.items()], "row int, col int, cls int")
    want = flood(cells)
    got = {(r.row, r.col): r.patch for r in grid.patches(df, [], "cls").collect()}
    assert got == {c: (p[0] << 31) + p[1] for c, p in want.items()}
    size = {p: list(want.values()).count(p) for p in set(want.values())}
    lead = {}
    for (i, j), p in want.items():
        beside = {want[i + a, j + b] for a in (-1, 0, 1) for b in (-1, 0, 1) if (i + a, j + b) in want} - {p}
        lead.setdefault(p, set()).update(beside)
    big = {p: max(qs, key=lambda q: (size[q], (-q[0], -q[1]))) for p, qs in lead.items()}

    def end(p):
        seen = set()
        while size[p] < 4 and p not in seen:
            seen.add(p)
            p = big[p]
        return cells[p] if size[p] >= 4 else None

    sieved = {(r.row, r.col): r.sieved for r in grid.sieve(df, [], "cls", 4).collect()}
    assert sieved == {c: cells[c] if size[p] >= 4 or end(p) is None else end(p) for c, p in want.items()}


def test_a_chain_numbered_along_its_length_takes_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(graph, "written", lambda df, name, plain=graph.written: rounds.append(name) or plain(df, name))
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {(r.node, r.root) for r in graph.components(links).collect()} == {(i, 0) for i in range(201)}
    assert rounds.count("graph-jumps") <= 12
    assert graph.components(links.where("a < 0")).count() == 0


def test_sieve_sends_only_the_cells_of_small_patches(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(grid, "spread", lambda df, *rest, plain=grid.spread: sent.append(df.count()) or plain(df, *rest))
    df = spark.createDataFrame([(i, j, int((i, j) in ((3, 3), (7, 1), (7, 2)))) for i in range(10) for j in range(6)], "row int, col int, cls int")
    assert {r.sieved for r in grid.sieve(df, [], "cls", 4).collect()} == {0}
    assert sent == [3]


def test_a_long_thin_patch(spark):
    """A snake of one class: its ends are far apart along it."""
    art = [[1] * 30 if i % 2 == 0 else ([0] * 29 + [1] if i % 4 == 1 else [1] + [0] * 29) for i in range(25)]
    df = spark.createDataFrame([(i, j, v) for i, line in enumerate(art) for j, v in enumerate(line)], "row int, col int, cls int")
    assert grid.patches(df, [], "cls").where("cls = 1").select("patch").distinct().count() == 1


def test_best_cut_is_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(float(v), bool(v + rng.normal() > 0.3)) for v in rng.normal(size=400)]
    r = robust.best_cut(spark.createDataFrame(rows, "v double, y boolean"), "v", F.col("y"), bins=7).first()

    def purity(cut):
        left, right = [y for v, y in rows if v <= cut], [y for v, y in rows if v > cut]
        return (max(sum(left), len(left) - sum(left)) + max(sum(right), len(right) - sum(right))) / len(rows) if right else 0

    best = max(purity(v) for v, _ in rows)
    assert abs(r.purity - best) < 1e-6 and r.cut == min(v for v, _ in rows if abs(purity(v) - best) < 1e-9)


def test_batches_start_from_zero(spark):
    df = spark.createDataFrame([("a", i, w) for i, w in enumerate([4.0, 4.0, 4.0, 20.0, 1.0, 1.0, 1.0, 1.0])] + [("b", 0, 1.0)], "g string, i int, w double")
    got = {(r.g, r.i): r.batch for r in lifecycle.greedy_batches(df, ["g"], ["i"], "w", 10.0, 3).collect()}
    assert [got["a", i] for i in range(8)] == [0, 0, 1, 2, 3, 3, 3, 4] and got["b", 0] == 0


def test_ring_area_and_compactness(spark):
    df = spark.createDataFrame([([(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)],)], "ring array<struct<x double, y double>>")
    r = df.select(grid.ring_area(F.col("ring")).alias("a"), grid.ring_compactness(F.col("ring")).alias("c")).first()
    assert r.a == 4.0 and abs(r.c - np.pi / 4) < 1e-9


def test_upsert_keeps_blank_fields(spark):
    old = spark.createDataFrame([(1, "x"), (2, "y")], "k int, s string")
    new = spark.createDataFrame([(1, ""), (3, "z")], "k int, s string")
    assert sorted(map(tuple, lifecycle.upsert(old, new, ["k"], ["s"]).collect())) == [(1, "x"), (2, "y"), (3, "z")]


def test_require_names_what_is_missing(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(ValueError, match="9"):
        tables.require(df, spark.createDataFrame([(1,), (9,)], "k int"), "k")
    assert tables.require(df, df.limit(1), "k").count() == 1


def test_pipe_table(spark):
    lines = spark.createDataFrame([("# t",), ("| a | b |",), ("|---|---|",), ("| 1 | x y |",)], "value string")
    assert [tuple(r) for r in tables.parse_pipe_table(lines, ["a", "b"]).collect()] == [("a", "b"), ("1", "x y")]


def test_packed_values_round_trip(spark):
    df = spark.createDataFrame([(-12.345,), (None,), (999.0,)], "v double").withColumn("p", c.pack(F.col("v"))).withColumn("u", c.unpack(F.col("p")))
    assert [(r.p, r.u) for r in df.collect()] == [(-1234, -12.34), (-32768, None), (32767, 327.67)]


def test_seeded_cap_is_the_same_however_the_table_is_dealt(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 3)
    a = aggregate.seeded_cap(df, ["g"], "id", 10, 5)
    b = aggregate.seeded_cap(df.repartition(7), ["g"], "id", 10, 5)
    assert {r.id for r in a.collect()} == {r.id for r in b.collect()} and a.count() == 30


def test_own_scale_rule(spark):
    names = "ndvi_low_peak vh_pos_end days_since_peak days_at_top ndvi_slope_end vh_slope_end ndvi_rise_days ndvi_left".split()
    rows = [(0.6, 0.7, 60, 60, 0.0, 0.0, 30, 0.9), (0.1, 0.4, 0, 0, 0.5, 0.5, 20, 1.0), (0.0, 0.4, 0, 0, 0.5, 0.1, 40, 1.0), (0.15, 0.9, 100, 100, -0.1, 0.1, 25, 0.1), (0.15, 0.9, 50, 60, -0.5, 0.3, 70, 0.2), (0.15, 0.8, 30, 40, -0.1, 0.0, 60, 0.9), (0.15, 0.2, 50, 60, 0.0, -0.4, 70, 0.69)]
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(rows)], ["i", *names])
    got = [x.c for x in df.withColumn("c", classes.own_scale_class(df)).orderBy("i").collect()]
    assert got == ["tree/orchard", "young rice", "flooded / bare", "other vegetation", "rice harvested", "rice standing direct seeded", "rice standing direct seeded"]


def test_half_plane_and_long_axis(spark):
    df = spark.createDataFrame([([(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (0.0, 1.0), (0.0, 0.0)],)], f"ring {geometry.RING}")
    cut = df.select(geometry.half_plane(F.col("ring"), F.lit(0.0), F.lit(1.0)).alias("h"), geometry.long_axis(F.col("ring")).alias("t"))
    r = cut.select(grid.ring_area(F.col("h")).alias("a"), "t").first()
    assert abs(r.a - 1.0) < 1e-9 and r.t == 0.0


def test_points_inside_a_concave_ring(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)]
    df = spark.createDataFrame([(ring, 2.0, 3.0), (ring, 0.5, 2.0), (ring, 5.0, 1.0)], f"ring {geometry.RING}, x double, y double")
    assert [r.i for r in df.select(geometry.inside(F.col("ring"), F.col("x"), F.col("y")).alias("i")).collect()] == [False, True, False]


def test_spread_pick():
    assert geometry.spread_pick([("a", 9, 0.0, 0.0), ("b", 8, 0.0, 0.01), ("c", 7, 1.0, 0.0)], 2, 15) == ["a", "c"]


def test_components_and_further_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in graph.components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 90: 90, 100: 90}
    more = graph.extend(graph.components(links), spark.createDataFrame([(100, 40), (200, 201)], "a long, b long"))
    assert {r.node: r.root for r in more.collect()} == {**dict.fromkeys(range(41), 0), 90: 0, 100: 0, 200: 200, 201: 200}


def test_coverage_of_equal_boxes_meets_once(spark, monkeypatch):
    met = []
    monkeypatch.setattr(joins, "touching", lambda a, b, *rest, plain=joins.touching: met.append((a.count(), b.count())) or plain(a, b, *rest))
    names = "xmin double, ymin double, xmax double, ymax double"
    a = spark.createDataFrame([(k, x, 0.0, x + 10, 10.0) for k, x in ((1, 0.0), (2, 0.0), (3, 50.0), (4, 200.0), (4, 0.0))], "chunk long, " + names)
    b = spark.createDataFrame([(t, x, 0.0, x + 20, 20.0) for t, x in (("u", 0.0), ("u", 0.0), ("u", 45.0), ("v", 5.0), ("v", 55.0))], "track string, " + names)
    got = {(r.chunk, r.track): (r.touch, r.whole) for r in joins.coverage_by_box(a, b, "chunk", ["track"], 25.0).collect()}
    assert got == {(1, "u"): (2, 2), (1, "v"): (1, 0), (2, "u"): (2, 2), (2, "v"): (1, 0), (3, "u"): (1, 1), (3, "v"): (1, 0), (4, "u"): (2, 2), (4, "v"): (1, 0)}
    assert met == [(3, 4)]


def test_work_list_of_many_tracks(spark):
    tracks, chunks = spark.range(10_500).withColumnRenamed("id", "track"), spark.range(3).withColumnRenamed("id", "chunk")
    bare, known = spark.createDataFrame([(7, 1)], "track long, chunk long"), spark.createDataFrame([(7, 2), (10_499, 0)], "track long, chunk long")
    got = lifecycle.work_list(tracks, chunks, bare, known, ["track", "chunk"])
    assert got.count() == 31_497 and {r.chunk for r in got.where("track = 7").collect()} == {0}


@pytest.mark.parametrize("values", [[3.0], [1.0, 4.0], [2.0, 2.0, 9.0, 1e12, -5.0, 2.5], [float(i % 97) ** 3 for i in range(1000)]])
def test_area_check_by_counts(spark, values):
    df = spark.createDataFrame([(v, 1.0) for v in values] + [(None, 1.0), (5.0, 0.0)], "a double, b double")
    got = reports.area_check(df, "a", "b")
    assert "percentile" not in got._jdf.queryExecution().optimizedPlan().toString()
    x, mid = np.array(values), float(np.median(values))
    r = got.first()
    assert r.ratio == mid and np.isclose(r.worst_pct, (100 * abs(x / mid - 1)).max()) and np.isclose(r.mean_pct, (100 * abs(x / mid - 1)).mean())
    assert reports.area_check(df.where("a < -100"), "a", "b").count() == 0


def test_steady_mean(spark):
    rows = [("a", 0.1), ("a", 0.2), ("a", 0.3), ("b", 0.2), ("c", None), ("d", 1e300), ("d", 1.0), ("e", float("nan")), ("f", 1e-30), ("g", None), ("g", -4.5)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    got = {r.k: r.m for r in df.groupBy("k").agg(c.steady_mean("v").alias("m")).collect()}
    assert got["a"] == got["b"] == 0.2 and got["c"] is None and got["d"] == 5e299 and np.isnan(got["e"]) and got["f"] == 1e-30 and got["g"] == -4.5


# --- masks and events --------------------------------------------------------


def test_clear_mask_tests(spark):
    names = "green red nir blue qa score"
    rows = [(1, 0, 500, 10, 0, 90), (5, 5, 0, 10, 0, 90), (300, 300, 3000, 200, 1024, 90), (300, 300, 3000, 200, 0, 10), (300, 300, 400, 200, 0, 10), (300, 300, 3000, 950, 0, 90), (300, 300, 3000, 200, 0, 90)]
    df = spark.createDataFrame(rows, [*names.split()]).withColumn("i", F.monotonically_increasing_id())
    c_ = F.col
    data = masks.has_data(c_("green"), c_("red"), c_("nir"))
    ndvi = F.when(data, (c_("nir") - c_("red")) / (c_("nir") + c_("red")))
    got = df.select(masks.lost_to(data, c_("qa"), c_("score"), c_("nir"), ndvi, c_("blue"), c_("red")).alias("t"), masks.has_data(c_("green"), c_("red"), c_("nir"), True).alias("w")).collect()
    assert [r.t for r in got] == ["no_data", "no_data", "opaque", "score", "kept", "haze", "kept"] and [r.w for r in got][:2] == [False, True]


def test_relative_scores_take_the_cells_own_level(spark):
    rows = [(1, d, s) for d, s in enumerate([80.0, 82.0, 79.0, 48.0, 5.0])] + [(2, d, s) for d, s in enumerate([78.0, 79.0, 81.0, 4.0, 3.0])] + [(3, 0, 6.0)]
    df = spark.createDataFrame(rows, "cell int, day int, score double")
    lim = {r.cell: r.limit for r in masks.clear_limits(df, ["cell"], "score").collect()}
    assert 20 < robust.otsu(df, "score").first().threshold < 48
    up = np.array([80.0, 82.0, 79.0, 78.0, 79.0, 81.0, 48.0])
    area = 1.4826 * np.median(np.abs(up - np.median(up)))
    own = np.array([80.0, 82.0, 79.0, 48.0])
    spread = 1.4826 * np.median(np.abs(own - np.median(own)))
    assert np.isclose(lim[1], np.median(own) - 2 * np.hypot(spread, area)) and lim[1] > 48 and 6 < lim[3] < 78
    best = {(r.cell, r.day): r.clear for r in masks.clear_beside_best(df, ["cell"], "day", "score", F.col("score") > 0).collect()}
    assert best[1, 1] and not best[1, 3] and best[3, 0]


def test_durable_lows_skip_short_dips(spark):
    y = [0.8, 0.3, 0.8, 0.2, 0.2, 0.15, 0.2, 0.9]
    df = spark.createDataFrame([(1, i, i * 5, v) for i, v in enumerate(y)], "k int, i int, day int, v double")
    got = events.durable_lows(df, "k", "i", "day", "v", F.col("i").isin(1, 5), 10).collect()
    assert [(r.i, r.low_days) for r in got] == [(5, 15)]


def test_bare_near_without_views_is_bare(spark):
    views = spark.createDataFrame([(1, 3, 0.9), (2, 3, 0.2)], "k int, i int, v double")
    e = spark.createDataFrame([(1, 3, None), (2, 3, None), (3, 3, None)], "k int, at int, climb int")
    assert {r.k: r.bare_near for r in events.bare_near(views, e, "k", "i", "v", 0.45, 1, 1).collect()} == {1: False, 2: True, 3: True}


def test_onset_is_where_the_curve_turns_up(spark):
    y = [0.1, 0.1, 0.1, 0.1, 0.3, 0.6, 0.9]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(y)], "k int, i int, v double")
    spans = spark.createDataFrame([(1, 0, 6)], "k int, lo int, hi int")
    accel = np.gradient(np.gradient(np.array(y)))
    assert events.onset(df, spans, "k", "i", "v").first().onset == int(np.argmax(np.round(accel, 9)))


def test_switches_of_the_own_scale_rule(spark):
    base = {"ndvi_low_peak": 0.1, "vh_pos_end": 0.9, "ndvi_left": 0.9, "ndvi_rise_days": 60.0, "days_at_top": 30.0, "crop_age": 80.0, "days_off_top": 5.0}
    rows = [{**base, "dry_water_share": 0.7}, {**base, "water_depth": 4.0}, {**base, "fit_low_peak": 0.7}, {**base, "vh_pos_end": 0.2, "crop_age": 20.0, "water_depth": -1.0, "ndvi_left": 1.0, "days_at_top": 0.0}, {**base, "ndvi_left": 0.3}]
    names = sorted({n for r in rows for n in r})
    df = spark.createDataFrame([(i, *[float(r[n]) if n in r else None for n in names]) for i, r in enumerate(rows)], f"i int, {', '.join(f'{n} double' for n in names)}")
    call = lambda **kw: [r.c for r in df.select("i", classes.own_scale_class(df, classes.OwnScale().using(**kw)).alias("c")).orderBy("i").collect()]
    assert call() == [classes.SEEDED, classes.SEEDED, classes.SEEDED, classes.FLOODED, classes.CUT]
    assert call(pond=True)[0] == classes.FLOODED and call(any_water=True)[1] == classes.PLANTED
    assert call(never_emptied=0.5)[2] == classes.OTHER and call(canopy_not_flooded=True)[3] == classes.YOUNG
    assert call(canopy_not_flooded=True, young_needs_water=True)[3] == classes.SEEDED and call(harvest_needs_both=True)[4] == classes.SEEDED


# --- shapes ------------------------------------------------------------------


def drawn(spark, *layers):
    rows = [(int(v), i, j) for art in layers for i, line in enumerate(art) for j, v in enumerate(line) if v != "."]
    return spark.createDataFrame(rows, "shape long, row int, col int")


def picture(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.shape, set()).add((r.row, r.col))
    return out


def test_holes_are_filled_up_to_a_size(spark):
    art = ["11111", "1.1.1", "11111", "1...1", "1...1", "11111"]
    got = picture(shapes.fill_holes(drawn(spark, art), "shape", 1))[1]
    assert (1, 1) in got and (1, 3) in got and (3, 2) not in got
    open_ = picture(shapes.fill_holes(drawn(spark, ["111", "1..", "111"]), "shape", 9))[1]
    assert (1, 1) not in open_
    corner = picture(shapes.fill_holes(drawn(spark, [".1.", "1.1", ".1."]), "shape", 1))[1]
    assert (1, 1) in corner


def test_slivers_join_the_longest_common_side(spark):
    got = picture(shapes.absorb_slivers(drawn(spark, ["11122", "11132", "11132", "444.2"]), "shape", 4))
    assert (1, 3) in got[1] or (1, 3) in got[2]
    assert 3 not in got and sum(map(len, got.values())) == 19 and (3, 0) in got[1]


def test_free_ground_in_patches(spark):
    wanted = drawn(spark, ["1111", "1111", "1111"]).select("row", "col")
    got = shapes.free_ground(wanted, drawn(spark, [".2..", "222.", ".2.."]), 3).collect()
    assert {(r.row, r.col) for r in got} == {(0, 2), (0, 3), (1, 3), (2, 2), (2, 3)}


def test_overlaps_dissolve_and_parts_split(spark):
    cells = drawn(spark, ["11...", "11..3", "....."], [".22..", ".22..", "....."], ["...4.", ".....", "....."])
    assert {(r.a, r.b, r.cells) for r in shapes.overlaps(cells, "shape").collect()} == {(1, 2, 2)}
    assert set(picture(shapes.dissolve(cells, "shape"))) == {1, 3, 4}
    cut = picture(shapes.cut_overlaps(cells, "shape"))
    assert len(cut[1]) == 4 and len(cut[2]) == 2
    parts = shapes.split_parts(drawn(spark, ["11.1", "11.1", "...."]), "shape", 2).collect()
    assert {(r.part, r.row, r.col) for r in parts} == {(0, 0, 0), (0, 0, 1), (0, 1, 0), (0, 1, 1), (1, 0, 3), (1, 1, 3)}
    tails = picture(shapes.remove_tails(drawn(spark, ["111..", "11111", "111.."]), "shape"))[1]
    assert tails == {(i, j) for i in range(3) for j in range(3)}


# --- lifecycle, joins, reviews ----------------------------------------------


def test_torn_lines_are_ignored(spark):
    lines = spark.createDataFrame([(1, '{"task":"a","state":"S1"}'), (2, '{"task":"a","size":5}'), (3, '{"task":"a","state":"S'), (4, ""), (5, '{"state":"x"}')], "seq long, value string")
    old = spark.createDataFrame([("a", "S0", 1), ("b", "S9", 2)], "task string, state string, size long")
    got = sorted(map(tuple, lifecycle.replay(lines, old, "task", {"state": "string", "size": "bigint"}).select("task", "state", "size").collect()))
    assert got == [("a", "S1", 5), ("b", "S9", 2)]
    assert lifecycle.replay(lines, None, "task", {"state": "string"}).count() == 1


def test_issues_must_be_decided(spark):
    found = spark.createDataFrame([(1, "low"), (2, "missing")], "k int, issue string")
    with pytest.raises(ValueError, match="missing"):
        lifecycle.require_decisions(found, found.where("k = 1"), ["k", "issue"])
    assert lifecycle.require_decisions(found, found, ["k", "issue"]).count() == 2


def test_one_row_a_file(spark):
    rows = spark.createDataFrame([("aoi7.shp",), ("aoi12.shp",), ("x.shp",)], "f string")
    assert sorted((r.number or 0) for r in joins.one_per_file(rows, F.col("f"), r"(\d+)\.").collect()) == [0, 7, 12]
    with pytest.raises(ValueError, match="aoi7"):
        joins.one_per_file(rows.unionByName(rows.limit(1)), F.col("f"), r"(\d+)\.")


def test_nearest_chain():
    assert joins.nearest_chain([("a", 0, 0), ("b", 5, 0), ("c", 1, 0), ("d", 6, 0)], ["a"]) == ["a", "c", "b", "d"]


def test_hold_last(spark):
    df = spark.createDataFrame([([1.0, None, 3.0, None, None],), ([None, None],)], "v array<double>")
    assert [r.h for r in df.select(reports.hold_last(F.col("v")).alias("h")).collect()] == [[1.0, None, 3.0, 3.0, 3.0], [None, None]]


def test_samples_keep_their_limits(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 3).alias("c"), (F.col("id") % 7).alias("g"))
    got = evaluate.balanced_sample(df, "c", "g", "id", 40, 10, 1)
    assert got.groupBy("c").count().agg(F.max("count")).first()[0] == 40 and got.groupBy("c", "g").count().agg(F.max("count")).first()[0] <= 10
    fields = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 50).alias("size"), (F.col("id") % 4 == 0).alias("differ"))
    picked = evaluate.review_sample(fields, "k", "size", F.col("differ"), 20, 3).collect()
    assert len(picked) == 20 and sum(r.why == "differ" for r in picked) == 10 and min(r["size"] for r in picked if r.why == "differ") == 40
    assert sorted(map(tuple, picked)) == sorted(map(tuple, evaluate.review_sample(fields.repartition(3), "k", "size", F.col("differ"), 20, 3).collect()))


def test_a_variant_must_win_on_the_held_out_half(spark):
    rows = [("x", "s0", 0, 0.5), ("x", "s0", 1, 0.5), ("x", "s1", 0, 0.9), ("x", "s1", 1, 0.4), ("y", "s0", 0, 0.5), ("y", "s0", 1, 0.5), ("y", "s1", 0, 0.9), ("y", "s1", 1, 0.6)]
    df = spark.createDataFrame(rows, "area string, variant string, half int, ok double")
    got = {r.area: r.variant for r in evaluate.best_variant(df, ["area"], "variant", "ok", F.col("half") == 0, F.col("half") == 1).collect()}
    assert got == {"x": "s0", "y": "s1"}


def test_forest_settings_are_not_run_twice(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(v), float(w), int(v > 0), i % 6) for i, (v, w) in enumerate(rng.normal(size=(120, 2)))], "a double, b double, y int, g int")
    first = evaluate.tune_forest(df, ["a", "b"], "y", "g", [{"trees": 3}], 2, 1)
    again = evaluate.tune_forest(df, ["a", "b"], "y", "g", [{"trees": 3}, {"trees": 5}], 2, 1, done=first)
    assert again.count() == 2 and first.first().accuracy > 0.8


def test_field_status_of_curves(spark):
    days = [float(10 * i) for i in range(12)]
    curves = {
        "standing": [0.1, 0.1, 0.2, 0.5, 0.7, 0.8, 0.8, 0.8, 0.79, 0.8, 0.78, 0.79],
        "harvested": [0.1, 0.1, 0.2, 0.5, 0.7, 0.8, 0.8, 0.78, 0.75, 0.3, 0.25, 0.25],
        "just cut": [0.1, 0.1, 0.2, 0.5, 0.7, 0.8, 0.8, 0.8, 0.79, 0.8, 0.78, 0.3],
        "short": [0.1, 0.5],
    }
    df = spark.createDataFrame([(n, days[: len(v)], v) for n, v in curves.items()], "n string, d array<double>, v array<double>")
    got = {r.n: r.s for r in df.select("n", season.field_status(F.col("d"), F.col("v")).alias("s")).collect()}
    assert [got[n].status for n in curves] == ["standing", "harvested", "harvested", "no data"]
    assert (got["harvested"].cut_from, got["harvested"].cut_to) == (80.0, 90.0) and got["just cut"].cut_to == 110.0


def test_peers_must_be_enough(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "k int, v double").withColumn("noise", F.lit(0.0))
    few = season.beside_peers(df, "v", "noise", season.peer_level(df, "v", F.col("k") < 5, 50))
    assert few.where("reaches or above is not null").count() == 0 and few.count() == 10
    enough = {r.k: r.reaches for r in season.beside_peers(df, "v", "noise", season.peer_level(df, "v", F.lit(True), 5)).collect()}
    assert enough[9] and enough[4] and not season.beside_peers(df.limit(1).withColumn("v", F.lit(-99.0)), "v", "noise", season.peer_level(df, "v", F.lit(True), 5)).first().reaches


def test_metadata_must_be_whole(spark):
    lines = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 2}',)], "value string")
    assert scans.checked_metadata(lines, "a int, b string", ["a"]).count() == 2
    with pytest.raises(ValueError, match='"a": 2'):
        scans.checked_metadata(lines, "a int, b string", ["a", "b"])
    assert scans.same_grid({"w": 1, "h": 2}, {"w": 1, "h": 3}) == "h: 2 and 3" and scans.same_grid({"w": 1}, {"w": 1}) is None


def test_a_table_is_written_whole(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    scans.write_whole(spark.range(5), path)
    scans.write_whole(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]


def test_peaks_by_prominence():
    rng = np.random.default_rng(9)
    for _ in range(60):
        y = rng.permutation(18) / 18
        want = []
        for i in range(1, 17):
            if not (y[i - 1] < y[i] > y[i + 1]):
                continue
            left = next((j for j in range(i - 1, -1, -1) if y[j] > y[i]), 0)
            right = next((j for j in range(i + 1, 18) if y[j] > y[i]), 17)
            if y[i] - max(y[left : i + 1].min(), y[i : right + 1].min()) >= 0.3:
                want.append(i)
        assert [p for p in smooth.prominent_peaks(y, 0.3) if p < 17] == want
    assert smooth.prominent_peaks(np.array([0.0, 1.0, 1.0, 1.0, 0.0, 0.5]), 0.4) == [2, 5]
    assert smooth.shoulder(np.array([0.5, 0.1, 0.11, 0.4, 0.9]), 0, 4, True) == 2 and smooth.shoulder(np.array([0.5, 0.1, 0.11, 0.4, 0.9]), 0, 4, False) == 1


def test_scans_and_sinks(spark, tmp_path):
    old, new = spark.createDataFrame([(1, "a")], "k int, s string"), spark.createDataFrame([(2, 0.5)], "k int, v double")
    got = tables.union_by_name({"old": old, "new": new}).orderBy("k").collect()
    assert [(r.k, r.s, r.v, r.source) for r in got] == [(1, "a", None, "old"), (2, None, 0.5, "new")]
    path = f"file://{tmp_path}/w"
    tables.write_partitioned(spark.range(20).withColumn("g", F.col("id") % 3), path, "g")
    assert sorted(p.name for p in (tmp_path / "w").glob("g=*")) == ["g=0", "g=1", "g=2"] and spark.read.parquet(path).count() == 20
    (tmp_path / "x.csv").write_text("k,s\n1,a\n2,\n")
    rows = tables.scan_with_schema(spark, f"file://{tmp_path}/x.csv", "k int, s string").orderBy("k").collect()
    assert [(r.k, r.s) for r in rows] == [(1, "a"), (2, None)]
