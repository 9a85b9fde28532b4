from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparvane.functions import vectors
from sparvane.operators import impute, interp, knn, metric, rollup, similarity

MEASURED = "channel string, Data double, dData double, dEnergy double"


def assumed(spark, rows, gate=("dData", "dEnergy", "Data"), fallback=None):
    df = spark.createDataFrame(rows, MEASURED)
    fallback = spark.createDataFrame([(fallback,)], "global_fraction double") if fallback is not None else None
    out = impute.assume_errors(df, ["channel"], list(gate), fallback=fallback)
    return sorted(((r.channel, r.Data, r.dData_assumed) for r in out.collect()), key=repr)


def test_channel_quantile_cap_gate_and_fallback(spark):
    a = [("a", 10.0, 1.0, 1.0), ("a", 20.0, None, 1.0), ("a", 30.0, 6.0, 1.0), ("a", 40.0, None, 1.0)]
    got = {(c, d): x for c, d, x in assumed(spark, [*a, ("b", 5.0, None, 1.0), ("c", 1.0, 25.0, 1.0), ("c", 2.0, None, 1.0), ("e", 0.0, 1.0, 1.0), ("d", 10.0, 1.0, None), ("d", 20.0, None, None)], fallback=0.5)}
    assert math.isclose(got["a", 20.0], 3.8) and math.isclose(got["a", 40.0], 7.6) and got["a", 10.0] == 1.0
    assert got["b", 5.0] == 2.5  # no uncertainty: global
    assert got["c", 1.0] == 25.0 and got["c", 2.0] == 20.0  # capped at 10
    assert got["e", 0.0] == 1.0  # no finite ratio
    assert got["d", 20.0] == 10.0  # the gate looks at all columns


def test_gate_on_uncertainty_only(spark):
    got = assumed(spark, [("d", 10.0, 1.0, None), ("d", 20.0, None, None)], gate=("dData",), fallback=0.5)
    assert got[1][2] == 2.0


def test_null_channel_and_empty(spark):
    assert assumed(spark, [(None, 10.0, 1.0, 1.0), (None, 20.0, None, 1.0)])[1][2] == 2.0
    assert assumed(spark, []) == []


def test_global_quantile_is_numpys(spark):
    rows = [(float(x), float(y)) for x, y in np.random.default_rng(0).uniform(1, 9, (37, 2))]
    got = impute.global_quantile(spark.createDataFrame(rows, "Data double, dData double")).first()[0]
    assert math.isclose(got, np.quantile([y / x for x, y in rows], 0.9), rel_tol=1e-12)


@pytest.mark.parametrize(("outside", "below", "above"), [("zero", 0.0, 0.0), ("null", None, None), ("clamp", 10.0, 0.0)])
def test_interpolation(spark, outside, below, above):
    grid = spark.createDataFrame([("a", 1.0, 10.0), ("a", 2.0, 20.0), ("a", 4.0, 0.0)], "k string, gx double, gy double")
    points = spark.createDataFrame([(i, k, x) for i, (k, x) in enumerate([("a", 1.0), ("a", 1.5), ("a", 3.0), ("a", 4.0), ("a", 0.5), ("a", 5.0), ("b", 1.0), ("a", None)])], "i int, k string, x double")
    out = interp.interpolate(points, grid, ["k"], "x", "gx", "gy", "v", outside=outside)
    assert [r.v for r in out.orderBy("i").collect()] == [10.0, 15.0, 10.0, 0.0, below, above, None, None]


def test_interpolation_is_numpys(spark):
    rng = np.random.default_rng(1)
    gx = np.unique(10 ** rng.uniform(-4, 6, 200))
    gy, x = rng.uniform(0, 9, len(gx)), 10 ** rng.uniform(-4, 6, 500)
    grid = spark.createDataFrame([("a", float(a), float(b)) for a, b in zip(gx, gy, strict=True)], "k string, gx double, gy double")
    points = spark.createDataFrame([(i, "a", float(v)) for i, v in enumerate(x)], "i int, k string, x double")
    got = [r.v for r in interp.interpolate(points, grid, ["k"], "x", "gx", "gy", "v", outside="clamp").orderBy("i").collect()]
    assert np.allclose(got, np.interp(x, gx, gy), rtol=1e-9)


def test_metrics(spark):
    df = spark.createDataFrame([(12.0, 3.0, 15.0), (12.0, 3.0, 0.0), (1.0, 0.0, 2.0)], "Data double, dData_assumed double, ev double")
    rows = [(r.ev_chi_squared, r.ev_relative_error) for r in interp.with_metrics(df, "ev").collect()]
    assert rows == [(3.0, -20.0), (48.0, None), (None, -50.0)]


def test_subentries(spark):
    df = spark.createDataFrame([(1, "s", 26, 1.0, 1.0), (2, "s", 27, 2.0, None), (3, "s", 28, 10.0, 3.0), (4, "s", 29, None, None)], "i int, sub string, Z int, Energy double, dData double")
    r = rollup.subentries(df, "sub", ["Z"], "i").first()
    assert (r.Z, r.E_min, r.E_max, r.E_median, r.num_measurements, r.num_measurements_uncertainty) == (26, 1.0, 10.0, 2.0, 4, 2)


def test_entries(spark):
    rows = [(1, "e", "s1", 26, "Fe", "N,TOT", 1.0), (2, "e", "s1", 26, "Fe", "N,G", None), (3, "e", "s2", 27, "Co", "N,TOT", 2.0)]
    df = spark.createDataFrame(rows, "i int, e string, s string, Z int, Element string, Reaction string, dData double")
    r = rollup.entries(df, "e", {"Z_Values": ("Z", ","), "Elements": ("Element", ","), "Reactions": ("Reaction", "-")}, "s", "i").first()
    assert (r.Z_Values, r.Elements, r.Reactions) == ("26,27", "Fe,Co", "N,TOT-N,G")
    assert (r.Num_Subentries, r.Num_Measurements, r.Num_Missing_Uncertainty, r.Uncertainty_Complete) == (2, 3, 1, False)


def test_histogram(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.0, 0.0, 0.05, 0.5, 1.0, 1.0, None)], "x double")
    got = {r["bin"]: r["count"] for r in rollup.histogram(df, "x").collect()}
    assert got == {1: 4, 2: 0, 3: 0, 4: 0, 5: 1, 6: 0, 7: 0, 8: 0, 9: 0, 10: 2}


def test_similarity(spark):
    s = spark.createDataFrame([("r", 1, "c", 1.0, [0.8, 0.6]), ("r", 2, "c", 0.9, [0.85, math.sqrt(1 - 0.85**2)]), ("q", 1, "c", 0.9, [-0.5, math.sqrt(0.75)])], "EXFOR_Entry string, Sentence_Number int, category string, gate double, Embedding array<double>")
    t = spark.createDataFrame([("c", [1.0, 0.0])], "category string, Template_Embedding array<double>")
    got = {r.EXFOR_Entry: (round(r.max_sim, 6), r.closest) for r in similarity.category_scores(s, t).collect()}
    assert got == {"r": (0.8, 1), "q": (-0.45, 1)}


def test_prediction(spark):
    near = spark.createDataFrame([(1, i, d, i) for i, d in enumerate((0.5, 1.0, 2.0, 4.0, 8.0))] + [(2, 0, 0.0, 0), (2, 1, 1.0, 1)], "target int, candidate int, distance double, rank int")
    ratios = spark.createDataFrame(list(enumerate((0.1, 0.2, 0.05, 0.4, 0.3))), "candidate int, ratio double")
    got = {r.target: r.prediction for r in knn.predict(near, ratios).collect()}
    assert math.isclose(got[1], 0.145161290, rel_tol=1e-7) and got[2] == 0.1


def test_level1_is_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ABCD"), rng.choice("xy"), rng.choice([0.0, 0.5, 1.0, rng.random()]), float(rng.randint(0, 2)), float(rng.randint(0, 2))) for i in range(300)]
    schema = "measurement_id int, e string, mt string, logE_std double, Z_std double, A_std double"
    targets, candidates = [r for r in rows if r[1] == "A"], [r for r in rows if r[1] != "A"]
    expected = {}
    for t in targets:
        for c in candidates:
            if c[2] == t[2]:
                d = 0.5 * (c[3] - t[3]) ** 2 + 1.5 * (c[4] - t[4]) ** 2 + (c[5] - t[5]) ** 2
                k = (t[0], c[1])
                expected[k] = min(expected.get(k, (9e9, 0)), (d, c[0]))
    pairs = spark.createDataFrame([("A", e, 0.1) for e in "BCD"], "target_entry string, entry string, report_distance double")
    got = knn.nearest_rows(spark.createDataFrame(targets, schema), spark.createDataFrame(candidates, schema), pairs, "e", "mt", "measurement_id").collect()
    assert {(r.target, r.entry): r.candidate for r in got} == {k: v[1] for k, v in expected.items()}


def brute_search(rows, reports, k):
    """All targets against all candidates. rows: (id, entry, mt, logE, Z, A); reports: entry -> (vector or None, scores)."""
    out = []
    for t in rows:
        if t[1] >= 8 or t[1] not in reports:
            continue
        near = {}
        for c in rows:
            if c[1] < 8 or c[1] not in reports or c[2] != t[2]:
                continue
            d = [c[3] - t[3], (c[4] or 0) - (t[4] or 0), (c[5] or 0) - (t[5] or 0)]
            inner = 0.5 * d[0] * d[0] + 1.5 * d[1] * d[1] + 1.0 * d[2] * d[2]
            near[c[1]] = min(near.get(c[1], (9e9,)), (inner, c[0], d))
        found = []
        for e, (_, c, d) in near.items():
            (u, a), (v, b) = reports[t[1]], reports[e]
            both = np.linalg.norm(u) and np.linalg.norm(v)
            total = np.linalg.norm(u / np.linalg.norm(u) - v / np.linalg.norm(v)) / np.sqrt(2) if both else 1.0
            total += sum(abs(x - y) for x, y in zip(a, b, strict=True) if x is not None and y is not None)
            found.append((total + sum(map(abs, d)), e, c))
        out += [(t[0], t[1], e, c, round(d, 9), i) for i, (d, e, c) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("n", "first", "spread"), [(400, 4, True), (400, 1, True), (60, 32, True), (200, 4, False)])
def test_pruned_search_is_the_whole_search(spark, n, first, spread):
    """With missing scores and vectors, entries without a report, ties, targets with too few neighbours, and no spread in Z."""
    rng = random.Random(n + first)
    schema = "measurement_id int, e int, mt string, logE_std double, Z_std double, A_std double"
    rows = [(i, rng.randrange(80), rng.choice("xyz") if i else "alone", rng.choice([0.5, rng.random()]), float(rng.randint(0, 2)) if spread else None, float(rng.randint(0, 2))) for i in range(n)]
    reports = {e: (np.array([0.0, 0.0, 0.0]) if e % 9 == 0 else np.array([rng.random() for _ in range(3)]), [rng.choice([None, rng.random(), 0.5]), rng.random()]) for e in range(80) if e % 13}
    frame = spark.createDataFrame([(e, v.tolist(), *s) for e, (v, s) in reports.items()], "e int, v array<double>, s1 double, s2 double").select("e", vectors.unit(F.col("v")).alias("unit"), "s1", "s2")
    sides = [spark.createDataFrame([r for r in rows if keep(r[1])], schema).join(frame.select("e"), "e", "left_semi") for keep in (lambda e: e < 8, lambda e: e >= 8)]
    got = knn.search(*sides, frame, ["s1", "s2"], "e", "mt", "measurement_id", 3, first)
    expected = brute_search(rows, reports, 3)
    assert sorted((r.target, r.target_entry, r.entry, r.candidate, round(r.distance, 9), r.rank) for r in got.collect()) == expected and (len(expected) > 20 or n < 100)


def test_pivots_are_of_different_vectors(spark):
    """Equal vectors fill no sample, however many reports have them."""
    rows = [(10 * i + j, v) for i, v in enumerate(([1.0, 0.0], [0.0, 1.0], [-1.0, 0.0])) for j in range(10)]
    found = knn.pivots(spark.createDataFrame(rows, "entry int, unit array<double>"), 8, 5)
    assert sorted(found) == [[-1.0, 0.0], [0.0, 1.0], [1.0, 0.0]]


def test_leaves_under_nodes_are_all_leaves_within(spark):
    """More leaves than lie under one node: the same leaves as by looking at each."""
    rng = np.random.default_rng(1)
    low, high = np.sort(rng.random((2, 500, 2)), axis=0)
    index = metric.Index([["c0"], ["c1"]], np.zeros(511, int), np.zeros(511), rng.permutation(500), np.full(500, 3), low, high)
    rows = spark.createDataFrame([[float(x) for x in v for _ in (0, 1)] for v in rng.random((20, 2))], "c0__lo double, c0__hi double, c1__lo double, c1__hi double")
    for r in rows.select("*", index.near_leaves(30).alias("near"), index.near_leaves(limit=F.lit(0.1)).alias("within")).collect():
        away = sum(np.maximum(np.maximum(r[f"c{j}__lo"] - high[:, j], low[:, j] - r[f"c{j}__hi"]), 0) for j in (0, 1)) * (1 - metric.SLACK)
        assert set(r.within) == set(index.leaves[away <= 0.1].tolist())
        assert len(r.near) == 10 and np.isclose(sorted(away[np.isin(index.leaves, r.near)]), np.sort(away)[:10]).all()


def test_search_of_nothing(spark):
    schema = "measurement_id int, e int, mt string, logE_std double, Z_std double, A_std double"
    none, some = spark.createDataFrame([], schema), spark.createDataFrame([(1, 1, "x", 0.0, 0.0, 0.0)], schema)
    reports = spark.createDataFrame([(1, [1.0])], "e int, unit array<double>")
    for t, c in ((none, none), (some, none), (none, some)):
        assert knn.search(t, c, reports, [], "e", "mt", "measurement_id").collect() == []


def test_leaves_and_boxes(spark):
    rng = np.random.default_rng(0)
    points = rng.random((3000, 4))
    items = spark.createDataFrame([(i, *[float(v) for p in row for v in (p, p + 0.01)]) for i, row in enumerate(points)], "i int, " + ", ".join(f"c{j}__lo double, c{j}__hi double" for j in range(4)))
    index, filed = metric.build(items, [["c0", "c1"], ["c2"], ["c3"]])
    assert len(index.leaves) > 64 and index.counts.sum() == 3000 and filed.groupBy("leaf").count().agg(F.max("count")).first()[0] < 200
    query = [(0, *[float(v) for p in rng.random(4) for v in (p, p)])]
    row = spark.createDataFrame(query, items.schema)
    pairs = row.alias("a").crossJoin(filed.alias("b")).select("b.i", "b.leaf", metric.bound(index.terms).alias("bound")).collect()
    near = row.select(index.near_leaves(50).alias("l")).first().l
    assert 0 < len(near) < 20 and sum(p.leaf in near for p in pairs) >= 50
    within = row.select(index.near_leaves(limit=F.lit(0.6)).alias("l")).first().l
    assert {p.leaf for p in pairs if p.bound <= 0.6} <= set(within) and len(within) < len(index.leaves)


def test_cosine_term(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.6, 0.8]), ([3.0, 4.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0])], "a array<double>, b array<double>")
    got = [r.d for r in df.select(vectors.cosine_term(F.col("a"), F.col("b")).alias("d")).collect()]
    assert math.isclose(got[0], 0.632455532, rel_tol=1e-8) and got[1] == 0.0 and got[2] == 1.0 and got[3] is None


def test_adopt(spark):
    df = spark.createDataFrame([(1, 12.0, None, 1.0), (2, 12.0, 3.0, 3.0), (3, 12.0, None, 1.0)], "i int, Data double, dData double, dData_assumed double")
    p = spark.createDataFrame([(1, 0.5), (2, 0.5)], "target int, prediction double")
    got = [(r.dData_adopted, r.uncertainty_source) for r in knn.adopt(df, p, "i").orderBy("i").collect()]
    assert got == [(6.0, "nlp_imputed"), (3.0, "included"), (1.0, "quantile_imputed")]
    assert knn.adopt(df, p, "i", overwrite_reported=True).where("i = 2").first().dData_adopted == 6.0


def test_standardize_is_sample_based(spark):
    df = spark.createDataFrame([(1.0, 1, 2), (10.0, 2, 4), (100.0, 3, 6)], "Energy double, Z int, A int")
    got = [tuple(round(v, 6) for v in r) for r in knn.standardize(df).select("logE_std", "Z_std", "A_std").collect()]
    assert got == [(-1.0, -1.0, -1.0), (0.0, 0.0, 0.0), (1.0, 1.0, 1.0)]
    assert knn.standardize(df.where(F.lit(False))).collect() == []


def test_gate_weights(spark):
    """The same as gates of the kept sentences, summed; keys without a kept sentence have no row."""
    rows = [(1, "the beam", True), (1, "a target", True), (1, "the beam again", False), (2, "the beam", False), (3, "beam", True), (4, None, True), (None, "beam", True)]
    df, lexicon = spark.createDataFrame(rows, "k int, Text string, keep boolean"), {"b": ["beam"], "t": ["target", "foil"], "none": []}
    got = similarity.gate_weights(df, lexicon, "k", F.col("keep"))
    expected = similarity.gates(df.where("keep"), lexicon).groupBy("k", "category").agg(F.count(F.lit(1)).alias("sentences"), F.sum("gate").alias("weight"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.select(got.columns).collect()), key=repr)
    assert got.count() == 12 and got.where("k = 1 AND category = 't'").first().weight == 1.9


def test_search_over_places_is_the_whole_search(spark):
    """Entries of one Z and A and few kinds of reports: rows of many entries share places and energies, and fill several runs."""
    rng = random.Random(4)
    schema = "measurement_id int, e int, mt string, logE_std double, Z_std double, A_std double"
    kind = {e: (e % 2, float(e % 3), float(e % 2) if e % 5 else 1.0) for e in range(60)}
    rows = []
    for i in range(900):
        e = rng.randrange(60) if i % 3 else rng.randrange(8)
        z = kind[e][1] if e != 11 else float(rng.randint(0, 2))  # one entry is not at one place
        rows.append((i, e, rng.choice("xx" + "y"), rng.choice([rng.random(), rng.randint(0, 4) / 4]), z, kind[e][2]))
    reports = {e: (np.array([[3.0, 4.0], [4.0, 3.0]][e % 2]), [0.5 * (e % 4 == 0)]) for e in range(60)}
    frame = spark.createDataFrame([(e, v.tolist(), *s) for e, (v, s) in reports.items()], "e int, v array<double>, s1 double").select("e", vectors.unit(F.col("v")).alias("unit"), "s1")
    sides = [spark.createDataFrame([r for r in rows if keep(r[1])], schema) for keep in (lambda e: e < 8, lambda e: e >= 8)]
    expected = brute_search(rows, reports, 4)
    for run, together in ((3, 2), (64, 16)):
        knn.RUN, knn.TOGETHER, before = run, together, (knn.RUN, knn.TOGETHER)
        try:
            got = knn.search(*sides, frame, ["s1"], "e", "mt", "measurement_id", 4, 8)
            assert sorted((r.target, r.target_entry, r.entry, r.candidate, round(r.distance, 9), r.rank) for r in got.collect()) == expected and len(expected) > 1000
        finally:
            knn.RUN, knn.TOGETHER = before


def test_all_nearest_rows_are_those_of_given_pairs(spark, monkeypatch):
    """Ties, entries of several cells, ids that are text, missing Z, several blocks, and an entry too large for one."""
    rng = random.Random(6)
    schema = "measurement_id string, e string, mt string, logE_std double, Z_std double, A_std double"
    rows = [(f"m{i}", rng.choice("ABCDEF"), rng.choice("xy"), rng.choice([0.0, 0.5, 1.0, rng.random()]), rng.choice([None, 0.0, 1.0]), float(rng.randint(0, 2))) for i in range(400)]
    t, c = (spark.createDataFrame([r for r in rows if (r[1] in "AB") == own], schema) for own in (True, False))
    pairs = spark.createDataFrame([(a, e) for a in "AB" for e in "CDEF"], "target_entry string, entry string")
    names = ["target", "entry", "candidate", "dlogE", "dZ", "dA"]
    expected = sorted(map(tuple, knn.nearest_rows(t, c, pairs, "e", "mt", "measurement_id").select(names).collect()))
    for asked, held, out, stretch in ((2000, 4000, 100_000, 100_000), (10, 20, 30, 100_000), (10, 20, 30, 25)):
        for name, value in (("ASKED", asked), ("HELD", held), ("OUT", out), ("STRETCH", stretch)):
            monkeypatch.setattr(knn, name, value)
        assert sorted(map(tuple, knn.all_nearest_rows(t, c, "e", "mt", "measurement_id").select(names).collect())) == expected and len(expected) > 400
