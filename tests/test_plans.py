from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from sparvane.plans import imputation, ingest, queries, reports
from sparvane.sources import ace, readers, sinks
from sparvane.streaming import incremental

ROWS = [
    # Reaction, Projectile, En, dEn, Sig, dSig, MT, DatasetID, Entry, Subent, Year, Ini, Author, Target, code
    ("N,TOT", "n", 2.0, 0.1, 10.0, 1.0, 1, "d1", "E1", "E1001", 1990, "A.", "B", "Fe-56", "c"),
    ("N,TOT", "n", 1.0, 0.1, 20.0, None, 1, "d1", "E1", "E1001", 1990, "A.", "B", "Fe-56", "c"),
    ("N,TOT", "n", 3.0, 0.1, 30.0, 6.0, 1, "d2", "E2", "E2001", 1991, "C.", "D", "Fe-56", "c"),
    ("N,G", "n", 3.0, 0.1, 5.0, float("nan"), 102, "d3", "E3", "E3001", 1992, "E.", "F", "U-238", "c"),
    ("N,G", "n", 3.0, 0.1, 5.0, 1.0, 102, "d3", "E3", "E3001", 1992, "E.", "F", "U-0", "c"),
    ("P,EL", "p", 3.0, 0.1, 5.0, 1.0, 2, "d4", "E4", "E4001", 1993, "G.", "H", "U-238", "c"),
]
CURVES = [("endf8", 26, 56, 1, 1.0, 10.0), ("endf8", 26, 56, 1, 3.0, 30.0)]


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], T.StructType([*readers.SOURCE.fields, T.StructField("measurement_id", T.LongType())]))


@pytest.fixture(scope="module")
def curves(spark):
    return spark.createDataFrame(CURVES, readers.CURVES)


def test_measurements(source, curves):
    df = ingest.measurements(source, curves)
    got = {r.measurement_id: r for r in df.collect()}
    assert sorted(got) == [0, 1, 2, 3]  # natural targets and other channels are out
    fraction = np.quantile([0.1, 0.2, 0.2, 0.2], 0.9)
    # endf7-1 has no curve: in the second pass no row is complete, so the global fraction counts
    assert math.isclose(got[1]["dData_assumed"], 20 * fraction) and got[1]["endf7-1"] is None
    assert got[1]["endf8"] == 10.0 and math.isclose(got[1]["endf8_chi_squared"], 100 / (20 * fraction)) and got[1]["endf8_relative_error"] == 100.0
    assert got[3]["endf8"] is None and math.isclose(got[3]["dData_assumed"], 5 * fraction)
    only = ingest.measurements(source, curves, gate="uncertainty_only")
    assert math.isclose(only.where("measurement_id = 1").first()["dData_assumed"], 20 * np.quantile([0.1, 0.2], 0.9))


def test_summary_and_rollups(source, curves):
    got = {(r.Z, r.Reaction): (r.A, r.Symbol, r.Projectile, r.MT, r["has_endf7-1"], r["has_endf8"]) for r in ingest.channel_summary(source, curves).collect()}
    assert got == {(26, "N,TOT"): (56, "Fe", "n", 1, False, True), (92, "N,G"): (238, "U", "n", 102, False, False)}
    m = ingest.measurements(source, curves)
    assert {r.EXFOR_Subentry: r.num_measurements for r in ingest.subentries(m).collect()} == {"E1001": 2, "E2001": 1, "E3001": 1}
    assert {r.EXFOR_Entry: (r.MT_Codes, r.Uncertainty_Complete) for r in ingest.entries(m).collect()} == {"E1": ("1", False), "E2": ("1", True), "E3": ("102", False)}


def test_grids(curves):
    got = ingest.curve_grids(curves, points=13).orderBy("energy").collect()
    assert len(got) == 13 and got[5].xs == 10.0 and got[0].xs == 0.0  # 1 eV is the sixth of thirteen


def test_adopted(spark, source, curves):
    m = ingest.measurements(source, curves)
    r = spark.createDataFrame([("E1", [1.0, 0.0], 0.5), ("E2", [0.6, 0.8], 0.7)], "EXFOR_Entry string, mean_embedding array<double>, s double")
    got = {x.measurement_id: (x.dData_adopted, x.uncertainty_source) for x in imputation.adopted(m, ingest.entries(m), r, ["s"]).collect()}
    assert math.isclose(got[1][0], 0.2 * 20) and got[1][1] == "nlp_imputed"
    assert got[0] == (1.0, "included") and got[3][1] == "quantile_imputed"


def test_report_features(spark):
    r = spark.createDataFrame([("E1", "The background was measured and subtracted carefully.\nreferences\nAuthor"), ("E2", "x")], "report_id string, text string")
    lexicon = spark.createDataFrame([("background_treatment", ["background was measured"]), ("dead_time", ["dead time was corrected"])], "category string, sentences array<string>")
    wide, found = reports.report_features(r, lexicon, {"background_treatment": ["background"], "dead_time": ["dead time"]})
    rows = wide.collect()
    assert [x.EXFOR_Entry for x in rows] == ["E1"] and found.count() == 1
    assert rows[0].background_treatment_max_sim > rows[0].dead_time_max_sim and len(rows[0].mean_embedding) == 256


def test_files(spark, source, curves, tmp_path):
    sinks.write_by_channel(source, f"{tmp_path}/m", ["Target", "MT"])
    assert spark.read.parquet(f"{tmp_path}/m").count() == len(ROWS)
    assert readers.measurements(spark, f"{tmp_path}/m").columns == [f.name for f in readers.SOURCE]
    sinks.grid_csv(curves, f"{tmp_path}/g")
    assert spark.read.option("header", True).csv(f"{tmp_path}/g").count() == 2
    sinks.append(source, f"{tmp_path}/m")
    assert spark.read.parquet(f"{tmp_path}/m").count() == 2 * len(ROWS)
    assert sinks.subset(source, Target="Fe-56", MT=1).count() == 3
    (tmp_path / "lexicon.json").write_text('{"a": {"sentences": ["x y"], "keywords": ["x"]}, "b": {"sentences": [], "keywords": []}}')
    assert {x.category: x.keywords for x in readers.lexicon(spark, f"{tmp_path}/lexicon.json").collect()} == {"a": ["x"], "b": []}
    folder = tmp_path / "pdfs"
    folder.mkdir()
    for name in ("1.PDF", "2.v1.pdf", "pdfs_here"):
        (folder / name).write_bytes(b"text of " + name.encode())
    files = readers.reports(readers.pdf_files(spark, str(folder)), lambda b: b.decode())
    assert {x.report_id: x.text for x in files.collect()} == {"1": "text of 1.PDF", "2": "text of 2.v1.pdf"}
    decoded = readers.curves_from_files(spark, str(folder), lambda path, b: [(path.rsplit("/", 1)[-1], 1, 1, 1, 0.5, float(len(b)))])
    assert decoded.count() == 3


def test_blobs(spark):
    df = spark.createDataFrame([([1.5, -2.0],), (None,)], "v array<float>")
    back = df.select(sinks.blob_to_vector(sinks.vector_to_blob(df.v)).alias("v"))
    assert [x.v for x in back.collect()] == [[1.5, -2.0], None]


def test_row_ids(spark):
    df = readers.with_row_ids(spark.createDataFrame([(3,), (1,), (2,)], "x int"))
    assert [(x.x, x.measurement_id) for x in df.orderBy("measurement_id").collect()] == [(1, 0), (2, 1), (3, 2)]
    rows = spark.createDataFrame([(i * 7919 % 1000 // 3, i % 5) for i in range(1000)], "x int, y int")
    ids = lambda n: sorted(tuple(r) for r in readers.with_row_ids(rows.repartition(n), ["y"]).collect())
    assert ids(1) == ids(7) and [r[2] for r in sorted(ids(7), key=lambda r: (r[1], r[0], r[2]))] == list(range(1000))
    assert readers.with_row_ids(rows.limit(0)).count() == 0


def ace_table(za, xss, nes, ntr, places, new=False):
    numbers = lambda xs, width, each: "".join("".join(f"{x:>{width}}" for x in xs[i : i + each]) + "\n" for i in range(0, len(xs), each))
    jxs = [places.get(i, 0) for i in range(1, 33)]
    head = f"2.0.0 {za}.800nc made\n 55.45 2.5E-08 2026-01-01 2\none\ntwo\n" if new else f" {za}.80c   55.454400  2.5301e-08   01/01/26\ncomment\n"
    return head + "  0 0.0\n" * 4 + numbers([len(xss), za, nes, ntr, *[0] * 12], 9, 8) + numbers(jxs, 9, 8) + numbers([f"{x:.11E}" for x in xss], 20, 4)


def test_ace(spark, tmp_path):
    energy = [1e-11, 1.0, 2.0, 3.0]
    esz = [*energy, 10, 11, 12, 13, 1, 1, 1, 1, 9, 8, 7, 6, 0, 0, 0, 0]
    # three reactions: capture everywhere, two inelastic levels from the second and the third energy on
    xss = [*esz, 102, 51, 52, 1, 7, 12, 1, 4, 0.5, 0.25, 0.125, 0.0625, 2, 3, 0.0, 2, 3, 3, 2, 0.5, 0.75]
    places = {1: 1, 3: 21, 6: 24, 7: 27}
    folder = tmp_path / "endf8"
    folder.mkdir()
    (folder / "two.ace").write_text(ace_table(26056, xss, 4, 3, places) + ace_table(95642, esz, 4, 0, {1: 1}, new=True))
    got = {}
    for r in readers.curves_from_files(spark, str(folder), ace.decode).collect():
        got.setdefault((r.evaluation, r.Z, r.A, r.MT), []).append((r.energy, r.xs))
    ev = [e * 1e6 for e in energy]
    assert got["endf8", 26, 56, 1] == list(zip(ev, [10, 11, 12, 13], strict=True)) and got["endf8", 26, 56, 2] == list(zip(ev, [9, 8, 7, 6], strict=True))
    assert got["endf8", 26, 56, 102] == list(zip(ev, [0.5, 0.25, 0.125, 0.0625], strict=True))
    assert got["endf8", 26, 56, 52] == list(zip(ev[2:], [0.5, 0.75], strict=True))
    assert got["endf8", 26, 56, 4] == [(ev[1], 0.0), (ev[2], 2.5), (ev[3], 3.75)]
    assert {k[1:3] for k in got if k[0] == "endf8"} == {(26, 56), (95, 242)} and len(got) == 6 + 2


def test_curve_from_zero(spark):
    grid = spark.createDataFrame([("endf8", 1, 1, 1, 0.0, 5.0), ("endf8", 1, 1, 1, 1.0, 7.0)], readers.CURVES)
    got = [r.xs for r in ingest.curve_grids(grid, points=13).orderBy("energy").collect()]  # 1e-5, 1e-4 and so on
    assert math.isclose(got[0], 5.00002) and math.isclose(got[4], 5.2) and got[6] == 0.0


def test_model_and_splitter(spark, tmp_path):
    r = spark.createDataFrame([("E1", "first one of the longer sentences|second one of the longer sentences"), ("E2", None)], "report_id string, text string")
    found = reports.sentences(r, splitter=lambda t: t.split("|"))
    assert sorted(tuple(x) for x in found.collect()) == [("E1", 1, "first one of the longer sentences"), ("E1", 2, "second one of the longer sentences")]
    marks = str(tmp_path)

    def load():
        import os
        import tempfile

        os.close(tempfile.mkstemp(dir=marks)[0])

        def encode(texts, most_tokens):
            assert len(texts) <= 32
            n = max((len(t.split()) for t in texts), default=0)
            mask = np.array([[i < min(len(t.split()), most_tokens) for i in range(n)] for t in texts])
            hidden = np.array([[[float(len(t.split()[i])) if i < len(t.split()) else 99.0, 1.0] for i in range(n)] for t in texts]).reshape(len(texts), n, 2)
            return hidden, mask

        return encode

    df = spark.createDataFrame([(i, " ".join("a" * (j + 1) for j in range(i % 4))) for i in range(100)] + [(100, None)], "i int, t string").coalesce(1)
    got = {x.i: x.v for x in df.select("i", reports.embed_by_model(df.t, load).alias("v")).collect()}
    assert got[100] == [0.0, 0.0] and got[0] == [0.0, 0.0] and got[3] == [2.0, 1.0] and got[2] == [1.5, 1.0]
    assert len(list(tmp_path.iterdir())) == 1  # loaded once for the task, not once a batch


def test_without_report(spark):
    df = spark.createDataFrame([("E1",), ("E2",), ("E2",), (None,)], "EXFOR_Entry string")
    got = imputation.without_report(df, spark.createDataFrame([("E1",), ("E1",), (None,)], "EXFOR_Entry string"))
    assert sorted(str(x.EXFOR_Entry) for x in got.collect()) == ["E2", "E2", "None"]


def test_append_stream(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    df.write.parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second run finds nothing new
        incremental.append_stream(spark, f"{tmp_path}/in", df.schema, lambda b: b.where("x > 1"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert [x.x for x in incremental.appended(spark, f"{tmp_path}/out").collect()] == [2]


def test_all_pairs_of_reports_multiply_no_vectors(spark):
    """Equal vectors, one of zeros and a missing one; the same distances as of given pairs."""
    from sparvane.operators import knn
    from sparvane.plans import imputation

    rows = [(i, v, i / 8) for i, v in enumerate([[3.0, 4.0], [3.0, 4.0], [0.0, 0.0], None, [1.0, 0.0], [3.0, 4.0], [0.0, 0.0], [0.0, 2.0]])]
    reports = spark.createDataFrame(rows, "EXFOR_Entry int, mean_embedding array<double>, s double")
    entries = spark.createDataFrame([(i, i >= 4) for i in range(8)], "EXFOR_Entry int, Uncertainty_Complete boolean")
    found = imputation.report_pairs(reports, entries, ["s"])
    once = imputation.report_vectors(reports, ["s"]).withColumnRenamed("EXFOR_Entry", "entry")
    expected = knn.report_distances(found, once, ["s"])
    assert found.count() == 16 and sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    assert "unit" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_keyword_gate_computes_each_rule_once(spark):
    """The filter on sentences is not pushed below the columns that it is made of, which would compute each again for every rule."""
    df = queries.keyword_gate(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\P{L}+") == 1 and plan.count(r"regexp_replace(s#") == 1
