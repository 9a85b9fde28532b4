from __future__ import annotations

import random

from pyspark.sql import functions as F

from sparvane.functions import text as rules
from sparvane.operators import boundaries
from sparvane.plans import reports

#: Sentences whose ends are known.
KNOWN = [
    "The yield is shown in Fig. 3 for all samples.",
    "Smith et al. measured the cross section at 2.5 MeV.",
    "Corrections by J. R. Taylor were applied (see Ref. 12 and Eq. 4).",
    "The detector was placed approx. 30 cm from the target.",
    "Was the background subtracted?",
    "It was, e.g. by the method of Ref. 7 below.",
    "The uncertainty is 0.5 per cent.",
    "A second run used the same beam!",
    "Results of Brown et al. agree with Fig. 2 within errors.",
    "The samples below the target gave errors of a few MeV or per cent in all.",
]


def corpus(n: int) -> list[tuple[int, list[str]]]:
    rng = random.Random(0)
    return [(i, [rng.choice(KNOWN) for _ in range(rng.randint(3, 12))]) for i in range(n)]


def ends(sentences: list[str]) -> set[int]:
    """Words after which a sentence ends."""
    out, at = set(), 0
    for s in sentences:
        at += len(s.split())
        out.add(at)
    return out


def test_better_than_the_rule_on_known_boundaries(spark):
    made = corpus(300)
    df = spark.createDataFrame([(i, " ".join(s)) for i, s in made], "i int, t string").repartition(4)
    learned = {}
    for r in boundaries.sentences(df, "i", F.col("t")).orderBy("i", "number").collect():
        learned.setdefault(r.i, []).append(r.sentence)
    ruled = {r.i: r.s for r in df.select("i", rules.sentences(F.col("t")).alias("s")).collect()}
    wrong = {name: sum(len(ends(found[i]) ^ ends(s)) for i, s in made) for name, found in (("learned", learned), ("ruled", ruled))}
    total = sum(len(s) for _, s in made)
    assert wrong["ruled"] > 0.5 * total and wrong["learned"] < 0.02 * total
    assert all(" ".join(learned[i]) == " ".join(s) for i, s in made)


def test_abbreviations(spark):
    df = spark.createDataFrame([(i, " ".join(s)) for i, s in corpus(300)], "i int, t string")
    found = {r.type for r in boundaries.abbreviations(boundaries.words(df, "i", F.col("t"))).collect()}
    assert {"fig", "al", "ref", "eq", "e.g"} <= found and not found & {"samples", "below", "cent", "errors", "target"}


def test_odd_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, "one"), (5, "a.  b\n(c!) d"), (6, "... !!! ?")], "i int, t string")
    got = {(r.i, r.number): r.sentence for r in boundaries.sentences(df, "i", F.col("t")).collect()}
    assert {i for i, _ in got} == {4, 5, 6} and got[4, 1] == "one"
    assert " ".join(got[5, k] for k in sorted(n for i, n in got if i == 5)) == "a. b (c!) d"
    assert boundaries.sentences(df.limit(0), "i", F.col("t")).collect() == []


def test_reports_by_learned_boundaries(spark):
    rows = [(i, " ".join(s)) for i, s in corpus(200)]
    found = reports.sentences(spark.createDataFrame(rows, "report_id int, text string"), learned=True)
    texts = [r.Text for r in found.where("EXFOR_Entry = 5").orderBy("Sentence_Number").collect()]
    kept = [s.lower() for s in corpus(200)[5][1] if len(s) >= rules.LEAST_CHARS]
    assert texts == kept


def test_words_do_not_move_to_meet_abbreviations(spark):
    """Abbreviations go to the words, whatever Spark takes their size for."""
    df = spark.createDataFrame([(1, "It is in Fig. 3 of it. We saw Fig. 4 there.")], "k long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = boundaries.marked(boundaries.words(df, "k", F.col("text")))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan
