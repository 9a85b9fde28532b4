from __future__ import annotations

import random
import string
import unicodedata

import pytest
from pyspark.sql import functions as F

from sparvane.functions import text


def one(spark, f, *values):
    df = spark.createDataFrame([(v,) for v in values], "s string").coalesce(1)
    return [r[0] for r in df.select(f(F.col("s"))).collect()]


def test_normalize(spark):
    assert one(spark, text.normalize, "cali-\nbration\n\n\nx  y", "a\0b", None) == ["calibration\nx y", "a b", None]


def test_cut_references(spark):
    assert one(spark, text.cut_references, "body\n REFERENCES \n[1] A", "body references inline", "a\nBibliography\nb\nreferences\nc") == ["body", "body references inline", "a"]


def test_drop_artifacts(spark):
    lines = "12\nabcd\n  abcde\nDOI: 10.1/x\nReceived: May"
    assert one(spark, text.drop_artifacts, lines, "", "12345\r\nlonger line") == ["  abcde", "", "12345\nlonger line"]


@pytest.mark.parametrize(
    ("sentence", "bad"),
    [
        ("a" * 24, True),
        ("a" * 25, False),
        ("1234567890 1234567890 abcdef ghi", True),
        ("a = b + c and d = e + f when g = h", True),
        ("a = b + c and d = e + f when g is h", False),
        ("[12] smith measured the total cross section", False),
        ("[12] Smith measured the total cross section", True),
        ("... ,,, ;;; !!! abc def ???? ++ -- (((", True),
        (" " * 40, True),
        (None, True),
    ],
)
def test_bad_sentence(spark, sentence, bad):
    assert one(spark, text.bad_sentence, sentence) == [bad]


def test_bad_sentence_at_the_limits(spark):
    """The filter's shortcuts change nothing: by counting, on sentences about all of its limits."""
    rng = random.Random(1)
    marks = ["a", "é", "7", "²", ",", "=", "×", "ⅷ", " "]
    sentences = ["".join(rng.choices(marks, [9, *(rng.choice([0, 1, 5, 9]) / (8 if x in "=×" else 1) for x in marks[1:])], k=rng.choice([26, 40, 60]))) for _ in range(2000)]
    kind = lambda s, *c: sum(unicodedata.category(x).startswith(c) for x in s)

    def bad(sentence):
        s = sentence.strip()
        n = len(s.replace(" ", ""))
        punctuation, operators = sum(x in string.punctuation for x in s), sum(x in text.OPERATORS[1:-1] for x in s)
        return len(s) < 25 or n == 0 or kind(s, "L") / n < 0.35 or kind(s, "Nd", "No") / n > 0.45 or punctuation / n > 0.45 or operators >= 3

    expected = [bad(s) for s in sentences]
    assert one(spark, text.bad_sentence, *sentences) == expected and 200 < sum(expected) < 1800
    # the rule ends sentences at marks that these have none of, so each is one
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sentences)], "i long, s string")
    rows = {r.i: r.bad for r in text.judged_sentences(df, ["i"], F.col("s")).collect()}
    tidied = dict(enumerate(" ".join(s.split()) for s in sentences))
    assert rows == {i: bad(s) for i, s in tidied.items() if s}


def test_sentences(spark):
    got = one(spark, text.sentences, "One two. Three?  Four!\nFive 1.5 U-235", "", "   ")
    assert got == [["One two.", "Three?", "Four!", "Five 1.5 U-235"], [], []]


def test_reference_rule_is_inert_after_lower_case(spark):
    assert one(spark, text.clean_sentences, "[12] Smith measured the total cross section.") == [["[12] smith measured the total cross section."]]


def test_keyword_gate(spark):
    words = ["background", "beam-off", "h(n,n)"]
    gate = lambda c: text.keyword_gate(c, words)
    assert one(spark, gate, "beam-off runs", "the backgrounds", "the h(n,n) x", "h(n,n)p", "BACKGROUND") == [1.0, 0.9, 0.9, 1.0, 1.0]
    assert one(spark, lambda c: text.keyword_gate(c, []), "x") == [0.9]
    assert one(spark, gate, None, "", "Beam-Off", "beam off", "xbackground background") == [0.9, 0.9, 1.0, 0.9, 1.0]


def test_file_id(spark):
    assert one(spark, text.file_id, "13632.v2.pdf", "x") == ["13632", "x"]
