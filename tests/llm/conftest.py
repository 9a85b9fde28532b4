from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def prose(n: int, seed: int) -> str:
    """n invented words in sentences."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        w = "".join(rng.choice(["an", "er", "th", "on", "ing", "re", "ti", "le", "sh", "ou"]) for _ in range(rng.randint(1, 4)))
        out.append(w.capitalize() if i % 9 == 0 else rng.choice(["the", "of", "and", w, w, w]) + ("." if i % 9 == 8 else ""))
    return " ".join(out)


@pytest.fixture(scope="session")
def make(spark):
    def docs(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in zip(ids, texts, strict=True)], DOCS)

    return docs


@pytest.fixture(scope="session")
def odd(make):
    """Nulls in every column, empty and long texts, repeated rows, repeated ids, ties, other writing."""
    long = prose(6000, 1)
    texts = [None, "", " \n\t ", "a", "a b c", long, long, prose(80, 2), prose(80, 2), "ß É \U0001f600 ́e", "x" * 3000, prose(120, 3), prose(120, 4), "a", "퟿ end"]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 7, 8, 9, None, 10, 3, None]
    df = make(texts, ids)
    for name in ("fp", "key", "th", "component_id", "__place", "data", "size", "pos", "node", "features"):
        df = df.withColumn(name, df.lang)
    return df


@pytest.fixture(scope="session")
def empty(make):
    return make([])
