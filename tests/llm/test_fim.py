from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from sparvane.llm import fim
from tests.llm.conftest import prose


def slow(doc_id, text):
    """By decoded characters."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def mixed(rng, n):
    return "".join(rng.choice(rng.choice(["abc <", "éß", "日本", "\U0001f600\U0001f468", "PSM>"])) * rng.choice([1, 1, 5]) for _ in range(n))


def test_runs_say_where_units_end(monkeypatch):
    rng = random.Random(0)
    for stretch in (1 << 22, 7, 1):
        monkeypatch.setattr(fim, "STRETCH", stretch)
        for _ in range(40):
            texts = [mixed(rng, rng.choice([0, 1, 3, 30])) for _ in range(rng.randint(0, 5))]
            data = "".join(texts).encode()
            offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
            runs = fim.Runs(np.frombuffer(data, np.uint8), offsets)
            whole = "".join(texts)
            assert runs.total == len(whole)
            assert runs.before.tolist() == np.cumsum([0] + [len(t) for t in texts]).tolist()
            assert runs.byte(np.arange(len(whole) + 1)).tolist() == [len(whole[:k].encode()) for k in range(len(whole) + 1)]
            assert len(runs.units) == sum(k == 0 or len(whole[k].encode()) != len(whole[k - 1].encode()) for k in range(len(whole)))


def test_forms_and_restoration(make):
    rng = random.Random(1)
    texts = [mixed(rng, rng.choice([0, 1, 2, 8, 60])) for _ in range(600)] + ["<P>", "a<S>b", "<M", "<", "x<P", "<<P", prose(9000, 2) + "é" * 5000]
    ids = [rng.randint(-(10**12), 10**12) for _ in texts]
    made = fim.transform(make(texts, ids))
    rows = made.withColumn("back", fim.restored()).collect()
    got = sorted((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows)
    assert got == sorted(slow(i, t) for i, t in zip(ids, texts, strict=True))
    assert {(r.doc_id, r.back) for r in rows} == set(zip(ids, texts, strict=True))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_odd_rows(odd, empty):
    rows = odd.collect()
    expected = [slow(r.doc_id, r.text) for r in rows]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = [(*e[:5], digest(e[5]), digest(r.text or "")) for e, r in zip(expected, rows, strict=True)]
    assert sorted(map(tuple, fim.digests(odd).collect()), key=repr) == sorted(expected, key=repr)
    assert fim.digests(empty).collect() == []


def test_columns_and_shares(make):
    docs = make([prose(5, i) for i in range(400)]).withColumn("N", F.lit("x")).withColumn("output", F.lit(1)).withColumn("form", F.lit(2))
    made = fim.transform(docs, seed="other", transformed=50, suffix_first=50)
    assert made.columns == ["doc_id", "lang", "source", "n_chars", "n", "form", "prefix_chars", "middle_chars", "output"]
    count = {r.form: r["count"] for r in made.groupBy("form").count().collect()}
    assert 150 < count["plain"] < 250 and 60 < count["psm"] < 140 and 60 < count["spm"] < 140
    assert fim.transform(docs, transformed=0).where("form <> 'plain'").count() == 0
