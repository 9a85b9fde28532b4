from __future__ import annotations

import random

import numpy as np
import pytest

from sparvane.llm import decontaminate as d
from tests.llm.conftest import prose


def slow_alignment(a, b) -> int:
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (d.MATCH if a[i - 1] == b[j - 1] else d.MISMATCH), h[i - 1, j] + d.GAP, h[i, j - 1] + d.GAP)
    return int(h.max())


def test_alignment_is_the_textbooks():
    rng = random.Random(0)
    for _ in range(100):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(1, 12))] for _ in range(2))
        assert d.smith_waterman(np.array(a), np.array(b))[0] == slow_alignment(a, b)


def edited(text: str, share: float, seed: int) -> str:
    rng = random.Random(seed)
    out = []
    for w in text.split():
        x = rng.random()
        if x < share / 3:
            continue
        out.append("other" if x < share * 2 / 3 else w)
        if share * 2 / 3 <= x < share:
            out.append("more")
    return " ".join(out)


@pytest.mark.parametrize("block_bytes", [d.BLOCK_BYTES, 400])
def test_leaks(spark, make, block_bytes):
    items = [prose(40, 1000 + k) for k in range(6)] + ["two words", None, "", "..."]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [prose(200, k) for k in range(10)]
    texts[1] += " " + items[0]
    texts[2] = texts[2][:300] + items[1].upper().replace(" ", ", ") + texts[2][300:]
    texts[3] += edited(items[2], 0.2, 1) + prose(50, 77)
    texts[4] = items[3] + " " + items[4]
    texts[5] += " two words"
    texts[6] += " " + " ".join(items[5].split()[:8])  # a fifth of an item is none
    for k in range(7, 10):
        texts[k] += items[0]  # often copied
    df = make(texts)
    got = {(r.doc_id, r.item_id): r for r in d.leaks(df, bench, block_bytes=block_bytes).collect()}
    assert set(got) == {(1, 0), (2, 1), (3, 2), (4, 3), (4, 4), (5, 6), (7, 0), (8, 0), (9, 0)}
    assert got[1, 0].score == 1.0 and 0.4 <= got[3, 2].score < 1
    words = d.words(texts[1].encode())
    assert words[got[1, 0].first_word : got[1, 0].last_word + 1] == d.words(items[0].encode())
    kept = d.clean(df, bench, block_bytes=block_bytes)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 6] and kept.columns == df.columns


def test_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, prose(80, 2))], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in d.leaks(odd, bench).collect()) == [(7, 1), (7, 1)]
    kept = d.clean(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2
    assert d.leaks(empty, bench).collect() == [] and d.clean(empty, bench).collect() == []
    assert d.leaks(odd, bench.limit(0)).collect() == [] and d.clean(odd, bench.limit(0)).count() == odd.count()
