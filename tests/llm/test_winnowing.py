from __future__ import annotations

import hashlib

import numpy as np

from sparvane.llm import winnowing
from sparvane.llm.polyhash import Powers, minimizers, window_argmin
from tests.llm.conftest import prose


def test_rightmost_minimum_of_each_window():
    rng = np.random.default_rng(0)
    for n, w in ((1, 4), (4, 4), (50, 4), (300, 64), (65, 64)):
        h = rng.integers(0, 6, n).astype(np.uint64) << np.uint64(60)
        expected = [max(range(i, i + min(w, n)), key=lambda j: (-int(h[j]), j)) for i in range(n - min(w, n) + 1)]
        assert window_argmin(h, w).tolist() == expected
        assert minimizers(h, w, step=7).tolist() == sorted(set(expected))


def test_equal_grams_have_equal_hashes():
    p = Powers()
    a = np.frombuffer(b"xxhello worldyy", np.uint8)
    h = p.grams(a, 5)
    assert h[2] == p.grams(np.frombuffer(b"hello", np.uint8), 5)[0] and len(set(h.tolist())) == len(h)


def test_shared_stretches_share_a_hash():
    common = prose(40, 5)[: winnowing.K + winnowing.WINDOW - 1]
    a, b = winnowing.winnow(prose(50, 6) + common, Powers()), winnowing.winnow(common + prose(60, 7), Powers())
    assert set(a[0]) & set(b[0])


def test_half_of_a_short_text_is_found():
    for n in range(2 * winnowing.K, 300):
        text = prose(120, n)[:n]
        for following in (prose(120, 900 + n), "end"):
            other = winnowing.edited(text, following)
            sets = [np.unique(winnowing.winnow(t, Powers())[0]) for t in (text, other)]
            assert winnowing.likeness(*sets) > 0, n


def test_half_of_a_text_of_fifty_is_found():
    text, following = prose(120, 1)[:50], prose(120, 2)
    assert set(winnowing.winnow(text, Powers())[0]) & set(winnowing.winnow(winnowing.edited(text, following), Powers())[0])


def test_parts_of_long_texts(monkeypatch):
    text = prose(3000, 8)
    whole = winnowing.winnow(text, Powers())
    monkeypatch.setattr(winnowing, "PART", 700)
    part = winnowing.winnow(text, Powers())
    assert (whole[0] == part[0]).all() and (whole[1] == part[1]).all()


def slow(ids, texts):
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i] or ""))
    out = []
    for k, i in enumerate(order):
        text, after = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        other = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        marks = [winnowing.winnow(t, Powers()) for t in (text, other, after)]
        sets = [np.unique(m[0]) for m in marks]
        out.append((ids[i], len(text), hashlib.sha256(other.encode()).hexdigest(), winnowing.encoded(*marks[0]), winnowing.encoded(*marks[1]), winnowing.likeness(sets[0], sets[1]), winnowing.likeness(sets[0], sets[2])))
    return sorted(out, key=repr)


def test_followers_over_ranges(make):
    texts = [prose(10 + i % 50, i % 30) + "é" * (i % 3) for i in range(150)]
    ids = [(i * 7919) % 1000 for i in range(150)]
    rows = winnowing.fingerprints(make(texts, ids).repartition(6)).collect()
    assert sorted(map(tuple, rows), key=repr) == slow(ids, texts)


def test_odd_rows(odd, make, empty):
    rows = odd.collect()
    got = winnowing.fingerprints(odd).collect()
    assert sorted(map(tuple, got), key=repr) == slow([r.doc_id for r in rows], [r.text for r in rows])
    one = winnowing.fingerprints(make(["abc"])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"aba").hexdigest() and one[0].near_next == 1.0
    assert winnowing.fingerprints(empty).collect() == []
    nobody = winnowing.fingerprints(make(["a", "b"], [None, None])).collect()
    assert len(nobody) == 2
