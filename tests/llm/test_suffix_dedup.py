from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sparvane.llm import suffix_dedup
from tests.llm.conftest import prose


def slow(texts: list[str], length: int) -> list[tuple]:
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        rest = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def corpus() -> list[str]:
    rng = random.Random(1)
    passages = [prose(30, 100 + k) for k in range(3)]
    texts = [prose(rng.randint(20, 300), k) for k in range(20)]
    for k in range(0, 20, 2):
        at = rng.randrange(len(texts[k]))
        texts[k] = texts[k][:at] + passages[k % 3] + texts[k][at:]
    texts += [texts[1], texts[1][10:], texts[3] + "tail", "head" + texts[3][:-7], texts[5].replace("the", "a", 2)]
    texts += ["x" * 500, "ab" * 200 + "c" + "ab" * 200, passages[0] * 3, "é" * 90, None, "", "short"]
    # all share a stretch, with left and right ends in common by pairs
    core = prose(25, 500)
    texts += [f"{l}{core}{r}" for l in ("one ", "two one ", "x") for r in (" end", " ending", "!")]
    return texts


@pytest.mark.parametrize(("length", "k", "bucket"), [(120, 40, 8192), (60, 20, 3)])
def test_digests_are_brute_force(make, length, k, bucket):
    texts = corpus()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(make(texts), length, k, bucket).collect()}
    expected = dict(enumerate(slow(texts, length)))
    assert got == expected
    assert sum(e[1] > 0 for e in expected.values()) > 15


def test_parts_of_long_texts(monkeypatch, make):
    import numpy as np

    from sparvane.llm.polyhash import Powers

    data = np.frombuffer(prose(2000, 9).encode(), np.uint8)
    whole = suffix_dedup.anchors_of(data, Powers(), 120, 40)
    monkeypatch.setattr(suffix_dedup, "PART", 500)
    parts = suffix_dedup.anchors_of(data, Powers(), 120, 40)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_odd_rows(odd, empty):
    rows = suffix_dedup.digests(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.n_removed == r.n_bytes for r in rows if r.doc_id in (5, 6, 7, 9))
    assert all(r.n_removed == 0 for r in rows if r.doc_id in (0, 1, 2, 3, 4, 8, 10, None))
    assert suffix_dedup.digests(empty).collect() == []


def test_stage_cuts_repeats_and_keeps_columns(make, odd, empty):
    passage = "é".join(prose(60, 900).split(" "))
    texts = [prose(50, 901) + passage + "ß end", prose(50, 902) + passage, prose(50, 903), None]
    out = suffix_dedup.remove_repeats(make(texts), 250, 64)
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].text == prose(50, 901) + "ß end" and rows[0].n_chars == len(rows[0].text)
    assert rows[1].text == prose(50, 902) and rows[2].text == texts[2] and rows[3].text is None
    out = suffix_dedup.remove_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert suffix_dedup.remove_repeats(empty).collect() == []


def colliding() -> tuple[str, str]:
    """Two different strings that every polynomial hash modulo 2**64 with an odd base takes for equal."""
    bits = [bin(i).count("1") % 2 for i in range(1 << 11)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("bucket", [8192, 1])
def test_equal_hashes_of_different_bytes_remove_nothing(make, bucket):
    a, b = colliding()
    powers = suffix_dedup.Powers()
    hashes = [powers.prefix(np.frombuffer(x.encode(), np.uint8))[-1] for x in (a, b)]
    assert hashes[0] == hashes[1]
    rest = prose(60, 7)[:300]
    texts = [a + rest, b + rest, rest + a, rest + b, a + rest + "x", "y" + b + rest]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(make(texts[:4]), 2200, 100, bucket).collect()}
    assert got == dict(enumerate(slow(texts[:4], 2200)))
    assert all(x[1] == 0 for x in got.values())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(make(texts), 2200, 100, bucket).collect()}
    assert got == dict(enumerate(slow(texts, 2200)))


def test_offsets_are_compared_some_at_a_time(make, monkeypatch):
    core = prose(40, 500)
    data = [f"{l}{core}{r}".encode() for l in ("one ", "two one ", "x") for r in (" end", " ending", "!")]
    left = [d.index(core[:40].encode()) + 60 for d in data]
    whole = suffix_dedup.Contexts(data, left, suffix_dedup.Powers(), 120, 40).windows(0, len(data))
    monkeypatch.setattr(suffix_dedup, "STRINGS", 20)
    parts = suffix_dedup.Contexts(data, left, suffix_dedup.Powers(), 120, 40).windows(0, len(data))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True)) and (whole[0] >= 0).all()


def test_sorting_does_not_trust_hashes():
    a, b = colliding()
    a, b = a.encode(), b.encode()
    data = [a + b"1", b + b"1", a + b"2", b + b"2"]
    found = suffix_dedup.Contexts(data, [0] * 4, suffix_dedup.Powers(), 2048, 2048)
    assert found.reach(0, 4, False).tolist() == [2048] * 4
    assert found.extensions(np.array([0, 0]), np.array([1, 2]), False).tolist() == [0, 2048]
