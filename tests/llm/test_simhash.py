from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from sparvane.llm import simhash
from sparvane.llm.common import grouped
from sparvane.llm.components import components
from tests.llm.conftest import prose


def slow_fingerprint(text: str, n: int = 4) -> int:
    words = text.encode().lower().split()
    parts = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps: list[int], ids: list[int]) -> list[int]:
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    low = {}
    for a in range(len(fps)):
        low[find(a)] = min(low.get(find(a), 1 << 70), ids[a])
    return [low[find(a)] for a in range(len(fps))]


def test_fingerprint():
    for t in ("", "one", "one two three", "One  TWO\nthree four five É", prose(300, 3), "a " * 50):
        assert simhash.fingerprint(t.encode()) == slow_fingerprint(t)


def edited(text: str, n: int, seed: int) -> str:
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(1000)}"
    return " ".join(words)


@pytest.mark.parametrize("bucket", [1024, 3])
def test_components_are_brute_force(make, bucket):
    base = [prose(400, s) for s in range(3)]
    texts = [edited(b, n, 10 * n + k) for b in base for n in (0, 1, 2, 3) for k in range(4)] + ["", " ", "x y"]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(make(texts), max_bucket=bucket).collect()}
    fps = [slow_fingerprint(t) for t in texts]
    expected = slow_components(fps, list(range(len(texts))))
    assert got == {i: (f"{f:016x}", c) for i, (f, c) in enumerate(zip(fps, expected, strict=True))}
    assert len(set(expected)) < len(texts) - 3


@pytest.mark.parametrize("bucket", [1024, 2])
def test_links_find_all_near_fingerprints(spark, bucket):
    rng = random.Random(7)
    fps = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(8):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 6)):
                y ^= 1 << b
            fps.add(y)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(0, s) for s in signed] + [(5, s) for s in signed[::2]], "t int, fp long")
    found = simhash.links(nodes, max_bucket=bucket)
    assert {r.t for r in found.select("t").distinct().collect()} == {0, 5}
    roots = {r.node: r.root for r in components(found.where("t = 0").select("u", "v")).collect()}
    expected = slow_components(fps, signed)
    assert [roots.get(s, s) for s in signed] == expected


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(200, i) for i in range(201, 240)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {x: find(x) for a, b in pairs if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_grouped_cuts_at_keys():
    keys = [1, 1, 2, 3, 3, 3, 3, 3, 4, 4, 5]
    for size in (1, 2, 3, 4, 11):
        batches = [pa.RecordBatch.from_pydict({"k": pa.array(keys[i : i + size], pa.int64())}) for i in range(0, len(keys), size)]
        small, large = [], []
        for rows, over in grouped(iter(batches), "k", 3):
            (large if over else small).append(rows.column("k").to_pylist())
        assert sorted(sum(large, [])) == [3] * 5
        assert sorted(sum(small, [])) == [1, 1, 2, 4, 4, 5]
        for k in (1, 2, 4, 5):
            assert sum(k in part for part in small) == 1


def test_odd_rows(odd, empty):
    rows = simhash.simhash_components(odd).collect()
    assert len(rows) == odd.count()
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in zero} == {0, 1, 2} and {r.component_id for r in zero} == {0}
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert simhash.simhash_components(empty).collect() == []


def test_stage_finds_near_copies_and_keeps_the_rest(make, odd, empty):
    base = [prose(250, s) for s in range(20, 32)]
    near = [edited(b, 4, k) for k, b in enumerate(base)]
    df = make(base + near + [base[0]])
    kept = simhash.without_near_duplicates(df)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(12)) and kept.columns == df.columns
    kept = simhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [0, 3, 4, 5, 7, 8, 9, 10]
    assert kept.where("doc_id is null").count() == 2
    given = {tuple(r) for r in odd.collect()}
    assert all(tuple(r) in given for r in kept.collect())  # every column keeps its values, whatever its name
    assert simhash.without_near_duplicates(empty).collect() == []


def test_ball():
    masks = simhash._ball(4).view(np.uint64)
    assert len(masks) == 2081 == len(set(masks.tolist())) and np.bitwise_count(masks).max() == 2


def five_words(text: str) -> set[bytes]:
    w = text.encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(len(w) - 4)} or ({b" ".join(w)} if w else set())


def jaccard(a: set, b: set) -> float:
    return 1.0 if a == b else len(a & b) / len(a | b)


def test_stage_finds_appended_and_cut_copies(make):
    texts, copies = [], {}
    for k in range(60):
        base = prose(150 + 10 * k, 3000 + k).split()
        n = len(base)
        edit = [base + prose(n // 10, 4000 + k).split(), base + prose(n * 15 // 100, 4000 + k).split(), base + prose(n * 20 // 100, 4000 + k).split(), base[: n * 90 // 100], base[: n * 83 // 100]][k % 5]
        copies[60 + k] = k
        texts.append((" ".join(base), " ".join(edit)))
    assert all(jaccard(five_words(a), five_words(b)) >= 0.8 for a, b in texts)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicate_groups(make([a for a, _ in texts] + [b for _, b in texts])).collect()}
    assert got == {**{k: k for k in range(60)}, **copies}


def test_stage_keeps_what_is_below_the_rule(make):
    base = prose(300, 50).split()
    reordered = [" ".join(random.Random(k).sample(base, len(base))) for k in range(3)]
    repeated = " ".join(base + base[::-1])
    far = " ".join(base + prose(120, 51).split())
    texts = [" ".join(base), *reordered, repeated, far]
    assert all(jaccard(five_words(texts[0]), five_words(t)) < 0.8 for t in texts[1:])
    assert simhash.without_near_duplicates(make(texts)).count() == len(texts)


@pytest.mark.parametrize("cell", [simhash.CELL, 300])
def test_stage_is_brute_force(make, cell):
    texts = [edited(prose(120, b), n, 100 * n + k) for b in range(4) for n in (0, 2, 4, 6, 8) for k in range(5)] + ["", " ", "x y", "X  y"]
    sets = [five_words(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if root[a] != root[b] and jaccard(sets[a], sets[b]) >= 0.8:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicate_groups(make(texts), cell).collect()}
    assert got == dict(enumerate(root))
    assert 8 < len(set(root)) < len(texts) - 20


def test_thin_keeps_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(k, k % 7) for k in range(400, 900)] + [(k, k % 5) for k in range(400, 900)]
    edges = spark.createDataFrame(pairs, "u long, v long")
    few = simhash.thin(edges)
    roots = lambda e: sorted(tuple(r) for r in simhash.components(e).collect())
    assert roots(few) == roots(edges)
    assert few.count() < 900 + 100 < len(pairs)


def test_no_join_of_components_is_broadcast(spark):
    """Tables of these joins grow with the corpus, and a broadcast is built in the driver."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40, 2)], "u long, v long")
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (3, "x")], "doc_id long, text string")
    plans = []
    for df in (components(edges), simhash.simhash_components(docs)):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
    assert not any("BroadcastHashJoin" in p for p in plans)


def test_the_stage_finds_candidates_by_simhash(make, monkeypatch):
    """Without bands, copies with one word changed still meet by their fingerprints; documents that are not alike stay apart."""
    text = prose(3000, 5).split()
    other = [*text[:1500], "different", *text[1501:]]
    assert (simhash.fingerprint(" ".join(text).encode()) ^ simhash.fingerprint(" ".join(other).encode())).bit_count() <= simhash.MAX_BITS
    monkeypatch.setattr(simhash, "band_keys", lambda found: np.zeros(0, np.int64))
    docs = make([" ".join(text), " ".join(other), prose(3000, 6)])
    got = {r.doc_id: r.component_id for r in simhash.near_duplicate_groups(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 2}
