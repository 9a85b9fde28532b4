from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from sparvane.llm import sharding


def python_image(x: int, n: int, key: int) -> int:
    a, keys = sharding.sides(n), sharding.round_keys(key, 6)

    def once(v: int) -> int:
        low, high = v % a, v // a
        for i, (k1, k2, k3) in enumerate(keys):
            side = high if i % 2 == 0 else low
            y = (side + k1) % sharding.PRIME
            f = (y * y % sharding.PRIME * k2 + k3) % sharding.PRIME
            if i % 2 == 0:
                low = (low + f) % a
            else:
                high = (high + f) % a
        return high * a + low

    x = once(x)
    while x >= n:
        x = once(x)
    return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 101, 1000, 1025])
def test_permutation(spark, n):
    got = {r.id: r.p for r in spark.range(n).select("id", sharding.permuted(F.col("id"), n, 7).alias("p")).collect()}
    assert sorted(got.values()) == list(range(n))
    assert got == {x: python_image(x, n, 7) for x in range(n)}


def test_shards(make):
    texts = [f"text {i % 7} é" for i in range(203)]
    ids = list(range(203))[::-1]
    rows = sharding.shards(make(texts, ids)).collect()
    assert {(r.size, r.text_crc32, r.law, r.grown_shard) for r in rows if r.doc_id == 202} == {(len("text 0 é".encode()) + 1, zlib.crc32("text 0 é".encode()), "rows", None)}
    counts = {}
    for r in rows:
        counts.setdefault(r.shard, []).append(r.slot)
    assert set(counts) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in counts.values())
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    # row numbers follow doc_id, so the place can be computed
    assert all((r.shard, r.slot) == (p % 16, p // 16) for r in rows for p in [python_image(r.doc_id, 203, 20240229)])
    again = sharding.shards(make(texts, ids).repartition(5)).collect()
    assert sorted(rows) == sorted(again)


def test_odd_rows(odd, empty):
    rows = sharding.shards(odd).collect()
    assert len(rows) == odd.count() and {(r.size, r.text_crc32) for r in rows if r.doc_id in (0, 1)} == {(1, 0)}
    assert sorted(16 * r.slot + r.shard for r in rows) == list(range(len(rows)))
    assert sharding.shards(empty).collect() == []
