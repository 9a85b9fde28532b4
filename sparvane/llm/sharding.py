"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

Rows are numbered from 0 in the order of (doc_id, text CRC-32, size). The
number goes through a keyed permutation of 0 .. rows-1; its image p gives the
shard p mod shards and the slot p div shards, so both are computable from
the number, the row count and the key alone, shard sizes differ by at most
one row and slots have no gaps. All of it is DataFrame functions.

Cases: null text has size 1 and CRC-32 0, as empty text; a null doc_id sorts
first; repeated rows are interchangeable and each gets a place of its own;
fewer rows than shards leave shards empty; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparvane.llm.common import materialize

PRIME = 2147483647
#: Steps of cycle walking before the rare rest goes on to the proven bound.
FIRST_STEPS = 16


def round_keys(key: int, rounds: int) -> list[tuple[int, int, int]]:
    """Three numbers below PRIME for each round, from a linear congruence."""
    out, x = [], key % PRIME
    for _ in range(rounds):
        three = []
        for _ in range(3):
            x = (x * 48271 + 11) % PRIME
            three.append(x)
        out.append((three[0], three[1] | 1, three[2]))
    return out


def sides(n: int) -> int:
    """Half domain: the least a with a * a >= n."""
    return max(1, math.isqrt(max(n, 1) - 1) + 1)


def feistel(x: Column, a: int, keys: list[tuple[int, int, int]]) -> Column:
    """One pass of the alternating Feistel network over a * a numbers."""

    def mix(value: Column, k: Column) -> Column:
        y = (value + k["k1"]) % F.lit(PRIME)
        return ((y * y) % F.lit(PRIME) * k["k2"] + k["k3"]) % F.lit(PRIME)

    def step(acc: Column, k: Column) -> Column:
        low = F.when(k["even"], (acc["low"] + mix(acc["high"], k)) % F.lit(a)).otherwise(acc["low"])
        high = F.when(k["even"], acc["high"]).otherwise((acc["high"] + mix(acc["low"], k)) % F.lit(a))
        return F.struct(low.alias("low"), high.alias("high"))

    rounds = F.array(*[F.struct(F.lit(k1).cast("long").alias("k1"), F.lit(k2).cast("long").alias("k2"), F.lit(k3).cast("long").alias("k3"), F.lit(i % 2 == 0).alias("even")) for i, (k1, k2, k3) in enumerate(keys)])
    start = F.struct((x % F.lit(a)).cast("long").alias("low"), F.floor(x / F.lit(a)).cast("long").alias("high"))
    return F.aggregate(rounds, start, step, lambda acc: acc["high"] * F.lit(a) + acc["low"])


def permuted(number: Column, n: int, key: int, rounds: int = 6) -> Column:
    """Image of a row number under the keyed permutation of 0 .. n-1.

    A walk from inside 0 .. n-1 meets each of the a*a - n outside numbers at
    most once, which bounds its steps.
    """
    a, keys = sides(n), round_keys(key, rounds)
    outside = a * a - n

    def walk(start: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, lambda acc, _: F.when(acc < F.lit(n), acc).otherwise(feistel(acc, a, keys)))

    image = walk(number, 0) if n < 1 else feistel(number, a, keys)
    if outside:
        image = walk(image, min(FIRST_STEPS, outside))
        if outside > FIRST_STEPS:
            image = F.transform(F.array(image), lambda p: F.when(p < F.lit(n), p).otherwise(walk(p, outside)))[0]
    return image


def numbered(rows: DataFrame, by: list[str]) -> tuple[DataFrame, int]:
    """Rows with their global row number in column "number", and their count.

    Rows equal in ``by`` are told apart by their place in the scan, so that a
    value with very many rows still spreads over range partitions. Only one
    count per partition is gathered.
    """
    keyed = rows.withColumn("salt", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(*by, "salt").sortWithinPartitions(*by, "salt").drop("salt")
    kept = materialize(ordered.withColumn("at", F.monotonically_increasing_id()), "numbered")
    kept = kept.withColumn("part", F.shiftright("at", 33)).withColumn("inside", F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("at")
    counts = kept.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    joined = kept.join(F.broadcast(offsets), "part")
    return joined.withColumn("number", F.col("offset") + F.col("inside")).drop("part", "inside", "offset"), kept.count()


def shards(docs: DataFrame, n_shards: int = 16, key: int = 20240229) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row."""
    rows = docs.select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    )
    rows, n = numbered(rows, ["doc_id", "text_crc32", "size"])
    place = permuted(F.col("number"), n, key)
    rows = rows.withColumn("place", place)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("place") % n_shards).cast("int").alias("shard"),
        F.floor(F.col("place") / n_shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
