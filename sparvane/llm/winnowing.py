"""Document fingerprints by winnowing.

Every k-gram of a text's code points has a rolling hash; of each window of
``window`` neighbouring k-grams the least hash is kept, the rightmost of
equal ones, with its position. Two texts that share a stretch of
``window + k - 1`` code points therefore share a kept hash, and the
positions say where. In a short text the window is narrower, so that any
half of a text of ``2 * k`` code points or more holds a kept hash; what a wide window
keeps a narrower one keeps too, so texts with different windows compare. The likeness of two fingerprints is the Jaccard index
of their sets of hashes.

A text's follower is the next document in order of doc_id, after the last
the first. Documents are dealt to ranges of doc_id, each range ending with
a copy of the document that opens the next, so text moves once; a task
streams its range and holds two documents.

Cases: null text is empty and has the empty fingerprint; a text with fewer
than k code points has the hash of the whole; two empty fingerprints are
alike (1.0), an empty and another are not (0.0); likeness is that of the
fingerprints as returned; equal doc_ids follow each
other in order of their text; a null doc_id comes first; a single document
follows itself; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparvane.llm.common import table
from sparvane.llm.polyhash import Powers, minimizers

K = 8
WINDOW = 64
#: Code points hashed at a time.
PART = 1 << 20

def winnow(text: str, powers: Powers, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) kept of a text, in order of position; a long text part by part, overlapping by a window."""
    if not text:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    window = min(window, max(1, len(points) // 2 - k + 1))
    hashes, places = [], []
    for at in range(0, max(1, len(points) - k - window + 2), PART):
        h = powers.grams(points[at : at + PART + k + window - 2], k)
        kept = minimizers(h, window)
        hashes.append(h[kept])
        places.append(kept + at)
    if len(places) == 1:
        return hashes[0], places[0]
    once, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[first], once


def encoded(hashes: np.ndarray, places: np.ndarray) -> str:
    """hash:position pairs, 32 bits of the hash in hex and the position in decimal."""
    return " ".join(f"{h:08x}:{p}" for h, p in zip(published(hashes).tolist(), places.tolist(), strict=True))


def published(hashes: np.ndarray) -> np.ndarray:
    """The 32 bits of each hash that a fingerprint shows, and that are compared."""
    return hashes >> np.uint64(32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of two sorted sets."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _range_of(value: Column, splits: list[int]) -> Column:
    """How many of the ascending splits are no greater than value, by two short scans."""
    step = max(1, math.isqrt(len(splits)))
    literal = lambda found: F.array(*[F.lit(s).cast("long") for s in found])
    upto = lambda found: F.size(F.filter(found, lambda s: s <= value))
    coarse = upto(literal(splits[step - 1 :: step])) * F.lit(step)
    return coarse + upto(F.slice(literal(splits), coarse + 1, step))


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    splits = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10 * parts).alias("s")).first().s or []
    splits = sorted(set(splits))
    part = F.lit(0)
    if splits:
        part = F.when(F.col("doc_id").isNull(), 0).otherwise(_range_of(F.col("doc_id"), splits))
    dealt = rows.withColumn("part", part.cast("int"))
    # one doc_id for each range: which rows open one, and the range before it
    null_first = F.struct(F.col("doc_id").isNotNull().alias("some"), F.col("doc_id").alias("id"))
    opens = {r.part: r.least.id for r in dealt.select("doc_id", "part").groupBy("part").agg(F.min(null_first).alias("least")).collect()}
    present = sorted(opens)
    before = {p: present[i - 1] for i, p in enumerate(present)}
    again = dealt.limit(0).withColumn("sentinel", F.lit(True))
    if present:
        ids = [x for x in opens.values() if x is not None]
        opening = F.col("doc_id").isin(ids) if ids else F.lit(False)
        if None in opens.values():
            opening = F.col("doc_id").isNull() | (F.coalesce(opening, F.lit(False)) & (F.col("part") != F.lit(present[0])))
        earlier = F.create_map(*[F.lit(x) for p, q in before.items() for x in (p, q)])
        again = dealt.where(opening).withColumn("part", earlier[F.col("part")].cast("int")).withColumn("sentinel", F.lit(True))
    moved = dealt.withColumn("sentinel", F.lit(False)).unionByName(again)
    order_ = F.create_map(*[F.lit(x) for i, p in enumerate(present) for x in (p, i)])[F.col("part")].cast("int") if present else F.lit(0)
    # the first document's copy stands after the last range, or after itself in a table of one range
    # one range to a task: dealt by hash, some tasks would get several
    moved = moved.withColumn("task", order_).repartitionById(max(1, len(present)), "task").drop("task").sortWithinPartitions("part", "sentinel", F.col("doc_id").asc_nulls_first(), "text")
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()

        def marks(text: str) -> tuple[str, np.ndarray]:
            hashes, places = winnow(text, powers, k, window)
            return encoded(hashes, places), np.unique(published(hashes))

        held: tuple | None = None
        closed = None
        out: list[tuple] = []
        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "part", "sentinel", "text")]
            for i in range(batch.num_rows):
                doc_id, part, sentinel, text = (c[i].as_py() for c in columns)
                if sentinel and part == closed:
                    continue
                mark, kept = marks(text)
                if held is not None:
                    other = edited(held[1], text)
                    other_mark, other_kept = marks(other)
                    out.append((held[0], len(held[1]), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), held[2], other_mark, likeness(held[3], other_kept), likeness(held[3], kept)))
                if sentinel:
                    held, closed = None, part
                else:
                    held = (doc_id, text, mark, kept)
                if len(out) >= 500:
                    yield table(dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)), schema)
                    out = []
        if out:
            yield table(dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)), schema)

    return moved.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
