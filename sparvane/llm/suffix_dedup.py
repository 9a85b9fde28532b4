"""Removal of byte strings that occur twice, by hash-compared suffix sorting of sampled suffixes.

A byte is removed if a string of ``length`` bytes that covers it also starts
at another place of the corpus, the same document included.

Every such string holds ``length - k + 1`` neighbouring k-grams, and the one
with the least hash (an anchor) is the same in all its copies. So only
suffixes at anchors are sorted: they meet in buckets of equal k-grams, each
with its context, the bytes that strings with this anchor can cover. Equal
contexts are collapsed before any bytes are moved, by 128 bits of the SHA-256
of their bytes (the polynomial hash, for which collisions can be made, never
decides that two strings are equal): a bucket with one context that occurs
twice is covered whole, a context that occurs once in the corpus goes no
further. In a bucket with several contexts, the suffixes to the right of the
anchor, and the reversed prefixes to its left, are sorted by mergesort; two
are compared by their longest common extension, which binary search finds
from prefix polynomial hashes in logarithmically many steps and the bytes
themselves confirm, or correct. Neighbours in the two orders bound how far
any common string reaches; within these bounds the strings of ``length``
bytes are compared by hash, offset by offset, and the outermost ones that
agree are confirmed by their bytes. A collision costs time, never a byte.

A bucket of more than ``max_bucket`` different contexts is not gathered. Its
strings are counted in two passes, by SHA-256 again: first the stretch that
all strings of a range of offsets have in common, then each string of the
ranges whose stretch another context has too. Both are partial aggregates
without a hot key, and the result is the same.

Cases: null text is empty; texts shorter than ``length`` keep all; repeated
rows remove each other; a null doc_id is matched like any other value; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparvane.llm.common import column_bytes, grouped, materialize, table, utf8
from sparvane.llm.polyhash import MASK, Powers, minimizers, mixed

LENGTH = 400
GRAM = 100
#: Contexts of a bucket that are sorted in one task; larger buckets are counted string by string.
MAX_BUCKET = 8192
#: Ranges of offsets in which a large bucket is looked at first.
RANGES = 8
#: Bytes of a document hashed at a time.
PART = 1 << 20
#: Strings of a bucket that are compared at a time.
STRINGS = 1 << 18
#: Bytes of contexts that a task holds with their prefix hashes (nine times as much), above one bucket.
HELD = 2 << 20
KEY = ["doc_id", "th"]
CONTEXT = ["hk", "h1", "h2"]


def exact(parts: Iterable[bytes]) -> np.ndarray:
    """128 bits of the SHA-256 of each string, as two longs."""
    return np.frombuffer(b"".join([hashlib.sha256(x).digest()[:16] for x in parts]), "<i8").reshape(-1, 2)


def anchors_of(data: np.ndarray, powers: Powers, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, k-gram hashes, context hashes) of one text of at least ``length`` bytes; parts overlap so that none is missed."""
    window, n = length - k + 1, len(data)
    out = []
    for at in range(0, n - length + 1, PART):
        lo, hi = max(0, at - window + 1), min(n, at + PART + 2 * length)
        part = data[lo:hi]
        sums = powers.prefix(part)
        h = mixed((sums[k:] - sums[: len(sums) - k]) * powers.down[: len(part) - k + 1])
        found = minimizers(h[at - lo : at - lo + PART + window - 1], window) + (at - lo)
        start, end = np.maximum(found - (window - 1), 0), np.minimum(found + length, len(part))
        raw = part.tobytes()
        context = exact(b"%d " % (p - s) + raw[s:e] for p, s, e in zip(found.tolist(), start.tolist(), end.tolist(), strict=True))
        out.append((found + lo, h[found], context))
    if len(out) == 1:
        return out[0]
    at = np.concatenate([x[0] for x in out])
    once, first = np.unique(at, return_index=True)
    return once, np.concatenate([x[1] for x in out])[first], np.concatenate([x[2] for x in out])[first]


def anchors(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(doc_id, th, pos, hk, h1, h2) of every anchor."""
    schema = pa.schema([(c, pa.int64()) for c in (*KEY, "pos", *CONTEXT)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            offsets, data = column_bytes(batch.column("data"))
            rows, parts, held = [], [], 0

            def emit() -> pa.RecordBatch:
                counts = [len(p[0]) for p in parts]
                at = pa.array(np.repeat(np.array(rows), counts))
                columns = {c: batch.column(c).take(at) for c in KEY}
                pos, hk, h = (np.concatenate([p[i] for p in parts]) for i in range(3))
                return table(columns | {"pos": pos, "hk": hk.view(np.int64), "h1": h[:, 0], "h2": h[:, 1]}, schema)

            for i in range(batch.num_rows):
                if offsets[i + 1] - offsets[i] >= length:
                    rows.append(i)
                    parts.append(anchors_of(data[offsets[i] : offsets[i + 1]], powers, length, k))
                    held += len(parts[-1][0])
                    if held > 100_000:
                        yield emit()
                        rows, parts, held = [], [], 0
            if rows:
                yield emit()

    return docs.select("doc_id", "th", "data").mapInArrow(run, ", ".join(f"{c} long" for c in schema.names))


def contexts(docs: DataFrame, wanted: DataFrame, length: int, k: int) -> DataFrame:
    """(hk, h1, h2, large, left, data): the bytes around one occurrence of each wanted context, left of them before the anchor."""
    window = length - k + 1
    schema = pa.schema([*((c, pa.int64()) for c in CONTEXT), ("large", pa.bool_()), ("left", pa.int64()), ("data", pa.binary())])
    per_doc = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("pos", *CONTEXT, "large")).alias("at"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def emit() -> pa.RecordBatch:
            made = table(dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)), schema)
            out.clear()
            return made

        for batch in batches:
            for data, at in zip(batch.column("data"), batch.column("at"), strict=True):
                data = data.as_py()
                for x in at.as_py():
                    start = max(0, x["pos"] - window + 1)
                    out.append((*(x[c] for c in CONTEXT), x["large"], x["pos"] - start, data[start : x["pos"] + length]))
                    if len(out) >= 4_000:
                        yield emit()
        if out:
            yield emit()

    same = docs["th"].eqNullSafe(per_doc["th"]) & docs["doc_id"].eqNullSafe(per_doc["doc_id"])
    once = docs.join(per_doc, same).select(*[docs[c] for c in KEY], "data", "at")
    return once.select("data", "at").mapInArrow(run, "hk long, h1 long, h2 long, large boolean, left long, data binary")


class Contexts:
    """Contexts of whole buckets, joined, with the prefix hashes of the joined bytes."""

    def __init__(self, data: list[bytes], left: list[int], powers: Powers, length: int, k: int) -> None:
        self.length, self.window = length, length - k + 1
        self.joined = b"".join(data)
        self.base = np.concatenate([[0], np.cumsum([len(d) for d in data])])
        self.left = np.array(left, np.int64)
        #: place of each anchor, and bytes right of it
        self.at = self.base[:-1] + self.left
        self.right = self.base[1:] - self.at
        # exponents begin anew in each context, so that few powers are needed
        powers.ensure(int(np.diff(self.base).max(initial=0)) + 1)
        self.sums = np.zeros(len(self.joined) + 1, np.uint64)
        inside = np.arange(len(self.joined), dtype=np.int64) - np.repeat(self.base[:-1], np.diff(self.base))
        np.cumsum(powers.up[inside] * (np.frombuffer(self.joined, np.uint8) + np.uint64(1)), out=self.sums[1:])
        self.down = powers.down

    def _same(self, p: int, q: int, n: int, backward: bool) -> bool:
        return self.joined[p - n : p] == self.joined[q - n : q] if backward else self.joined[p : p + n] == self.joined[q : q + n]

    def extensions(self, i: np.ndarray, j: np.ndarray, backward: bool) -> np.ndarray:
        """Longest common extensions of pairs from their anchors, all at once, by binary search over prefix hashes, confirmed by the bytes."""
        side = self.left if backward else self.right
        low, high = np.zeros(len(i), np.int64), np.minimum(side[i], side[j])
        p, q = self.at[i], self.at[j]
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            back = mid if backward else 0
            s, t = p - back, q - back
            equal = (self.sums[s + mid] - self.sums[s]) * self.down[self.left[i] - back] == (self.sums[t + mid] - self.sums[t]) * self.down[self.left[j] - back]
            low = np.where(open_ & equal, mid, low)
            high = np.where(open_ & ~equal, mid - 1, high)
        for x in range(len(i)):
            if not self._same(int(p[x]), int(q[x]), int(low[x]), backward):  # hashes collided
                low[x] = self._extension(int(p[x]), int(q[x]), int(low[x]), backward)
        return low

    def _extension(self, p: int, q: int, most: int, backward: bool) -> int:
        """The longest common extension by the bytes alone."""
        low, high = 0, most
        while low < high:
            mid = (low + high + 1) >> 1
            if self._same(p, q, mid, backward):
                low = mid
            else:
                high = mid - 1
        return low

    def reach(self, a: int, b: int, backward: bool) -> np.ndarray:
        """How far each context of the bucket a .. b agrees with any other, from a mergesort of all of them: its neighbours in order agree the most."""
        sums, down, joined, same = memoryview(self.sums), memoryview(self.down), self.joined, self._same
        place, own = self.at[a:b].tolist(), self.left[a:b].tolist()
        room = (self.left[a:b] if backward else self.right[a:b]).tolist()

        def compare(i: int, j: int) -> int:
            p, q = place[i], place[j]
            low, high = 0, min(room[i], room[j])
            while low < high:
                mid = (low + high + 1) >> 1
                back = mid if backward else 0
                s, t = p - back, q - back
                if ((sums[s + mid] - sums[s]) * down[own[i] - back] - (sums[t + mid] - sums[t]) * down[own[j] - back]) & MASK:
                    high = mid - 1
                else:
                    low = mid
            if not same(p, q, low, backward):  # hashes collided
                low = self._extension(p, q, low, backward)
            if low == room[i] or low == room[j]:
                return room[i] - room[j]
            k = -low - 1 if backward else low
            return joined[p + k] - joined[q + k]

        order = np.array(sorted(range(b - a), key=cmp_to_key(compare))) + a
        near = self.extensions(order[:-1], order[1:], backward)
        out = np.zeros(b - a, np.int64)
        out[order[:-1] - a] = near
        out[order[1:] - a] = np.maximum(out[order[1:] - a], near)
        return out

    def windows(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(most bytes left of the anchor, least) of strings in each context of the bucket a .. b that another of them has too; (-1, length) where there are none.

        What neighbours in the sorted orders share bounds the offsets to look at.
        """
        most, least = np.full(b - a, -1), np.full(b - a, self.length)
        lo = np.maximum(0, self.length - self.reach(a, b, False))
        hi = np.minimum(self.window - 1, self.reach(a, b, True))
        step = max(1, STRINGS // (b - a))
        for top in range(int(hi.max(initial=-1)), int(lo.min(initial=0)) - 1, -step):  # offsets from the greatest down, some at a time
            self._outermost(a, b, np.maximum(lo, top - step + 1), np.minimum(hi, top), most, least)
        return most, least

    def _outermost(self, a: int, b: int, lo: np.ndarray, hi: np.ndarray, most: np.ndarray, least: np.ndarray) -> None:
        """Set most, where it is not, and least from the strings at offsets lo .. hi of each context."""
        count = np.maximum(hi - lo + 1, 0)
        row = np.repeat(np.arange(b - a), count)
        off = np.arange(len(row)) - (np.cumsum(count) - count)[row] + lo[row]
        start = self.at[a:b][row] - off
        keys = mixed((self.sums[start + self.length] - self.sums[start]) * self.down[self.left[a:b][row] - off] + off.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        ordered = keys[order]
        twice = np.zeros(len(keys), bool)
        equal = ordered[1:] == ordered[:-1]
        twice[order[1:][equal]] = twice[order[:-1][equal]] = True
        hits = np.flatnonzero(twice)
        if not len(hits):
            return
        run, end = np.searchsorted(ordered, keys[hits], "left").tolist(), np.searchsorted(ordered, keys[hits], "right").tolist()
        joined, length = self.joined, self.length

        def true(x: int) -> bool:
            """Whether another string of the same hash and offset has the same bytes."""
            s = int(start[hits[x]])
            own = joined[s : s + length]
            return any(t != s and joined[t : t + length] == own for t in map(start.item, order[run[x] : end[x]]))

        rows = row[hits]
        edge = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1], [True]])).tolist()
        for x, y in zip(edge, edge[1:], strict=False):
            down = next((h for h in range(x, y) if true(h)), None)
            if down is not None:
                r = rows[x]
                least[r] = off[hits[down]]
                if most[r] < 0:
                    most[r] = off[hits[next(h for h in range(y - 1, x - 1, -1) if true(h))]]

    def covered(self, edges: list[int]) -> Iterator[tuple[int, int, int]]:
        """(context, lo, hi): the bytes from the anchor that strings shared with others of its bucket cover.

        Strings of one anchor overlap at its gram, so their union is one span.
        """
        two = np.array([a for a, b in zip(edges, edges[1:], strict=False) if b - a == 2], np.int64)
        right, left = self.extensions(two, two + 1, False), self.extensions(two, two + 1, True)
        for x in np.flatnonzero(right + left >= self.length).tolist():
            yield int(two[x]), -int(left[x]), int(right[x])
            yield int(two[x]) + 1, -int(left[x]), int(right[x])
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a > 2:
                most, least = self.windows(a, b)
                for i in np.flatnonzero(most >= 0).tolist():
                    yield a + i, -int(most[i]), self.length - int(least[i])


def _small(rows: DataFrame, length: int, k: int, max_bucket: int) -> DataFrame:
    """(hk, h1, h2, lo, hi) of buckets that a task sorts."""
    schema = pa.schema([(c, pa.int64()) for c in (*CONTEXT, "lo", "hi")])
    at_a_time = max(64, HELD // (2 * length))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        parts = (b.slice(at, at_a_time) for b in batches for at in range(0, b.num_rows, at_a_time))
        for rows, _ in grouped(parts, "hk", max_bucket):
            hk = rows.column("hk").to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], hk[1:] != hk[:-1], [True]])).tolist()
            spans = list(Contexts(rows.column("data").to_pylist(), rows.column("left").to_pylist(), powers, length, k).covered(edges))
            if spans:
                at = np.array([s[0] for s in spans])
                yield table({c: rows.column(c).to_numpy()[at] for c in CONTEXT} | {"lo": [s[1] for s in spans], "hi": [s[2] for s in spans]}, schema)

    return rows.repartition("hk").sortWithinPartitions("hk").mapInArrow(run, ", ".join(f"{c} long" for c in schema.names))


def _large(rows: DataFrame, length: int, k: int) -> DataFrame:
    """(hk, h1, h2, lo, hi) of buckets of any size, string by string.

    All strings of a range of offsets a .. b have the stretch from a bytes
    left to length - b bytes right of the anchor. Only where another context
    has this stretch too are the range's strings made and counted.
    """
    window = length - k + 1
    step = -(-window // RANGES)
    ranges = [(a, min(window, a + step) - 1) for a in range(0, window, step)]
    names = [*CONTEXT, "part", "s1", "s2"]
    ddl = "hk long, h1 long, h2 long, part long, s1 long, s2 long"
    schema = pa.schema([(c, pa.int64()) for c in names])

    def hashed(found: list[tuple], strings: list[bytes]) -> pa.RecordBatch:
        h = exact(strings)
        columns = [list(c) for c in zip(*found, strict=True)]
        return table(dict(zip(names[:4], columns, strict=True)) | {"s1": h[:, 0], "s2": h[:, 1]}, schema)

    def made(batches: Iterable[pa.RecordBatch], of_row) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
        found: list[tuple] = []
        strings: list[bytes] = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in batch.schema.names]
            for x in zip(*columns, strict=True):
                for part, string in of_row(dict(zip(batch.schema.names, x, strict=True))):
                    found.append((x[0], x[1], x[2], part))
                    strings.append(string)
                if len(found) >= 5_000:
                    yield hashed(found, strings)
                    found, strings = [], []
        if found:
            yield hashed(found, strings)

    def stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of_row(x: dict) -> Iterator[tuple[int, bytes]]:
            for i, (a, b) in enumerate(ranges):
                if a <= x["left"] and length - b <= len(x["data"]) - x["left"]:
                    yield i, x["data"][x["left"] - a : x["left"] + length - b]

        return made(batches, of_row)

    def strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of_row(x: dict) -> Iterator[tuple[int, bytes]]:
            a, b = ranges[x["part"]]
            for off in range(a, b + 1):
                if off <= x["left"] and length - off <= len(x["data"]) - x["left"]:
                    yield off, x["data"][x["left"] - off : x["left"] - off + length]

        return made(batches, of_row)

    def shared(found: DataFrame) -> DataFrame:
        """Contexts whose string another one of the bucket has too; a context has a string once."""
        found = materialize(found, "strings")
        twice = found.groupBy("hk", "part", "s1", "s2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        # written first, so that a string with very many contexts can be split in the join
        return found.join(materialize(twice, "twice"), ["hk", "part", "s1", "s2"]).select(*CONTEXT, "part")

    first = shared(rows.select(*CONTEXT, "left", "data").mapInArrow(stretches, ddl))
    second = shared(first.join(rows, CONTEXT).select(*CONTEXT, "part", "left", "data").mapInArrow(strings, ddl))
    return second.groupBy(*CONTEXT).agg((-F.max("part")).alias("lo"), (F.lit(length) - F.min("part")).alias("hi"))


def coverage(docs: DataFrame, wanted: DataFrame, length: int, k: int, max_bucket: int) -> DataFrame:
    """(hk, h1, h2, lo, hi): bytes from the anchor that each context has covered by strings shared with another context of its bucket."""
    sizes = wanted.groupBy("hk").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_bucket).select("hk", F.lit(True).alias("large"))
    sizes = materialize(sizes, "large")
    if sizes.isEmpty():
        return _small(contexts(docs, wanted.withColumn("large", F.lit(False)), length, k), length, k, max_bucket)
    found = contexts(docs, wanted.join(sizes, "hk", "left").withColumn("large", F.col("large").isNotNull()), length, k)
    found = materialize(found, "contexts")
    return _small(found.where("not large"), length, k, max_bucket).unionByName(_large(found.where("large"), length, k))


def repeated_spans(docs: DataFrame, length: int = LENGTH, k: int = GRAM, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(doc_id, th, spans): for documents that have any, byte ranges whose union is to be removed."""
    window = length - k + 1
    whole = [F.lit(1 - window).cast("long").alias("lo"), F.lit(length).cast("long").alias("hi")]
    found = materialize(anchors(docs, length, k), "anchors")
    grams = found.groupBy("hk").agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in ("h1", "h2") for f in (F.min, F.max)]).where("n > 1")
    # written first, so that a gram with very many anchors can be split in the join
    grams = materialize(grams.select("hk", F.expr("min_h1 != max_h1 or min_h2 != max_h2").alias("several")), "grams")
    found = materialize(found.join(grams, "hk"), "repeated")
    each = found.where("several").groupBy(*CONTEXT).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY, "pos")).alias("one"))
    each = materialize(each.select(*CONTEXT, "n", "one.*"), "each")
    spans = coverage(docs, each, length, k, max_bucket)
    # a context that stands at two places is covered as far as it goes
    spans = spans.unionByName(each.where("n > 1").select(*CONTEXT, *whole)).groupBy(*CONTEXT).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    placed = found.where("several").join(materialize(spans, "coverage"), CONTEXT).select(*KEY, "pos", "lo", "hi")
    placed = placed.unionByName(found.where("not several").select(*KEY, "pos", *whole))
    # rows equal in id and text have the same spans: each is gathered once
    return placed.groupBy(*KEY).agg(F.collect_set(F.struct((F.col("pos") + F.col("lo")).alias("lo"), (F.col("pos") + F.col("hi")).alias("hi"))).alias("spans"))


def merged(spans: list[dict] | None, size: int) -> list[tuple[int, int]]:
    """Maximal runs of the union, within 0 .. size."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((max(0, s["lo"]), min(size, s["hi"])) for s in spans or []):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def kept(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for lo, hi in runs:
        parts.append(data[at:lo])
        at = hi
    return b"".join([*parts, data[at:]])


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, th, data) and the named columns; doc_id and the text's hash tell rows apart, and rows equal in both have equal results."""
    return docs.select(F.col("doc_id").cast("long"), utf8().alias("data"), *more).withColumn("th", F.xxhash64("data"))


def digests(docs: DataFrame, length: int = LENGTH, k: int = GRAM, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row."""
    rows = keyed(docs)
    spans = repeated_spans(rows, length, k, max_bucket)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, data, found in zip(batch.column("doc_id").to_pylist(), batch.column("data"), batch.column("spans"), strict=True):
                data = data.as_py()
                runs = merged(found.as_py(), len(data))
                out.append((doc_id, len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept(data, runs)).hexdigest()))
            if out:
                yield table(dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)), schema)

    return _with_spans(rows, spans).select("doc_id", "data", "spans").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    spans = spans.select(F.col("doc_id").alias("of"), F.col("th").alias("of_th"), "spans")
    return rows.join(spans, F.col("th").eqNullSafe(F.col("of_th")) & F.col("doc_id").eqNullSafe(F.col("of")), "left").drop("of", "of_th")


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = GRAM, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """docs with the repeated strings cut from their texts and n_chars, where there is such a column, set anew.

    A character that loses some of its bytes goes whole.
    """
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != "text"] or [F.lit(1).alias("none")]).alias("row"), F.col("doc_id").cast("long"), utf8().alias("data"), F.col("text").isNull().alias("void")).withColumn("th", F.xxhash64("data"))
    spans = repeated_spans(rows.select("doc_id", "th", "data"), length, k, max_bucket)

    @F.pandas_udf("string")
    def cut(data, found):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([kept(d, merged(list(s) if s is not None else None, len(d))).decode("utf-8", "ignore") for d, s in zip(data, found, strict=True)])

    text = F.when(F.col("void"), F.lit(None)).when(F.col("spans").isNull(), F.col("data").cast("string")).otherwise(cut("data", "spans"))
    out = _with_spans(rows, spans).withColumn("new", text)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("new").alias(c))
        elif c == "n_chars":
            columns.append(F.coalesce(F.length("new"), F.lit(0)).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col("row")[c].alias(c))
    return out.select(*columns)
