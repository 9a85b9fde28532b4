"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into three segments. Two fingerprints that
differ in at most four bits agree, in one segment at least, up to one bit; so
each fingerprint is filed under its 64 one-wildcard segment variants, an
equality on the variant brings candidates together, and the whole
fingerprints are compared. Only distinct fingerprints take part, so exact
copies never meet each other.

A variant with more than ``max_bucket`` fingerprints is not compared pair by
pair: its members spread over all points within two bits of themselves, and
two of them differ in at most four bits exactly if they share such a point.
That is exact too and linear in the members, so no bucket has a cap.

Cases: null text and text without words have fingerprint 0 and link like any
other; fewer words than a shingle give one shingle; repeated rows are each
returned; a null doc_id takes part but never names a component unless all
members are null; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparvane.llm.common import grouped, materialize, table, utf8
from sparvane.llm.components import components, thin

BITS = 64
#: First bit and width of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Bits of the longest segment; above them a key has 6 bits for the wildcard and then the table's number.
SEGMENT_BITS = 22
TABLE_SHIFT = SEGMENT_BITS + 6
MAX_BITS = 4
MAX_BUCKET = 1024
#: Shingles hashed at a time.
CHUNK = 1 << 16


def words(data: bytes) -> list[bytes]:
    """bytes.lower() and bytes.split() touch ASCII only: A-Z, and 0x20 and 0x09-0x0D."""
    return data.lower().split()


def shingles(found: list[bytes], n: int) -> Iterator[list[bytes]]:
    """Chunks of the n-word shingles; fewer words are one shingle."""
    if len(found) < n:
        if found:
            yield [b" ".join(found)]
        return
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    joined = b" ".join(found)
    first, last = starts[: len(found) - n + 1].tolist(), ends[n - 1 :].tolist()
    for at in range(0, len(first), CHUNK):
        yield [joined[s:e] for s, e in zip(first[at : at + CHUNK], last[at : at + CHUNK], strict=True)]


def fingerprint(data: bytes, n: int = 4, seed: int = 42) -> int:
    """64-bit SimHash; a bit is 1 if set in over half the shingle hashes."""
    found = words(data)
    ones, total = np.zeros(BITS, np.int64), 0
    digest = xxhash.xxh64_digest
    for part in shingles(found, n):
        hashes = np.frombuffer(b"".join([digest(s, seed) for s in part]), dtype=np.uint8).reshape(-1, 8)
        ones += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
        total += len(part)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame, n: int = 4, seeds: tuple[int, ...] = (42,)) -> DataFrame:
    """(doc_id, fps): one fingerprint per seed, as signed longs."""
    schema = pa.schema([("doc_id", pa.int64()), ("fps", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("data")
            yield table({"doc_id": batch.column("doc_id"), "fps": [[_signed(fingerprint(t.as_py(), n, s)) for s in seeds] for t in texts]}, schema)

    return docs.select(F.col("doc_id").cast("long"), utf8().alias("data")).mapInArrow(run, "doc_id long, fps array<long>")


def variants(fp: Column, table_number: Column | None = None) -> Column:
    """The 64 one-wildcard segment variants: number of the wildcard bit (and of the table) above the segment without that bit."""
    keys = []
    for first, width in SEGMENTS:
        segment = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))
        keys += [segment.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << i))) + F.lit((first + i) << SEGMENT_BITS) for i in range(width)]
    if table_number is not None:
        above = F.shiftleft(table_number.cast("long"), TABLE_SHIFT)
        keys = [k + above for k in keys]
    return F.array(*keys)


def _reduce(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links -> a star for each of their components."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _bucket_links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal keys, as stars."""
    a, b, held = [], [], 0
    at = np.arange(len(keys) - 1)
    d = 1
    while True:
        at = at[at + d < len(keys)]
        at = at[keys[at] == keys[at + d]]
        if not len(at):
            break
        x, y = fps[at], fps[at + d]
        near = np.bitwise_count((x ^ y).view(np.uint64)) <= max_bits
        a.append(x[near])
        b.append(y[near])
        held += len(a[-1])
        if held > 1 << 20:
            x, y = _reduce(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], len(x)
        d += 1
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _reduce(np.concatenate(a), np.concatenate(b))


def _ball(max_bits: int) -> np.ndarray:
    """Masks of at most half of max_bits bits."""
    one = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    masks = [np.zeros(1, np.uint64), one]
    if max_bits >= 4:
        i, j = np.triu_indices(BITS, 1)
        masks.append(one[i] | one[j])
    return np.concatenate(masks).view(np.int64)


def links(nodes: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(t, fp) distinct -> (t, u, v): stars that have the components of all pairs of a table at max_bits bits or fewer (even, 4 at most)."""
    if max_bits not in (2, 4):
        raise ValueError("three segments and a ball of half the bits need max_bits 2 or 4")
    schema = pa.schema([("t", pa.int32()), ("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, large in grouped(batches, "key", max_bucket):
            keys, fps = rows.column("key").to_numpy(), rows.column("fp").to_numpy()
            if large:
                u = np.unique(fps)
                yield table({"t": np.full(len(u), keys[0] >> TABLE_SHIFT), "u": u, "v": pa.nulls(len(u), pa.int64())}, schema)
                continue
            tables = keys >> TABLE_SHIFT
            for t in np.unique(tables).tolist():
                own = tables == t
                u, v = _bucket_links(keys[own], fps[own], max_bits)
                if len(u):
                    yield table({"t": np.full(len(u), t), "u": u, "v": v}, schema)

    filed = nodes.select("fp", F.explode(variants(F.col("fp"), F.col("t"))).alias("key"))
    found = materialize(filed.repartition("key").sortWithinPartitions("key").mapInArrow(run, "t int, u long, v long").distinct(), "links")
    near = found.where("v is not null")
    hot = found.where("v is null").select("t", F.col("u").alias("fp")).distinct()
    if hot.isEmpty():
        return near
    masks = _ball(max_bits)
    spread_schema = pa.schema([("t", pa.int32()), ("fp", pa.int64()), ("point", pa.int64())])

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, fps = batch.column("t").to_numpy(), batch.column("fp").to_numpy()
            for at in range(0, len(fps), 256):
                part = fps[at : at + 256]
                yield table({"t": np.repeat(numbers[at : at + 256], len(masks)), "fp": np.repeat(part, len(masks)), "point": (part[:, None] ^ masks[None, :]).ravel()}, spread_schema)

    points = hot.mapInArrow(spread, "t int, fp long, point long")
    roots = points.groupBy("t", "point").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").select("t", "point", "v")
    return near.unionByName(points.join(roots.hint("merge"), ["t", "point"]).where("fp != v").select("t", F.col("fp").alias("u"), "v").distinct())


def simhash_components(docs: DataFrame, n: int = 4, seed: int = 42, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs."""
    rows = materialize(fingerprints(docs, n, (seed,)).select("doc_id", F.col("fps")[0].alias("fp")), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(thin(links(nodes.select(F.lit(0).alias("t"), "fp"), max_bits, max_bucket).select("u", "v")))
    roots = roots.hint("merge")  # as large as the table, and so are the joins below
    of = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = of.groupBy("root").agg(F.min("first").alias("component_id"))
    named = of.join(named.hint("merge"), "root").select("fp", "component_id")
    return rows.join(named.hint("merge"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: The pipeline stage, whose candidates meet by SimHash and by bands: words of a shingle, and the least Jaccard index of near-duplicates as a fraction.
STAGE_SHINGLE = 5
ALIKE = (4, 5)
#: Bands of MinHash values, and values of a band: a pair at an index of 0.8 meets in none with a chance of (1 - 0.8 ** 4) ** 28 = 4e-7.
BANDS, ROWS = 28, 4
#: Shingles of a cell in which all pairs of different groups are compared.
CELL = 1 << 21

_random = np.random.default_rng(20)
_FACTORS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_MIX = (_random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).reshape(BANDS, ROWS)


def shingle_set(data: bytes, n: int = STAGE_SHINGLE) -> np.ndarray:
    """Sorted different 64-bit hashes of the n-word shingles."""
    parts = [np.frombuffer(b"".join([xxhash.xxh64_digest(s) for s in part]), dtype=">u8").astype(np.uint64) for part in shingles(words(data), n)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def set_id(found: np.ndarray) -> int:
    """A signed long that equal sets share."""
    return _signed(xxhash.xxh3_64_intdigest(found.tobytes()))


def band_keys(found: np.ndarray) -> np.ndarray:
    """One key for each band; the empty set has none."""
    if not len(found):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 4096):
        least = np.minimum(least, (found[at : at + 4096, None] * _FACTORS + _SHIFTS).min(axis=0))
    return (least.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, set, keys): the text's SimHash, the id of its shingle set and that set's band keys."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("set", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, ids, keys = [], [], []
            for t in batch.column("data"):
                text = t.as_py()
                found = shingle_set(text)
                fps.append(_signed(fingerprint(text)))
                ids.append(set_id(found))
                keys.append(band_keys(found))
            yield table({"doc_id": batch.column("doc_id"), "fp": fps, "set": ids, "keys": keys}, schema)

    return docs.select(F.col("doc_id").cast("long"), utf8().alias("data")).mapInArrow(run, "doc_id long, fp long, set long, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set, size, hashes) of the wanted (set, first), from the text of the document first."""
    schema = pa.schema([("set", pa.int64()), ("size", pa.int64()), ("hashes", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for want, t in zip(batch.column("set").to_pylist(), batch.column("data"), strict=True):
                found = shingle_set(t.as_py())
                if set_id(found) == want:  # a doc_id may have several texts
                    yield table({"set": [want], "size": [len(found)], "hashes": [found.view(np.int64)]}, schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("first"), utf8().alias("data")).join(wanted, "first").select("set", "data")
    return texts.mapInArrow(run, "set long, size long, hashes array<long>").dropDuplicates(["set"])


def _alike(both: np.ndarray, a: int, b: np.ndarray) -> np.ndarray:
    """both / (a + b - both) >= ALIKE, in whole numbers."""
    part, whole = ALIKE
    return (part + whole) * both >= part * (a + b)


def _cell_links(roots: list[int], sides: list[bool], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of places that join the groups of a cell as all its pairs of alike sets do; with both sides present, pairs across them only."""
    root, side = np.unique(np.array(roots), return_inverse=True)[1], np.array(sides)
    across, sizes = bool(side.any() and not side.all()), np.array([len(s) for s in sets])
    out = []
    for x in range(len(sets)):
        # sets whose sizes alone put them below ALIKE cannot be alike
        other = (root != root[x]) & (np.minimum(sizes, sizes[x]) * ALIKE[1] >= np.maximum(sizes, sizes[x]) * ALIKE[0])
        if across:
            other &= side != side[x]
        other[: x + 1] = False
        at = np.flatnonzero(other)
        if not len(at):
            continue
        joined = np.concatenate([sets[y] for y in at])
        place = np.minimum(np.searchsorted(sets[x], joined), len(sets[x]) - 1)
        starts = np.concatenate([[0], np.cumsum(sizes[at])[:-1]])
        both = np.add.reduceat((sets[x][place] == joined).astype(np.int64), starts)
        for y in at[_alike(both, sizes[x], sizes[at])].tolist():
            if root[y] != root[x]:
                out.append((x, y))
                root[root == root[y]] = root[x]
    return out


def simhash_keys(rows: DataFrame) -> DataFrame:
    """(set, key) distinct of (set, fp): the SimHash component, at MAX_BITS bits by deletion variants, of each fingerprint a set has."""
    roots = components(thin(links(rows.select(F.lit(0).alias("t"), "fp").distinct()).select("u", "v"))).hint("merge")
    of = rows.select("set", "fp").distinct()
    return of.join(roots, of.fp == roots.node, "left").select("set", F.coalesce("root", "fp").alias("key")).distinct()


def alike_edges(docs: DataFrame, groups: DataFrame, cell: int = CELL, near_keys: DataFrame | None = None) -> DataFrame:
    """(set, first, keys) distinct -> (u, v): pairs of alike sets that have the components of all alike pairs that share a band key, or one of near_keys (set, key).

    Each set of a bucket is held against the bucket's least one, which is
    linear and joins a large group of near copies. Sets of a bucket that are
    in different components after that are compared pair by pair; those of
    a large bucket in cells of some ``cell`` shingles, so that no task holds more.
    No edge is made without an exact comparison of the sets.
    """
    filed = groups.select("set", F.explode("keys").alias("key"))
    if near_keys is not None:
        filed = materialize(filed.unionByName(near_keys), "filed")
    least = filed.groupBy("key").agg(F.min("set").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "least")
    met = materialize(filed.join(least, "key").where("set != least"), "met")
    pairs = met.select("set", "least").distinct()
    wanted = pairs.select("set").union(pairs.select("least")).distinct().join(groups.select("set", "first"), "set")
    sets = materialize(_sets(docs, wanted), "sets")
    a, b = sets.select("set", F.col("size").alias("a"), F.col("hashes").alias("x")), sets.select(F.col("set").alias("least"), F.col("size").alias("b"), F.col("hashes").alias("y"))
    part, whole = ALIKE
    close = pairs.join(a.select("set", "a"), "set").join(b.select("least", "b"), "least").where(F.least("a", "b") * whole >= F.greatest("a", "b") * part).select("set", "least")
    both = F.size(F.array_intersect("x", "y"))
    near = materialize(close.join(a, "set").join(b, "least").where(both * (part + whole) >= (F.col("a") + F.col("b")) * part).select(F.col("set").alias("u"), F.col("least").alias("v")), "near")
    near = materialize(thin(near), "near")  # a set has a least one for each band

    placed = met.join(components(near).withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set")).select("key", "set", "root")
    placed = placed.join(sets.select("set", "size"), "set")
    still = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.sum("size").alias("total")).where("lo != hi")
    still = still.select("key", F.ceil(F.col("total") / cell).cast("int").alias("blocks"))
    dealt = placed.join(still, "key").withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).alias("side"), "set", "root")
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def compare(rows: pa.Table) -> pa.Table:
        ids = rows.column("set").to_pylist()
        sets = [x.values.to_numpy().view(np.uint64) for x in rows.column("hashes")]
        found = _cell_links(rows.column("root").to_pylist(), rows.column("side").to_pylist(), sets)
        return pa.table({"u": pa.array([ids[x] for x, _ in found], pa.int64()), "v": pa.array([ids[y] for _, y in found], pa.int64())}, schema=schema)

    rest = dealt.join(sets.select("set", "hashes"), "set").groupBy("key", "i", "j").applyInArrow(compare, "u long, v long")
    return near.unionByName(materialize(rest.distinct(), "rest"))


def near_duplicate_groups(docs: DataFrame, cell: int = CELL) -> DataFrame:
    """(doc_id, component_id): groups of documents linked by a Jaccard index of five-word shingles of 0.8 or more.

    Candidates meet by SimHash, as components of fingerprints that differ in
    at most MAX_BITS bits. Pairs at an index of 0.8 often differ in more, so
    bands of MinHash values, whose chance depends on the index alone, whatever
    the edit, bring further candidates. Each edge is an exact comparison of
    two sets. A row whose doc_id is null has no part in it.
    """
    rows = materialize(signatures(docs).where("doc_id is not null"), "signatures")
    groups = materialize(rows.groupBy("set", "keys").agg(F.min("doc_id").alias("first")), "groups")
    roots = components(alike_edges(docs, groups, cell, simhash_keys(rows)))
    roots = roots.hint("merge")
    of = groups.join(roots, groups.set == roots.node, "left").select("set", "first", F.coalesce("root", "set").alias("root"))
    named = of.join(of.groupBy("root").agg(F.min("first").alias("component_id")).hint("merge"), "root").select("set", "component_id")
    return rows.join(named.hint("merge"), "set").select("doc_id", "component_id")


def without_near_duplicates(docs: DataFrame, cell: int = CELL) -> DataFrame:
    """One row of docs for each group, that with the smallest doc_id, with all its columns.

    Of repeated rows with that doc_id one stays; rows whose doc_id is null
    all stay, as nothing names them.
    """
    # a row's place in the scan tells rows of one doc_id apart
    placed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.monotonically_increasing_id().alias("place"))
    groups = near_duplicate_groups(docs, cell)
    gone = groups.where("doc_id != component_id").select(F.col("doc_id").alias("id")).distinct()
    twice = placed.where("id is not null").groupBy("id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "first")
    kept = placed.join(gone, "id", "left_anti").join(twice, "id", "left").where("first is null or first = place")
    return kept.select("row.*")
