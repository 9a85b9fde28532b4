"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The test items are read in blocks of bounded size, each block against all
documents. Within a block every n-gram's document frequency is counted over
the whole corpus; of each ``spread`` neighbouring n-grams of an item the
rarest becomes a seed, so that every stretch of ``spread + n - 1`` words has
one, however often a passage was copied. A document's seeds are looked up in
the block and, where they meet an item, the words around are aligned with
the item's by Smith-Waterman. The score is the alignment's over that of the
item with itself; ``least`` or more is a leak. No frequency rules a seed
out, and every place of a document that has seeds is aligned.

Words: ASCII letters in lower case, other ASCII characters than letters and
digits as separators, other characters kept.

Cases: null or wordless texts and items match nothing; an item of fewer than
n words is matched by its whole sequence; repeated rows are judged each; a
null doc_id is carried as it is; empty tables give empty results; other
columns are ignored (``clean`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparvane.llm.common import table, utf8

N = 3
SPREAD = 3
LEAST = 0.4
MATCH, MISMATCH, GAP = 2, -1, -1
#: UTF-8 bytes of items in a block, on average.
BLOCK_BYTES = 16 << 20
SEPARATE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words(data: bytes) -> list[bytes]:
    return data.lower().translate(SEPARATE).split()


def codes(ids: np.ndarray, n: int, base: int) -> np.ndarray:
    """A number for each n-gram of word ids; -1 where a word is unknown."""
    if len(ids) < n:
        return np.zeros(0, np.int64)
    out = np.zeros(len(ids) - n + 1, np.int64)
    known = np.ones(len(out), bool)
    for k in range(n):
        part = ids[k : len(ids) - n + 1 + k]
        out = out * base + part
        known &= part >= 0
    out[~known] = -1
    return out


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(best score, position after its last word in text), by rows of the matrix."""
    columns = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for x in item:
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(text == x, MATCH, MISMATCH), row[1:] + GAP)
        new = np.maximum(new, 0)
        new = np.maximum.accumulate(new - GAP * columns) + GAP * columns  # gaps in the item
        at = int(new.argmax())
        if new[at] > best:
            best, end = int(new[at]), at
        row = new
    return best, end


class Block:
    """Items, their n-grams and, once frequencies are known, their seeds."""

    def __init__(self, items: list[tuple[int, bytes]], n: int = N) -> None:
        self.n = n
        self.ids = [i for i, _ in items]
        texts = [words(t) for _, t in items]
        self.vocabulary: dict[bytes, int] = {}
        for t in texts:
            for w in t:
                self.vocabulary.setdefault(w, len(self.vocabulary))
        self.base = len(self.vocabulary) + 1
        if self.base**n >= 1 << 62:
            raise OverflowError("too many different words in a block")
        self.items = [np.array([self.vocabulary[w] for w in t], np.int64) for t in texts]
        self.sizes = sorted({min(n, len(x)) for x in self.items} - {0})
        self.grams = {m: np.unique(np.concatenate([codes(x, m, self.base) for x in self.items if min(n, len(x)) == m])) for m in self.sizes}
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}

    def encode(self, data: bytes) -> np.ndarray:
        found = words(data)
        return np.fromiter(map(self.vocabulary.get, found, repeat(-1)), np.int64, len(found))

    def present(self, data: bytes) -> list[tuple[int, np.ndarray]]:
        """Indices of the block's n-grams that a text has, by size."""
        ids, out = self.encode(data), []
        for m, grams in self.grams.items():
            got = np.unique(codes(ids, m, self.base))
            at = np.minimum(np.searchsorted(grams, got), len(grams) - 1)
            out.append((m, at[grams[at] == got]))
        return out

    def choose(self, frequency: dict[tuple[int, int], int], spread: int = SPREAD) -> None:
        """The rarest n-gram of each window of ``spread`` becomes a seed; the first of equally rare ones."""
        for m, grams in self.grams.items():
            seed, item, place = [], [], []
            for k, x in enumerate(self.items):
                if min(self.n, len(x)) != m:
                    continue
                own = np.searchsorted(grams, codes(x, m, self.base))
                counts = [frequency.get((m, int(g)), 0) for g in own]
                chosen = {min(range(a, min(a + spread, len(own))), key=counts.__getitem__) for a in range(max(1, len(own) - spread + 1))}
                for a in chosen:
                    seed.append(grams[own[a]])
                    item.append(k)
                    place.append(a)
            order = np.argsort(seed, kind="stable")
            seed_a = np.array(seed, np.int64)[order]
            unique, first = np.unique(seed_a, return_index=True)
            self.seeds[m] = (unique, np.append(first, len(seed_a)), np.array(item)[order], np.array(place)[order])

    def leaks(self, data: bytes, least: float = LEAST) -> list[tuple[int, float, int, int, int]]:
        """(item id, score, first word, word after the last, seeds met) of each item that the text leaks."""
        ids = self.encode(data)
        starts: dict[int, list[int]] = {}
        for m, (unique, first, item, place) in self.seeds.items():
            got = codes(ids, m, self.base)
            at = np.minimum(np.searchsorted(unique, got), len(unique) - 1)
            for p in np.flatnonzero(unique[at] == got).tolist():
                for s in range(first[at[p]], first[at[p] + 1]):
                    starts.setdefault(int(item[s]), []).append(p - int(place[s]))
        out = []
        for k, found in sorted(starts.items()):
            x = self.items[k]
            reach = len(x) // 2 + 8
            found.sort()
            best = (0.0, 0, 0)
            a = 0
            while a < len(found):  # starts within reach of each other share an alignment
                b = a
                while b + 1 < len(found) and found[b + 1] - found[b] <= reach:
                    b += 1
                lo, hi = max(0, found[a] - reach), min(len(ids), found[b] + len(x) + reach)
                score, end = smith_waterman(x, ids[lo:hi])
                if score / (MATCH * len(x)) > best[0]:
                    back, tail = smith_waterman(x[::-1], ids[lo : lo + end][::-1])
                    best = (score / (MATCH * len(x)), lo + end - (tail if back == score else end), lo + end)
                a = b + 1
            if best[0] >= least:
                out.append((self.ids[k], *best, len(found)))
        return out


def blocks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The items in blocks, with seeds chosen by document frequencies over all docs.

    A block comes to the driver and goes to every task; its size is bounded by
    block_bytes (on average: items are dealt by hash), the number of blocks
    grows with the benchmark. Of the corpus only one count for each n-gram of
    the block is gathered.
    """
    items = benchmark.select(F.col("item_id").cast("long"), utf8().alias("data"))
    total = items.agg(F.sum(F.length("data"))).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    texts = docs.select(utf8().alias("data"))
    for number in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "data"), F.lit(count)) == number).orderBy("item_id", "data").collect()
        todo = [[(r.item_id, bytes(r.data)) for r in part]]
        while todo:
            items_ = todo.pop()
            try:
                block = Block(items_)
            except OverflowError:
                if len(items_) < 2:
                    raise
                todo += [items_[: len(items_) // 2], items_[len(items_) // 2 :]]
                continue
            if block.sizes:
                block.choose(_frequencies(texts, block))
                yield block


def _frequencies(texts: DataFrame, block: Block) -> dict[tuple[int, int], int]:
    """(size, index of the n-gram) -> documents that have it."""
    schema = pa.schema([("m", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])

    def count_in(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {m: np.zeros(len(g), np.int64) for m, g in block.grams.items()}
        for batch in batches:
            for data in batch.column("data"):
                for m, at in block.present(data.as_py()):
                    sums[m][at] += 1
        for m, s in sums.items():
            at = np.flatnonzero(s)
            yield table({"m": np.full(len(at), m, np.int32), "gram": at, "n": s[at]}, schema)

    counted = texts.mapInArrow(count_in, "m int, gram long, n long").groupBy("m", "gram").agg(F.sum("n").alias("n")).toArrow()
    return dict(zip(zip(counted.column("m").to_pylist(), counted.column("gram").to_pylist(), strict=True), counted.column("n").to_pylist(), strict=True))


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word, n_seeds) for each document and item it leaks."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("n_seeds", pa.int64())])
    ddl = "doc_id long, item_id long, score double, first_word long, last_word long, n_seeds long"
    rows = docs.select(F.col("doc_id").cast("long"), utf8().alias("data"))
    out = None
    for block in blocks(docs, benchmark, block_bytes):

        def run(batches: Iterable[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(i, k, score, a, b - 1, n) for i, data in zip(batch.column("doc_id").to_pylist(), batch.column("data"), strict=True) for k, score, a, b, n in block.leaks(data.as_py(), least)]
                if found:
                    yield table(dict(zip(schema.names, map(list, zip(*found, strict=True)), strict=True)), schema)

        one = rows.mapInArrow(run, ddl)
        out = one if out is None else out.unionByName(one)
    return docs.sparkSession.createDataFrame([], ddl) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs that leak no item, with all their columns."""
    out = docs
    for block in blocks(docs, benchmark, block_bytes):

        @F.pandas_udf("boolean")
        def free(data, block=block):  # noqa: ANN001, ANN202
            return data.map(lambda d: not block.leaks(d, least)).astype(bool)

        out = out.where(free(utf8()))
    return out
