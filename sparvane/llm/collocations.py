"""Phrases whose words keep company, from position bitmaps.

The corpus is cut into shards of at most ``SHARD`` positions of one language.
A word takes a position, and the end of a piece leaves one empty, so a phrase
never crosses it. In a shard each word has the bitmap of its positions, kept as
its non-empty blocks of 64 bits and compressed; a shard is one row.

A bitmap shifted by a position and cut (AND) with a word's bitmap is the bitmap
of the phrase with that word added, and its popcount the occurrences in the
shard. A shard's blocks are walked a stretch at a time. Within a stretch
phrases grow depth-first, from the bitmaps of words to those of the phrases of
k words; these are counted, and nothing but counts leaves the stretch. The
phrases that cover a block meet its words in one matrix operation.

Frequent words are numbered once for all shards, so that a phrase moves as the
numbers of its words and equal phrases have equal numbers: no text and no hash
stands for a phrase. For each length a shard deals its phrases and their counts
to blocks, packed columns of numbers, a block for each part that the phrase's
numbers name; a part's blocks of all shards are added up together.

A phrase can be frequent only where its first and its last k - 1 words are, so
a shard is sent back those of its phrases that are frequent over all shards,
and grows no others: shards are first rewritten with their frequent words
alone, from which bigrams grow, a trigram grows from frequent bigrams, and so
on. One of the shards that hold a phrase is sent its sum too, and spells it.

A phrase's score is 2,000,000 times its count by the sum of the counts of its
two parts, at its worst cut. Phrases that occur mostly inside a longer one are
dropped.

A shard that fills within a piece is ended all the same; the next begins
with a copy of the last words of it, whose own occurrences are not counted
again. No driver memory, broadcast or group grows with the corpus: groups by
shard are bounded by its size, and there are as many parts as make some
``PART_PHRASES`` phrases each; of one phrase a part has one for each shard.

Cases: null text is empty; null language is ``und``; repeated rows count
each; doc_ids play no part; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparvane.llm.common import materialize, materialize_by, utf8

LEAST, LONGEST, TOP = 30, 4, 2000
#: Scores are counts by counts times this.
SCALE = 2_000_000
#: A phrase goes where a longer one has at least this share of its occurrences, in percent.
WITHIN = 80
#: Positions of a shard, positions of all open shards of a task, blocks of a stretch, bytes of text read at a time.
SHARD, OPEN, STRETCH, PART = 1 << 22, 1 << 23, 256, 1 << 22
#: Phrases of a part at most, as all positions of a corpus begin a different one; parts of the words' numbering for each shuffle partition.
PART_PHRASES, NUMBERED = 1 << 22, 8
#: Bytes of input that a task reads at least: the larger a shard, the fewer of its phrases are told apart from other shards' same ones.
READ_BYTES = 64 << 20
UNKNOWN = "und"
#: The id of the end of a piece.
GAP = 0

#: Bytes as read: A-Z in lower case, tab as space, ends of pieces as full stops.
READ = bytes(ord(".") if chr(b) in ".,;:!?\n\x0b\x0c\r" else ord(" ") if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
SHARD_SCHEMA = "lang string, shard long, lead int, size long, words array<string>, counts array<long>, splits binary, blocks binary, bits binary"
PRUNED_SCHEMA = "lang string, shard long, lead int, size long, words array<string>, ids binary, splits binary, blocks binary, bits binary"
PRUNED = pa.schema([("lang", pa.string()), ("shard", pa.int64()), ("lead", pa.int32()), ("size", pa.int64()), ("words", pa.list_(pa.string())), ("ids", pa.binary()), ("splits", pa.binary()), ("blocks", pa.binary()), ("bits", pa.binary())])
#: Phrases of one shard and part: columns of word numbers one after another, and the counts in the shard.
BLOCK_SCHEMA = "shard long, part long, numbers binary, n binary"
BLOCK = pa.schema([("shard", pa.int64()), ("part", pa.int64()), ("numbers", pa.binary()), ("n", pa.binary())])
#: Those of them that are frequent, with the sum over all shards where this shard spells the phrase, else 0.
FOUND_SCHEMA = "shard long, k int, numbers binary, f binary"
FOUND = pa.schema([("shard", pa.int64()), ("k", pa.int32()), ("numbers", pa.binary()), ("f", pa.binary())])
SPELT_SCHEMA = "lang string, words int, phrase string, f long"
SPELT = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


class Open:
    """A shard being filled."""

    def __init__(self, context: list[bytes]) -> None:
        self.ids: dict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.ids[b"."]
        self.parts, self.size, self.lead = [], 0, len(context)
        self.add(context)

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def tail(self, n: int) -> list[bytes]:
        """The last words, as far as they are of one piece, n at most."""
        names, out = list(self.ids), []
        for part in reversed(self.parts):
            for x in part[::-1][: n - len(out)].tolist():
                if x == GAP:
                    return out[::-1]
                out.append(names[x])
            if len(out) >= n:
                break
        return out[::-1]

    def row(self, lang: str, number: int) -> dict:
        """The shard's row: words in the order of their ids, each with its blocks. The shard is empty after it."""
        # what is done with goes at once: a shard's arrays are as large as all else a task holds
        names = [w.decode("utf-8", "replace") for w in list(self.ids)[1:]]
        self.ids.clear()
        at, self.parts = np.concatenate(self.parts), []
        where = np.flatnonzero(at != GAP).astype(np.int32)
        where = where[np.argsort(at[where], kind="stable")]
        word = at[where] - 1
        del at
        key = word.astype(np.int64)
        key <<= 32
        key |= where >> 6
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        key = key[first]
        n = len(names)
        counts = np.bincount(word[where >= self.lead], minlength=n)
        del word
        bits = (where & 63).astype(np.uint64)
        np.left_shift(np.uint64(1), bits, out=bits)
        bits = np.bitwise_or.reduceat(bits, first) if len(first) else bits
        splits = np.searchsorted(key >> 32, np.arange(n + 1))
        return {
            "lang": lang, "shard": number, "lead": self.lead, "size": self.size, "words": names, "counts": counts,
            "splits": packed(splits.astype(np.uint32)), "blocks": packed((key & 0xFFFFFFFF).astype(np.uint32)), "bits": packed(bits),
        }


def packed(values: np.ndarray) -> bytes:
    """Compressed, with the size before it; equal bytes of neighbouring values stand together."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=n * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).reshape(n)


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """A text's words and ends of pieces, with an end behind the last, some at a time."""
    text = text.translate(READ).replace(b".", b" . ") + b" ."
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PART)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _joined_splits(docs: DataFrame) -> DataFrame:
    """docs in fewer partitions where the session's splits of files are below ``READ_BYTES``; nothing is shuffled."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", docs.sparkSession.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    times = READ_BYTES // max(1, int(number) << 10 * " kmgt".index(unit or " "))
    return docs.coalesce(-(-docs.rdd.getNumPartitions() // times)) if times > 1 else docs


def shards(docs: DataFrame, longest: int = LONGEST, size: int = SHARD, most: int = OPEN) -> DataFrame:
    """The corpus as position bitmaps, one row per shard.

    most: positions that a task holds in shards not yet full; beyond it the largest is ended.
    """
    rows = _joined_splits(docs).select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), utf8().alias("data"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("shard", pa.int64()), ("lead", pa.int32()), ("size", pa.int64()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("splits", pa.binary()), ("blocks", pa.binary()), ("bits", pa.binary())])
        number = TaskContext.get().partitionId() << 32
        found: dict[str, Open] = {}
        held = 0

        def close(lang: str) -> pa.RecordBatch:
            nonlocal number, held
            shard = found.pop(lang)
            held -= shard.size - shard.lead
            number += 1
            return pa.RecordBatch.from_pylist([shard.row(lang, number)], schema)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("data"), strict=True):
                for words in words_of(text.as_py()):
                    at = 0
                    while at < len(words):
                        shard = found.get(lang) or found.setdefault(lang, Open([]))
                        part = words[at : at + size - shard.size]
                        shard.add(part)
                        at += len(part)
                        held += len(part)
                        if shard.size >= size:
                            tail = shard.tail(longest - 1)
                            yield close(lang)
                            if tail:
                                found[lang] = Open(tail)
                while held > most:
                    yield close(max(found, key=lambda x: found[x].size))
        for lang in list(found):
            yield close(lang)

    return rows.mapInArrow(run, SHARD_SCHEMA)


class Blocks:
    """Bitmaps of several nodes, sorted by block."""

    def __init__(self, node: np.ndarray, block: np.ndarray, bits: np.ndarray, n_blocks: int) -> None:
        order = np.argsort(block, kind="stable")
        self.node, self.bits = node[order], bits[order]
        self.starts = np.searchsorted(block[order], np.arange(n_blocks + 1))

    def matrix(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, bits) of blocks first to last - 1, a row each, padded by empty bitmaps."""
        return padded(self.node[self.starts[first] : self.starts[last]], self.bits[self.starts[first] : self.starts[last]], np.diff(self.starts[first : last + 1]))


def padded(node: np.ndarray, bits: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.arange(int(lengths.max(initial=0))) < lengths[:, None]
    nodes, values = np.zeros(inside.shape, np.int64), np.zeros(inside.shape, np.uint64)
    nodes[inside], values[inside] = node, bits
    return nodes, values


def step(nodes: np.ndarray, bits: np.ndarray, words: np.ndarray, word_bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(block row, node, word, bits) of every phrase with a word behind it: shift by a position, AND."""
    over = bits >> np.uint64(63) != 0  # a bit that leaves its block enters the next one; a block has at most one
    carry_node, carry = np.zeros((len(bits), 1), np.int64), np.zeros((len(bits), 1), np.uint64)
    row, column = np.nonzero(over[:-1])
    carry_node[row + 1, 0], carry[row + 1, 0] = nodes[row, column], 1
    nodes = np.concatenate([nodes, carry_node], axis=1)
    shifted = np.concatenate([bits << np.uint64(1), carry], axis=1)
    both = (shifted[:, :, None] & word_bits[:, None, :]).ravel()
    at = np.flatnonzero(both)
    wide = words.shape[1]
    left = at // max(1, wide)
    row = left // nodes.shape[1]
    return row, nodes.ravel()[left], words.ravel()[row * wide + at - left * wide], both[at]


class Lookup:
    """Position of rows of ids among known distinct ones, -1 where unknown."""

    def __init__(self, head: np.ndarray, word: np.ndarray, width: int) -> None:
        self.width = width
        self.keys, self.of = np.unique(head.astype(np.int64) * width + word, return_inverse=True)

    def __call__(self, head: np.ndarray, word: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(head), -1)
        keys = head.astype(np.int64) * self.width + word
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (head >= 0), at, -1)


def grown(shard: dict, phrases: pa.Array, k: int) -> tuple[pa.Array, np.ndarray]:
    """The phrases of k words in a shard, and their counts, that begin and end with the given phrases of k - 1 words; spelt."""
    names = pa.array(shard["words"], pa.string())
    parts = pc.list_flatten(pc.split_pattern(phrases, " ")) if k > 2 else phrases
    ids = pc.index_in(parts, value_set=names).to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(phrases), k - 1)
    head, tail, counts = grown_numbers(shard, ids, k)
    return pc.binary_join_element_wise(phrases.take(pa.array(head)), names.take(pa.array(tail)), " "), counts


def grown_numbers(shard: dict, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ids, word behind it, count) of the phrases of k words in a shard that begin and end with those of ids.

    ids: phrases of k - 1 words, a row each, by their words' places in the shard. A phrase that lies within the words
    copied from the shard before has the count 0: longer ones grow from it.
    """
    n_blocks = (shard["size"] + 63) // 64
    shape = ids.shape
    used, ids = np.unique(ids, return_inverse=True)  # from here on words are numbered among those of the phrases
    ids = ids.reshape(shape)
    number = np.full(len(shard["words"]), -1)
    number[used] = np.arange(len(used))
    splits = unpacked(shard["splits"], np.uint32).astype(np.int64)
    word = np.repeat(number, np.diff(splits))
    keep = word >= 0
    words = Blocks(word[keep], unpacked(shard["blocks"], np.uint32)[keep], unpacked(shard["bits"], np.uint64)[keep], n_blocks)
    # levels[j]: from (prefix of j words, next word) to the prefix of j + 1 words; the last one's numbers are those of the phrases
    levels, node = [], ids[:, 0]
    for j in range(1, k - 1):
        levels.append(Lookup(node, ids[:, j], len(used)))
        node = levels[-1].of
    place = np.argsort(node)  # node -> phrase
    suffix = ids[:, 1] if k > 2 else None
    for j in range(2, k - 1):
        suffix = levels[j - 2](suffix, ids[:, j])
    found = []
    for first in range(0, n_blocks, STRETCH):
        last, begin = min(first + STRETCH, n_blocks), max(first - 1, 0)  # one block more to the left: phrases that reach into the stretch
        word_nodes, word_bits = words.matrix(begin, last)
        nodes, bits = word_nodes, word_bits
        for level in levels:
            row, head, tail, both = step(nodes, bits, word_nodes, word_bits)
            now = level(head, tail)
            known = now >= 0
            nodes, bits = padded(now[known], both[known], np.bincount(row[known], minlength=last - begin))
        row, head, tail, both = step(nodes, bits, word_nodes, word_bits)
        fresh = row >= first - begin
        row, head, tail, both = row[fresh], head[fresh], tail[fresh], both[fresh]
        if first == 0 and shard["lead"]:
            both = np.where(row == 0, both & ~np.uint64((1 << shard["lead"]) - 1), both)
        if suffix is not None:  # the last k - 1 words must be frequent too
            known = levels[-1](suffix[place[head]], tail) >= 0
            head, tail, both = head[known], tail[known], both[known]
        found.append(head * len(used) + tail << 7 | np.bitwise_count(both).astype(np.int64))
    every = np.sort(np.concatenate(found) if found else np.zeros(0, np.int64))  # phrases, each with a popcount of 0 to 64 below it
    keys = every >> 7
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    keys, counts = keys[begin], np.add.reduceat(every & 127, begin) if len(begin) else begin
    return place[keys // max(1, len(used))], used[keys % max(1, len(used))], counts


def numbered(counted: DataFrame, least: int) -> DataFrame:
    """The rows (word and shard) whose count f over all shards is at least ``least``, with the word's number (id), the same in all shards."""
    parts = NUMBERED * int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counted.withColumn("part", F.pmod(F.xxhash64("lang", "phrase"), F.lit(parts))).repartition("part")
    summed = dealt.withColumn("f", F.sum("n").over(Window.partitionBy("part", "lang", "phrase"))).where(F.col("f") >= least)
    number = F.dense_rank().over(Window.partitionBy("part").orderBy("lang", "phrase")).cast("long")
    return summed.withColumn("id", (number - 1) * parts + F.col("part")).drop("n", "part")


def counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, size: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """((lang, words, phrase, f) of every phrase of up to ``longest`` words that occurs ``least`` times, (lang, n) with all occurrences of words)."""
    made = materialize(shards(docs, longest, size), "shards")
    counted = made.select("lang", "shard", F.posexplode(F.arrays_zip(F.col("words").alias("phrase"), F.col("counts").alias("n"))).alias("word", "w")).select("lang", "shard", "word", "w.phrase", "w.n")
    totals = made.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))
    parts = -(-(made.agg(F.sum("size")).first()[0] or 1) // PART_PHRASES)
    words = materialize(numbered(counted, least), "phrases-1")
    # from here on shards have frequent words only, and stay where they are: their phrases come to them
    kept = materialize_by(made.drop("words", "counts").groupBy("shard").cogroup(words.select("shard", "word", "phrase", "id").groupBy("shard")).applyInArrow(pruned, PRUNED_SCHEMA), "pruned", "shard")
    levels: list[DataFrame] = []
    for k in range(2, longest + 1):
        if k == 2:
            blocks = kept.mapInArrow(pairs_by(parts), BLOCK_SCHEMA)
        else:
            blocks = kept.groupBy("shard").cogroup(levels[-1].groupBy("shard")).applyInArrow(grow_by(k, parts), BLOCK_SCHEMA)
        levels.append(materialize(blocks.groupBy("part").applyInArrow(frequent_by(k, least), FOUND_SCHEMA), f"phrases-{k}"))
    table = words.select("lang", F.lit(1).alias("words"), "phrase", "f").distinct()
    if levels:
        found = levels[0]
        for x in levels[1:]:
            found = found.unionByName(x)
        table = table.unionByName(kept.groupBy("shard").cogroup(found.groupBy("shard")).applyInArrow(spelt, SPELT_SCHEMA))
    return materialize(table, "counts"), totals


def pruned(shard: pa.Table, words: pa.Table) -> pa.Table:
    """A shard with the given of its words, in order of their numbers over all shards."""
    if not words.num_rows:
        return PRUNED.empty_table()
    row, words = shard.to_pylist()[0], words.sort_by("id")
    at, ids = words.column("word").to_numpy(), words.column("id").to_numpy()
    if ids[-1] >= 1 << 32:
        raise OverflowError(f"a word's number, {ids[-1]}, is beyond 32 bits")
    splits = unpacked(row["splits"], np.uint32).astype(np.int64)
    n = np.diff(splits)[at]
    upto = np.cumsum(n)
    inside = np.arange(n.sum()) + np.repeat(splits[at] - upto + n, n)
    blobs = [packed(x) for x in (ids.astype(np.uint32), np.concatenate([[0], upto]).astype(np.uint32), unpacked(row["blocks"], np.uint32)[inside], unpacked(row["bits"], np.uint64)[inside])]
    return pa.Table.from_pylist([{"lang": row["lang"], "shard": row["shard"], "lead": row["lead"], "size": row["size"], "words": words.column("phrase").to_pylist(), "ids": blobs[0], "splits": blobs[1], "blocks": blobs[2], "bits": blobs[3]}], PRUNED)


def dealt(shard: dict, ids: np.ndarray, k: int, parts: int) -> pa.RecordBatch:
    """The phrases of k words that grow from those of ids, in blocks by part."""
    head, tail, n = grown_numbers(shard, ids, k)
    numbers = unpacked(shard["ids"], np.uint32)
    columns = [numbers[ids[head, j]] for j in range(k - 1)] + [numbers[tail]]
    mixed = np.zeros(len(n), np.uint64)
    for column in columns:
        mixed ^= column
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    part = (mixed % np.uint64(parts)).astype(np.min_scalar_type(parts))
    del mixed
    order = np.argsort(part, kind="stable")
    first = np.flatnonzero(np.bincount(part, minlength=1))
    begin = np.searchsorted(part[order], first)
    blocks = []
    for p, at in zip(first.tolist(), np.split(order, begin)[1:], strict=True):
        blocks.append({"shard": shard["shard"], "part": p, "numbers": packed(np.concatenate([c[at] for c in columns])), "n": packed(n[at].astype(np.uint32))})
    return pa.RecordBatch.from_pylist(blocks, BLOCK)


def pairs_by(parts: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Phrases of two words of shards that have frequent words only."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield dealt(row, np.arange(len(row["words"]))[:, None], 2, parts)

    return run


def grow_by(k: int, parts: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(shard: pa.Table, phrases: pa.Table) -> pa.Table:
        if not phrases.num_rows:
            return BLOCK.empty_table()
        row = shard.to_pylist()[0]
        known = np.concatenate([unpacked(x.as_py(), np.uint32).reshape(k - 1, -1) for x in phrases.column("numbers")], axis=1)
        ids = np.searchsorted(unpacked(row["ids"], np.uint32), known).T
        return pa.Table.from_batches([dealt(row, ids, k, parts)])

    return run


def frequent_by(k: int, least: int) -> Callable[[pa.Table], pa.Table]:
    """Of a part's blocks, the phrases with a sum over all shards of at least ``least``."""

    def run(blocks: pa.Table) -> pa.Table:
        columns = np.concatenate([unpacked(x.as_py(), np.uint32).reshape(k, -1) for x in blocks.column("numbers")], axis=1)
        each = [unpacked(x.as_py(), np.uint32) for x in blocks.column("n")]
        upto = np.cumsum([len(x) for x in each])
        n = np.concatenate(each).astype(np.int64)
        key = columns[0].astype(np.int64)
        for j in range(1, k):
            if j > 1:  # two numbers fill the key, so pairs are numbered again
                key = np.unique(key, return_inverse=True)[1]
            key = key << 32 | columns[j]
        order = np.argsort(key, kind="stable")
        key = key[order]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        f = np.add.reduceat(n[order], begin)
        enough = f >= least
        kept, sums = np.zeros(len(n), bool), np.zeros(len(n), np.uint64)
        kept[order] = np.repeat(enough, np.diff(np.append(begin, len(n))))
        sums[order[begin[enough]]] = f[enough]  # the first shard that has it
        found = []
        for shard, a, b in zip(blocks.column("shard").to_pylist(), [0, *upto[:-1].tolist()], upto.tolist(), strict=True):
            at = a + np.flatnonzero(kept[a:b])
            if len(at):
                found.append({"shard": shard, "k": k, "numbers": packed(columns[:, at].ravel()), "f": packed(sums[at])})
        return pa.Table.from_pylist(found, FOUND)

    return run


def spelt(shard: pa.Table, phrases: pa.Table) -> pa.Table:
    """The phrases whose sums were sent to a shard, in words."""
    if not phrases.num_rows:
        return SPELT.empty_table()
    lang, names = shard.column("lang")[0].as_py(), shard.column("words").chunk(0)[0].values
    ids, found = unpacked(shard.column("ids")[0].as_py(), np.uint32), []
    for row in phrases.to_pylist():
        f = unpacked(row["f"], np.uint64)
        own = np.flatnonzero(f)
        if len(own):
            numbers = unpacked(row["numbers"], np.uint32).reshape(row["k"], -1)[:, own]
            words = [names.take(pa.array(np.searchsorted(ids, x))) for x in numbers]
            found.append(pa.table([pa.array([lang] * len(own)), pa.array(np.full(len(own), row["k"], np.int32)), pc.binary_join_element_wise(*words, " "), pa.array(f[own].astype(np.int64))], schema=SPELT))
    return pa.concat_tables(found) if found else SPELT.empty_table()


def _exact(name: str) -> str:
    return f"CAST({name} AS DECIMAL(38, 0))"


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, within: int = WITHIN, size: int = SHARD) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases by score."""
    known, totals = counts(docs, least, longest, size)
    split = F.split("phrase", " ")
    phrases = known.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    # a phrase goes where a longer one holds most of its occurrences
    subs = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("words") - k + 1), lambda i: F.array_join(F.slice(split, i, k), " "))))
    inside = phrases.where("words > 2").select("lang", F.col("a").alias("f"), F.explode(F.array_distinct(subs)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    held = F.expr(f"100 * {_exact('longer')} >= {within} * {_exact('a')}")
    left = phrases.join(inside, ["lang", "phrase"], "left").where(~F.coalesce(held, F.lit(False)))
    cuts = left.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice(split, F.lit(1), F.col("k")), " ").alias("first"), F.array_join(F.slice(split, F.col("k") + 1, F.col("words")), " ").alias("rest"))
    one = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    two = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(one, ["lang", "first"]).join(two, ["lang", "rest"]).withColumn("score", F.expr(f"CAST(({SCALE} * {_exact('a')}) DIV ({_exact('l')} + {_exact('r')}) AS BIGINT)"))
    worst = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("w")).select("lang", "phrase", "w.*")
    # the first of each part of a language, then of the language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    some = worst.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
