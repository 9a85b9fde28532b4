"""Byte-level BPE encoding and decoding by rounds over padded matrices.

A text is cut by the tokenizer's pattern into pieces; no merge crosses a
piece. The distinct pieces of a batch are dealt to buckets by length, a power
of two each, and a bucket is a matrix with a row for each piece, a column for
each token, padded on the right, that starts with the ids of single bytes.
Beside it stand the ranks of neighbouring tokens, looked up in a hash table of
pairs. In each round every row merges its leftmost pair of least rank; all
rows then have one token less, so the matrix is compacted by a column, and
only the two pairs beside a merge are looked up again. Rows without a pair
leave the matrix. A piece beyond ``LONG`` bytes is a matrix of one row; there
a round also merges the same pair further right, unless a pair that arises
has a lower rank, in which case only the leftmost is merged: either way the
merges are those of one after another, in far fewer rounds.

A vocabulary of ranks says which pairs merge: tokens a and b do where the
bytes of both together are a token, whose rank is the pair's.

Nothing is shuffled; a task holds one batch, a bounded memory of pieces met
before, and of a long text one stretch of pieces at a time. A lost task gives
the same ids again.

Cases: null text is empty and has no ids; strings of special tokens are
ordinary text; repeated rows and ids are encoded each; an empty table gives
an empty result; other columns of the input are kept, unless they bear the
name of a result column, which then replaces them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparvane.llm.common import slices, without

NONE = np.int32(np.iinfo(np.int32).max)
#: Pieces of more bytes are matrices of one row.
LONG = 256
#: Cells of a matrix.
CELLS = 1 << 21
#: Pieces remembered by a worker, and the longest of them in code points.
CACHE_PIECES, CACHE_CHARS = 400_000, 48
#: Code points up to which a text is cut into pieces at once, and pieces taken at a time from a longer one.
WHOLE, STRETCH = 1 << 18, 1 << 16
#: Bytes of text encoded, and ids decoded, at a time.
BATCH_BYTES, BATCH_IDS = 4 << 20, 1 << 20


class Pairs:
    """Pair of ids -> rank of the token they make, as an open hash table in arrays."""

    def __init__(self, tokens: dict[bytes, int]) -> None:
        found = {}
        for token, rank in tokens.items():
            for cut in range(1, len(token)):
                a, b = tokens.get(token[:cut]), tokens.get(token[cut:])
                if a is not None and b is not None:
                    found[a << 32 | b] = rank
        keys = np.fromiter(found.keys(), np.int64, len(found))
        values = np.fromiter(found.values(), np.int32, len(found))
        self.bits = max(4, (4 * len(found)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] == -1
            _, first = np.unique(at[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[at[put]], self.values[at[put]] = keys[put], values[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            keys, values, at = keys[left], values[left], (at[left] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it is no token or one side is padding (-1)."""
        keys = a.astype(np.int64) << 32 | (b.astype(np.int64) & 0xFFFFFFFF)
        keys[(a < 0) | (b < 0)] = -2
        flat = keys.ravel()
        at = self._slot(flat)
        out = np.full(len(flat), NONE, np.int32)
        open_ = np.arange(len(flat))
        while len(open_):
            seen = self.keys[at[open_]]
            hit = seen == flat[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (seen != -1)]
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
        return out.reshape(keys.shape)


def merge_rows(ids: np.ndarray, pairs: Pairs) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their ids, padded) of a matrix of byte ids, as rows come to an end."""
    rows = np.arange(len(ids))
    ranks = pairs.ranks(ids[:, :-1], ids[:, 1:])
    done = []
    while len(rows):
        if ids.shape[1] == 1:
            done.append((rows, ids))
            break
        at = ranks.argmin(axis=1)  # the leftmost of equal ranks
        best = ranks[np.arange(len(rows)), at]
        ended = best == NONE
        if ended.any():
            done.append((rows[ended], ids[ended]))
            go = ~ended
            rows, ids, ranks, at, best = rows[go], ids[go], ranks[go], at[go], best[go]
            if not len(rows):
                break
        n, width = ids.shape
        line = np.arange(n)
        ids[line, at] = best
        keep = np.ones((n, width), bool)
        keep[line, at + 1] = False
        ids = ids[keep].reshape(n, width - 1)
        keep = np.ones((n, width - 1), bool)
        keep[line, at] = False
        ranks = ranks[keep].reshape(n, width - 2)
        left = at > 0
        ranks[line[left], at[left] - 1] = pairs.ranks(ids[line[left], at[left] - 1], ids[line[left], at[left]])
        right = at < width - 2
        ranks[line[right], at[right]] = pairs.ranks(ids[line[right], at[right]], ids[line[right], at[right] + 1])
    return done


def merge_long(ids: np.ndarray, pairs: Pairs) -> np.ndarray:
    """Ids of one long piece from its byte ids."""
    ranks = pairs.ranks(ids[:-1], ids[1:])
    while len(ranks):
        best = ranks.min()
        if best == NONE:
            break
        at = np.flatnonzero(ranks == best)
        if len(at) > 1:  # of pairs that overlap, as in aaaa, every second
            run = np.concatenate([[True], np.diff(at) > 1])
            start = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - start) % 2 == 0]
        for places in (at, at[:1]):
            new = ids.copy()
            new[places] = best
            keep = np.ones(len(ids), bool)
            keep[places + 1] = False
            new = new[keep]
            now = places - np.arange(len(places))
            fresh = np.delete(ranks, places)
            for beside in (now[now > 0] - 1, now[now < len(new) - 1]):
                fresh[beside] = pairs.ranks(new[beside], new[beside + 1])
            # a pair arises to the left of each merge, and to its right with what stood there before the next one
            after = places[places + 2 < len(ids)] + 2
            arisen = np.concatenate([fresh[now[now > 0] - 1], pairs.ranks(np.full(len(after), best), ids[after])])
            if len(places) == 1 or not len(arisen) or arisen.min() > best:
                break
        ids, ranks = new, fresh
    return ids


class Encoder:
    """Texts to ids and back under a file of ranks (base64 of a token's bytes, a space, its rank, one a line)."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            self.tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
        self.bytes_ids = np.array([self.tokens[bytes([b])] for b in range(256)], np.int32)
        self.pairs = Pairs(self.tokens)
        self.pattern = regex.compile(pattern)
        by_id = [b""] * (max(self.tokens.values()) + 1)
        for token, rank in self.tokens.items():
            by_id[rank] = token
        self.lengths = np.array([len(x) for x in by_id], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)
        self.known: dict[str, bytes] = {}
        self.passing: list[str] = []

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, little-endian unsigned 32-bit."""
        out: list[bytes | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.tokens.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > LONG:
                out[i] = merge_long(self.bytes_ids[np.frombuffer(piece, np.uint8)], self.pairs).astype("<u4").tobytes()
            else:
                buckets.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for size, members in buckets.items():
            width = 1 << size
            for a in range(0, len(members), max(1, CELLS // width)):
                part = members[a : a + max(1, CELLS // width)]
                lengths = np.array([len(pieces[i]) for i in part])
                ids = np.full((len(part), width), -1, np.int32)
                ids[np.arange(width) < lengths[:, None]] = self.bytes_ids[np.frombuffer(b"".join(pieces[i] for i in part), np.uint8)]
                for rows, found in merge_rows(ids, self.pairs):
                    n = (found >= 0).sum(axis=1).tolist()
                    data, step = found.astype("<u4").tobytes(), 4 * found.shape[1]
                    for k, row in enumerate(rows.tolist()):
                        out[part[row]] = data[k * step : k * step + 4 * n[k]]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; a piece that texts have in common is merged once."""
        out = [b""] * len(texts)
        cut = {i: self.pattern.findall(t) for i, t in enumerate(texts) if len(t) <= WHOLE}
        self._learn(cut.values())
        for i, pieces in cut.items():
            out[i] = b"".join(map(self.known.__getitem__, pieces))
        for i, text in enumerate(texts):
            if i not in cut:
                parts, matches = [], self.pattern.finditer(text)
                while pieces := [m.group() for m in islice(matches, STRETCH)]:
                    self._learn([pieces])
                    parts.append(b"".join(map(self.known.__getitem__, pieces)))
                out[i] = b"".join(parts)
        return out

    def _learn(self, texts: Iterable[list[str]]) -> None:
        """Merge the pieces not met before; long ones are remembered until the next call."""
        for x in self.passing:
            self.known.pop(x, None)
        if len(self.known) > CACHE_PIECES:
            self.known = {}
        fresh = list(set().union(*texts).difference(self.known))
        self.passing = [x for x in fresh if len(x) > CACHE_CHARS]
        self.known.update(zip(fresh, self._merged([x.encode("utf-8", "surrogatepass") for x in fresh]), strict=True))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, by one gather for each ``BATCH_IDS`` ids."""
        parts = []
        for a in range(0, len(ids), BATCH_IDS):
            part = ids[a : a + BATCH_IDS].astype(np.int64)
            n = self.lengths[part]
            begin = np.cumsum(n) - n
            parts.append(self.flat[np.arange(int(n.sum())) + np.repeat(self.starts[part] - begin, n)].tobytes())
        return b"".join(parts)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One a worker for each file."""
    return Encoder(path, pattern)


def encode(df: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """The rows without their text, with n_tokens (long) and ids (binary: little-endian unsigned 32-bit integers).

    vocabulary: a file of ranks, the same path on every machine; pattern: what cuts a text into pieces.
    """
    kept = df.select(*without(df, {text.lower(), "n_tokens", "ids"}), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary, pattern)
        for batch in batches:
            for part in slices(batch, batch.column(batch.num_columns - 1), BATCH_BYTES):
                ids = words.encode(part.column(part.num_columns - 1).to_pylist())
                found = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(part.columns[:-1] + found, [f.name for f in schema])

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, pattern: str, ids: str = "ids") -> DataFrame:
    """The rows with decoded (binary), the bytes of their tokens; null ids are none."""
    kept = df.select(*without(df, {"decoded", ids.lower()}), F.coalesce(F.col(ids), F.lit(b"")).alias(ids))
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary, pattern)
        for batch in batches:
            for part in slices(batch, batch.column(batch.num_columns - 1), BATCH_BYTES):
                decoded = [words.decode(np.frombuffer(x.as_py(), "<u4")) for x in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], [f.name for f in schema])

    return kept.mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, encoded and decoded again."""
    there = encode(docs.select(F.col("doc_id").cast("long"), F.col("text")), vocabulary, pattern)
    back = decode(there, vocabulary, pattern)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
