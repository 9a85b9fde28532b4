"""Order-preserving packing by dynamic programming over window cuts.

Documents are tokenised and laid end to end in their order within each input
partition. A window of at most ``size`` tokens may end at a document end (no
penalty) or at a sentence end (a truncation penalty); inside a stretch of
more than half a window without either it may end anywhere at a larger
penalty. With f(j) the least cost of all tokens before cut j,

    f(j) = penalty(j) + size - at(j) + min over i of (f(i) + at(i)),

where at(j) - at(i) <= size; the minimum over that sliding range of cuts is
kept in a monotone queue, so a stretch of n cuts takes O(n). A window whose
length is a power of two needs no padding; such windows are tried too, above
a least length.

Each partition is read as a stream and solved in blocks of about
``BLOCK_TOKENS`` tokens, the unfinished last window going on into the next
block, so memory is bounded whatever the length of a document; only the
last window of a partition may have much padding. Nothing is shuffled, and a
lost task gives the same windows again.

Cases: null text is an empty document, one end token long; repeated rows are
packed each; very long documents span windows; the string of an added token
is that token; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparvane.llm.common import slices, table

SIZE = 1024
END = 0
SENTENCE_PENALTY = 1
ANYWHERE_PENALTY = 16
BLOCK_TOKENS = 1 << 20
#: Chunks remembered by a worker, and code points in all of them.
CACHE_WORDS, CACHE_CHARS = 400_000, 16_000_000
#: Bytes of text encoded at a time.
BATCH_BYTES = 4 << 20

#: Fixed value: the published pattern by which the byte-level tokenizer cuts a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_chars() -> dict[str, int]:
    """The byte-level alphabet's characters: printable Latin-1 stands for itself, the other bytes follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Ids of texts under a byte-level tokenizer file.

    The file's merges are run by the faster of two encoders of one
    vocabulary; a file whose ids do not follow its merges is refused. The
    strings of the file's added tokens stand for these tokens wherever they
    occur in a text, as the file's library reads them by default. Most of
    a text is cut at single spaces, where its pieces are independent. A chunk
    between two of them is numbered when it is first met; the new ones of some
    texts are encoded at once, and the ids of all are gathered by number.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        chars = byte_chars()
        as_bytes = lambda token: bytes(chars[c] for c in token)
        ranks = {as_bytes(t): i for t, i in model["vocab"].items() if all(c in chars for c in t) and not t.startswith("<|")}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(model["vocab"][a + b] != 256 + k for k, (a, b) in enumerate(merges)):
            raise ValueError(f"{path}: ids do not follow the merges")
        self.ordinary = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        added = {x["content"]: x["id"] for x in file.get("added_tokens") or []}
        if any(x[k] for x in file.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip", "normalized") if k in x and not (k == "normalized" and file.get("normalizer") is None)):
            raise ValueError(f"{path}: added tokens that are not plain strings")
        self.added = {x: np.array([i], dtype="<u4") for x, i in added.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.ends = np.zeros(max([*ranks.values(), *added.values()]) + 1, dtype=bool)
        for token, i in ranks.items():
            self.ends[i] = token.endswith((b".", b"!", b"?", b"\n"))
        self.ends[list(added.values())] = True
        self.sizes = np.zeros(len(self.ends), np.int64)
        for token, i in ranks.items():
            self.sizes[i] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.chars = 0
        #: Of each chunk, by number: where its ids begin, how many they are, whether white space stands at one of its ends.
        self.first, self.length, self.uneven = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.flat = np.zeros(0, "<u4")

    def _learn(self) -> None:
        """Encode the chunks that have a number and no ids yet."""
        new = list(islice(self.numbers, len(self.first), None))
        if not new:
            return
        self.chars += sum(map(len, new))
        uneven = np.fromiter((not x or x[0].isspace() or x[-1].isspace() for x in new), bool, len(new))
        text = "".join([" " + x for x, bad in zip(new, uneven.tolist(), strict=True) if not bad])
        ids = self._ids(text)
        ends = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        begin = np.searchsorted(ends, np.append(np.flatnonzero(np.frombuffer(text.encode(), np.uint8) == 32), ends[-1]))
        first, length = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        first[~uneven], length[~uneven] = begin[:-1] + len(self.flat), np.diff(begin)
        self.first, self.length = np.concatenate([self.first, first]), np.concatenate([self.length, length])
        self.uneven, self.flat = np.concatenate([self.uneven, uneven]), np.concatenate([self.flat, ids])

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.ordinary(text), dtype="<u4")

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if not any(x in t for x in self.added for t in texts):
            return self._plain(texts)
        parts = [[t] if self.split is None else [x for x in self.split.split(t) if x] for t in texts]
        plain = iter(self._plain([x for p in parts for x in p if x not in self.added]))
        return [np.concatenate([np.zeros(0, "<u4"), *(self.added[x] if x in self.added else next(plain) for x in p)]) for p in parts]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without added tokens."""
        if len(self.numbers) >= CACHE_WORDS or self.chars >= CACHE_CHARS:
            self._forget()
        heads, chunks = [], []
        for text in texts:
            head, *rest = text.split(" ")
            heads.append(head)
            chunks.append(np.fromiter(map(self.numbers.__getitem__, rest), np.int64, len(rest)))
        self._learn()
        every = np.concatenate([np.zeros(0, np.int64), *chunks])
        upto = np.cumsum([0, *map(len, chunks)])
        n = np.concatenate([[0], np.cumsum(self.length[every])])
        ids = self.flat[np.arange(n[-1]) + np.repeat(self.first[every] - n[:-1], np.diff(n))]
        uneven = np.concatenate([[0], np.cumsum(self.uneven[every])])
        out = []
        for text, head, a, b in zip(texts, heads, upto[:-1].tolist(), upto[1:].tolist(), strict=True):
            # with white space beside a space the pieces on its two sides depend on each other
            if not head or head[0].isspace() or head[-1].isspace() or uneven[b] > uneven[a]:
                out.append(self._ids(text))
            else:
                out.append(np.concatenate([self._ids(head), ids[n[a] : n[b]]]))
        return out


@lru_cache(maxsize=2)
def vocabulary_of(path: str) -> Vocabulary:
    """One a worker for each file."""
    return Vocabulary(path)


def cuts(at: np.ndarray, penalty: np.ndarray, size: int, least: int) -> list[int]:
    """Positions of the best cuts, the first (0) and the last of ``at`` included.

    at: candidate positions, ascending from 0, no two further apart than
    size. least: shortest window that may go unpadded as a power of two.
    """
    where = at.tolist()
    cost = penalty.tolist()
    n = len(where)
    best, back = [0.0] * n, [0] * n
    #: Cut -> cuts that lie a power of two before it
    before: dict[int, list[int]] = {}
    for power in (1 << k for k in range(size.bit_length()) if least <= 1 << k < size):
        there = np.searchsorted(at, at - power)
        for j in np.flatnonzero(at[there] == at - power).tolist():
            before.setdefault(j, []).append(int(there[j]))
    queue: deque[int] = deque([0])
    for j in range(1, n):
        here = where[j]
        while where[queue[0]] < here - size:
            queue.popleft()
        i = queue[0]
        value = best[i] + size - (here - where[i])
        if j in before:
            for k in before[j]:
                if best[k] + 1 < value:  # a window more is worth a token
                    i, value = k, best[k] + 1
        best[j], back[j] = value + cost[j], i
        key = best[j] + here
        while queue and best[queue[-1]] + where[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    chosen, j = [where[-1]], n - 1
    while j:
        j = back[j]
        chosen.append(where[j])
    return chosen[::-1]


def candidates(ends: np.ndarray, sentences: np.ndarray, total: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions 0 .. total and their penalties: document ends, sentence ends, and any token of a stretch too long without either."""
    at = np.unique(np.concatenate([[0], ends, sentences, [total]]))
    penalty = np.full(len(at), float(SENTENCE_PENALTY))
    penalty[np.isin(at, ends) | (at == total) | (at == 0)] = 0
    gaps = np.flatnonzero(np.diff(at) > size // 2)
    if len(gaps):
        more = np.concatenate([np.arange(at[g] + 1, at[g + 1]) for g in gaps])
        order = np.argsort(np.concatenate([at, more]), kind="stable")
        at = np.concatenate([at, more])[order]
        penalty = np.concatenate([penalty, np.full(len(more), float(ANYWHERE_PENALTY))])[order]
    return at, penalty


class Packer:
    """Streams documents of one partition into pieces."""

    def __init__(self, base: int, is_end: np.ndarray, size: int, block: int) -> None:
        self.base, self.is_end, self.size, self.block = base, is_end, size, block
        self.sequence = 0
        #: (doc_id, tokens of the document, start of these ids in it, ids), with ids not yet given to a window
        self.open: list[tuple[int | None, int, int, np.ndarray]] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        total = len(ids)
        for start in range(0, total, self.block):
            part = ids[start : start + self.block]
            self.open.append((doc_id, total, start, part))
            self.held += len(part)
            if self.held >= self.block:
                yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[tuple]:
        """Solve what is open; all windows but the last become final, or all of them."""
        if not self.held:
            return
        ids = np.concatenate([x[3] for x in self.open])
        upto = np.cumsum([len(x[3]) for x in self.open])
        ends = np.array([u for u, x in zip(upto, self.open, strict=True) if x[2] + len(x[3]) == x[1]], dtype=np.int64)
        sentences = np.flatnonzero(self.is_end[ids]) + 1
        at, penalty = candidates(ends, sentences, len(ids), self.size)
        chosen = cuts(at, penalty, self.size, self.size // 16)
        if not last and len(chosen) > 2:
            chosen.pop()
        piece, begin = 0, 0
        for a, b in zip(chosen, chosen[1:], strict=False):
            x = a
            while x < b:
                doc_id, total, start, part = self.open[piece]
                y = min(b, int(upto[piece]))
                inside = x - begin
                yield doc_id, start + inside, y - x, zlib.crc32(part[inside : inside + y - x].tobytes()), total, self.base + self.sequence, x - a
                x = y
                if y == upto[piece]:
                    begin, piece = y, piece + 1
            self.sequence += 1
        done = chosen[-1]
        self.held -= done
        rest = self.open[piece:]
        if rest and done > begin:
            doc_id, total, start, part = rest[0]
            rest[0] = (doc_id, total, start + done - begin, part[done - begin :])
        self.open = rest


def pack(docs: DataFrame, vocabulary: str, size: int = SIZE, block: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece of a document.

    vocabulary: the tokenizer's file, the same path on every machine.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary_of(vocabulary)
        end = np.array([END], dtype="<u4")
        packer = Packer(TaskContext.get().partitionId() << 40, words.ends, size, block)
        rows: list[tuple] = []
        for batch in batches:
            for part in slices(batch, batch.column("text"), BATCH_BYTES):
                found = words.encode_all([x or "" for x in part.column("text").to_pylist()])
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), found, strict=True):
                    rows += packer.add(doc_id, np.concatenate([ids, end]))
                    if len(rows) >= 20_000:
                        yield table(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)), schema)
                        rows = []
        rows += packer.flush(True)
        if rows:
            yield table(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)), schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ", ".join(f"{n} long" for n in names))
