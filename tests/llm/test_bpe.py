from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from sparvane.llm import bpe
from tests.llm.conftest import prose

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def library(path=PATH):
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def one_by_one(tokens: dict[bytes, int], piece: bytes) -> list[int]:
    """The leftmost pair of least rank again and again."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((tokens.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
        if rank == 1 << 40:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [tokens[x] for x in parts]


def test_pair_table():
    words = bpe.encoder(PATH, PATTERN)
    rng = random.Random(0)
    tokens = rng.sample(list(words.tokens), 3000)
    by_id = {v: k for k, v in words.tokens.items()}
    a = np.array([rng.randrange(-1, 50256) for _ in tokens] + [words.tokens[x[:1]] for x in tokens])
    b = np.array([rng.randrange(-1, 50256) for _ in tokens] + [words.tokens.get(x[1:], -1) for x in tokens])
    expected = [words.tokens.get(by_id[x] + by_id[y], bpe.NONE) if x >= 0 and y >= 0 else bpe.NONE for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    assert words.pairs.ranks(a, b).tolist() == expected and sum(x != bpe.NONE for x in expected) > 500


@pytest.mark.parametrize("file", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_random_texts_equal_the_library(file):
    path = public_tokenizers.path(file)
    words, other = bpe.Encoder(path, PATTERN), library(path)
    rng = random.Random(1)
    alphabets = ["abcdefghij ", "aA1 .'\n\t\r", "  ", "日本語中文字", "éèêëàñß ", "\U0001f600\U0001f468‍ a", "'s't'll ", "=-_*/", "0123456789", "​\xa0　\x85 a", "aaab", "<|endoftext|>"]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(rng.choice(a) for _ in range(rng.choice([3, 30, 300, 2000]))) for a in alphabets * 12]
    assert [ids_of(x) for x in words.encode(texts)] == [other.encode_ordinary(t) for t in texts]


def test_a_vocabulary_whose_merges_undercut_each_other():
    """Ranks out of the order in which merges arise: pairs that arise may rank below the pair just merged."""
    rng = random.Random(2)
    for _ in range(60):
        made = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))).encode() for _ in range(30)}
        names = [bytes([b]) for b in range(256)]
        more = sorted(made)
        rng.shuffle(more)
        tokens = {x: i for i, x in enumerate(names + more)}
        pairs = bpe.Pairs(tokens)
        texts = ["".join(rng.choice("abc" if k % 3 else "aab") for _ in range(rng.randint(2, 64))).encode() for k in range(40)]
        single = np.arange(256, dtype=np.int32)
        width = max(map(len, texts))
        ids = np.full((len(texts), width), -1, np.int32)
        for i, t in enumerate(texts):
            ids[i, : len(t)] = single[np.frombuffer(t, np.uint8)]
        got = {}
        for rows, found in bpe.merge_rows(ids, pairs):
            got |= {r: [x for x in f if x >= 0] for r, f in zip(rows.tolist(), found.tolist(), strict=True)}
        expected = [one_by_one(tokens, t) for t in texts]
        assert [got[i] for i in range(len(texts))] == expected
        assert [bpe.merge_long(single[np.frombuffer(t, np.uint8)], pairs).tolist() for t in texts] == expected


def test_long_pieces_and_long_texts(monkeypatch):
    words, other = bpe.Encoder(PATH, PATTERN), library()
    rng = random.Random(3)
    texts = ["x" * 100_001, " " * 5000 + "a", "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3000)), "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(3000)), "=" * 257, prose(300, 4)]
    expected = [other.encode_ordinary(t) for t in texts]
    assert [ids_of(x) for x in words.encode(texts)] == expected
    monkeypatch.setattr(bpe, "WHOLE", 50)
    monkeypatch.setattr(bpe, "STRETCH", 7)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 20)
    monkeypatch.setattr(bpe, "BATCH_IDS", 11)
    words = bpe.Encoder(PATH, PATTERN)
    assert [ids_of(x) for x in words.encode(texts)] == expected
    assert [words.decode(np.frombuffer(x, "<u4")) for x in words.encode(texts)] == [t.encode() for t in texts]


def test_odd_rows(odd, empty, make):
    other = library()
    rows = odd.collect()
    got = bpe.digests(odd, PATH, PATTERN).collect()
    expected = []
    for r in rows:
        ids = other.encode_ordinary(r.text or "")
        expected.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert bpe.digests(empty, PATH, PATTERN).collect() == []


def test_columns(make):
    docs = make(["a b", None], [1, None]).withColumn("IDS", F.lit(3)).withColumn("decoded", F.lit("x")).withColumn("a b", F.array(F.lit(1)))
    there = bpe.encode(docs, PATH, PATTERN)
    assert there.columns == ["doc_id", "lang", "source", "n_chars", "decoded", "a b", "n_tokens", "ids"]
    back = bpe.decode(there, PATH, PATTERN)
    assert sorted((bytes(r.decoded), r["a b"]) for r in back.collect()) == [(b"", [1]), (b"a b", [1])]
