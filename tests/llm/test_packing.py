from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparvane.llm import packing
from tests.llm.conftest import prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_tokenizers(tokenizer):
    words = packing.Vocabulary(PATH)
    texts = ["", " ", "a", " a b", "a ", "a  b", "a\n b", "a \nb", "it's  x", "x ² y ½", "a\x1cb c", "a b c", "<|endoftext|> x", "a <|endoftext|> b", "a b<|endoftext|>", "<|endoftext|>", "<|endoftext|><|endoftext|>  x <|endoftext|>\n", "<|endof text|> <|endoftext| >", "\U0001f600 é ", "a\tb c\t", prose(500, 1), "x" * 5000, "1234 56, 7!? -- \n\n z"]
    for _ in range(2):  # from the tokenizer, then from what is kept
        for t in texts:
            assert words.encode(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_new_chunks_are_encoded_at_once(tokenizer, monkeypatch):
    """One call of the encoder, not one for each new chunk."""
    words = packing.Vocabulary(PATH)
    encoder, calls = words.ordinary, []
    words.ordinary = lambda text: calls.append(text) or encoder(text)
    text = " ".join(f"{prose(1, k)}{k}é." for k in range(300))
    assert words.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(calls) <= 3
    # chunks are forgotten in between; texts of all kinds beside each other
    monkeypatch.setattr(packing, "CACHE_WORDS", 7)
    texts = ["", "a", text, "b  c", "x\n y", " z", "z ", "<|endoftext|>", "a <|endoftext|> b c", "\u2003 q", "a\u2003b c", prose(40, 2), "日本 \U0001f600 é"]
    for some in (texts, texts[::-1], texts[:1], []):
        assert [x.tolist() for x in words.encode_all(some)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in some]


def check(rows, texts, tokenizer, size):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    for i, t in texts.items():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    lengths = [sum(p.length for p in s) for s in by_sequence.values()]
    return sum(size - x for x in lengths if x & (x - 1)), sum(lengths)


@pytest.mark.parametrize("block", [packing.BLOCK_TOKENS, 3000])
def test_every_id_is_packed_once(make, tokenizer, block):
    rng = random.Random(2)
    texts = dict(enumerate([None, "", "a b", "<|endoftext|>", "x <|endoftext|> y<|endoftext|>" * 400, "x" * 9000, prose(5000, 1)] + [prose(rng.randint(1, 600), k) for k in range(150)]))
    rows = packing.pack(make(list(texts.values())).coalesce(1), PATH, 1024, block).collect()
    padding, total = check(rows, texts, tokenizer, 1024)
    assert padding < 0.05 * total


def test_cuts_are_optimal():
    rng = random.Random(4)
    for _ in range(60):
        at = np.cumsum([0, *(rng.randint(1, 9) for _ in range(12))])
        penalty = np.array([0.0, *(rng.choice([0.0, 1.0, 3.0]) for _ in range(11)), 0.0])
        size = 16
        got = packing.cuts(at, penalty, size, 10**9)
        best = [0.0] + [float("inf")] * 12
        for j in range(1, 13):
            best[j] = min(best[i] + size - (at[j] - at[i]) for i in range(j) if at[j] - at[i] <= size) + penalty[j]
        index = {int(p): k for k, p in enumerate(at)}
        cost = sum(size - (b - a) + penalty[index[b]] for a, b in zip(got, got[1:], strict=False))
        assert got[0] == 0 and got[-1] == at[-1] and cost == best[-1]


def test_odd_rows(odd, empty):
    rows = packing.pack(odd, PATH).collect()
    assert sum(r.length for r in rows if r.doc_id in (0, 1)) == 2
    assert packing.pack(empty, PATH).collect() == []


def test_other_vocabulary_is_refused(tmp_path):
    (tmp_path / "v.json").write_text('{"model": {"vocab": {"a": 0, "b": 1, "ab": 2}, "merges": ["a b"]}}')
    with pytest.raises(ValueError, match="merges"):
        packing.Vocabulary(str(tmp_path / "v.json"))
