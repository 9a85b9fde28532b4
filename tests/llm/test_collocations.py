from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sparvane.llm import collocations
from tests.llm.conftest import DOCS, prose

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def counted(rows, longest=4):
    """(language -> phrase -> occurrences) of every phrase, and of all words."""
    found, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    found.setdefault(lang, Counter())[" ".join(words[i : i + k])] += 1
    return found, n


def slow(rows, least, longest=4, top=2000):
    found, n = counted(rows, longest)
    out = []
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if a >= least and " " in p}
        ranked, longer = [], Counter()
        for q, b in candidates.items():
            words = q.split(" ")
            for i in range(len(words)):
                for j in range(i + 2, len(words) + (i > 0)):
                    p = " ".join(words[i:j])
                    longer[p] = max(longer[p], b)
        for p, a in candidates.items():
            words = p.split(" ")
            if 100 * longer[p] >= 80 * a:
                continue
            cuts = []
            for k in range(1, len(words)):
                l, r = f[" ".join(words[:k])], f[" ".join(words[k:])]
                cuts.append((2_000_000 * a // (l + r), k, l, r))
            score, _, l, r = min(cuts)
            ranked.append((-score, -a, p.encode(), (p, a, l, r, n[lang], score)))
        out += [(lang, i, *x[3]) for i, x in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], DOCS)


def corpus(seed, n, words=("a", "b", "c", "the", "Of", "é", "日本", "x-y", "\x1c", "\xa0")):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.choice([0, 1, 5, 40])):
            parts.append(rng.choice(words) if rng.random() < 0.8 else "new york stock Exchange")
            parts.append(rng.choice([" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "!?", "; "]))
        texts.append((rng.choice(["en", "fr", None, "und", "t\nr"]), "".join(parts)))
    return texts


@pytest.mark.parametrize("size", [1 << 20, 64, 9, 5])
def test_equals_brute_force(spark, size):
    """Whole shards, and shards that fill within pieces."""
    rows = corpus(1, 150)
    got = sorted(map(tuple, collocations.collocations(table(spark, rows).repartition(3), least=6, size=size).collect()))
    expected = slow(rows, 6)
    assert got == expected and len(got) > 30 and {r[0] for r in got} == {"en", "fr", "und", "t\nr"}


def test_phrases_move_in_blocks(spark, monkeypatch):
    """What is written for a length has a row for a shard and a part, not for a shard and a phrase; a phrase is spelt once."""
    rows, wrote = corpus(3, 150), {}
    write = collocations.materialize

    def noted(df, name):
        made = write(df, name)
        wrote[name] = made
        return made

    monkeypatch.setattr(collocations, "materialize", noted)
    monkeypatch.setattr(collocations, "PART_PHRASES", 1000, raising=False)
    got = sorted(map(tuple, collocations.collocations(table(spark, rows).repartition(3), least=6, size=200).collect()))
    assert got == slow(rows, 6)
    n, positions = wrote["shards"].count(), wrote["shards"].agg({"size": "sum"}).first()[0]
    parts = -(-positions // 1000)
    assert n > 10 and parts > 1
    for k in (2, 3, 4):
        assert 0 < wrote[f"phrases-{k}"].count() <= n * parts
    spelt = wrote["counts"].collect()
    found, _ = counted(rows)
    assert sorted((r.lang, r.words, r.phrase, r.f) for r in spelt) == sorted((lang, p.count(" ") + 1, p, c) for lang, f in found.items() for p, c in f.items() if c >= 6)


def test_growth_in_one_shard(monkeypatch):
    """Every phrase of a shard, over block and stretch ends, from all words."""
    for stretch in (1, 2, 256):
        monkeypatch.setattr(collocations, "STRETCH", stretch)
        for seed in range(4):
            rng = random.Random(seed)
            text = " ".join(rng.choice(["a", "b", "c", "."]) if rng.random() < 0.7 else "a" for _ in range(400))
            shard = collocations.Open([])
            for words in collocations.words_of(text.encode()):
                shard.add(words)
            row = shard.row("en", 0)
            row["counts"] = row["counts"].tolist()
            expected = counted([("en", text)])[0]["en"]
            known = dict(zip(row["words"], row["counts"], strict=True))
            assert known == {p: n for p, n in expected.items() if " " not in p}
            for k in (2, 3, 4):
                kept = [p for p in known if sum(map(ord, p)) % 7]
                phrases, n = collocations.grown(row, pa.array(kept), k)
                found = dict(zip(phrases.to_pylist(), n.tolist(), strict=True))
                assert found == {p: c for p, c in expected.items() if p.count(" ") == k - 1 and p.rsplit(" ", 1)[0] in kept and p.split(" ", 1)[1] in kept}
                known = found


def test_packed_values():
    for kind, values in ((np.uint32, [0, 1, 5, 2**32 - 1]), (np.uint64, [0, 2**63, 7]), (np.uint32, [])):
        a = np.array(values, kind)
        assert collocations.unpacked(collocations.packed(a), kind).tolist() == values


def test_open_shards_are_closed_when_too_much_is_open(spark):
    rows = corpus(2, 60)
    made = collocations.shards(table(spark, rows).coalesce(1), most=50).collect()
    assert len(made) > 10 and all(r.size <= 50 + 82 for r in made)
    found, n = counted(rows)
    got = Counter()
    for r in made:
        for w, c in zip(r.words, r.counts, strict=True):
            got[r.lang, w] += c
    assert got == Counter({(lang, p): c for lang, f in found.items() for p, c in f.items() if " " not in p})


def test_long_texts_are_read_in_parts(monkeypatch):
    text = prose(500, 3).encode() + b"x" * 300 + b"...a\tB"
    whole = [w for part in collocations.words_of(text) for w in part]
    monkeypatch.setattr(collocations, "PART", 10)
    parts = list(collocations.words_of(text))
    assert len(parts) > 50 and [w for part in parts for w in part] == whole and whole[-5:] == [b".", b".", b"a", b"b", b"."]


def test_counts_beyond_64_bits_and_ties(spark):
    rows = [("en", "a b. a b. b a. b a. c d. c d")] * 3
    assert sorted(map(tuple, collocations.collocations(table(spark, rows), least=6, top=2).collect())) == slow(rows, 6, top=2)
    # the arithmetic of the score on counts whose products pass 64 bits
    a, l, r = 9_000_000_000_000_007, 9_100_000_000_000_013, 9_200_000_000_000_029
    got = spark.range(1).selectExpr(f"CAST(({collocations.SCALE} * CAST({a} AS DECIMAL(38, 0))) DIV (CAST({l} AS DECIMAL(38, 0)) + CAST({r} AS DECIMAL(38, 0))) AS BIGINT) AS score").first().score
    assert got == 2_000_000 * a // (l + r)


def test_odd_rows(odd, empty, spark):
    rows = odd.collect()
    got = sorted(map(tuple, collocations.collocations(odd, least=2).collect()))
    assert got == slow([(r.lang, r.text) for r in rows], 2)
    assert collocations.collocations(empty).collect() == []
    nothing = table(spark, [(None, None), ("en", ""), ("en", " .. ")])
    assert collocations.collocations(nothing, least=1).collect() == []
