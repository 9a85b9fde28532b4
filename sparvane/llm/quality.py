"""Quality classifier by weak labels.

Overlapping heuristics vote good, bad or nothing on every document. Votes
are counted by pattern over the whole corpus (at most 3 ** labellers rows),
and expectation-maximisation on these counts estimates how often each
labeller is right and the share of good documents. The posterior of a
document's pattern is its label, and a linear scorer on hashed features
(shapes and endings of words, levels of the document's statistics) is fitted
to the labels of ``sample`` documents, those first in order of a hash of
their id and text, and applied to all.

Cases: null and wordless texts are rejected, with score 0; repeated rows get
the same score; different texts of one doc_id are judged each; very long texts are read whole; ties of the score with the
threshold are kept; an empty table gives an empty result; other columns are
ignored (``good`` keeps them).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparvane.llm.common import materialize, table, utf8
from sparvane.llm.linear import Rows, fit, sigmoid

#: Documents the scorer is fitted on.
SAMPLE = 6_000
THRESHOLD = 0.5
DIMENSIONS = 1 << 15
CACHE_WORDS = 300_000
GOOD, BAD, NONE = 1, 2, 0
#: Frequent short words of the corpus's languages.
FREQUENT = frozenset("a an and are as at be by for from he in is it of on or that the this to was with au de der des die du el en ein eine est et il in la las le les los mit nicht ou para par pas por que qui se sich sur un una und une von zu".split())
CLEAN_END = re.compile(r"[^\W\d_][.,;:!?]?$")
PUNCTUATION_ONLY = re.compile(r"^[\W_]+$")
LETTERS = bytes(b for b in range(128) if chr(b).isalpha()) + bytes(range(0xC3, 0xF5))  # and the first bytes of longer characters
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:!?'\"()-")


class Words:
    """What is known of a word by itself, kept where met before: punctuation only, clean ending, frequent, and the model's weight."""

    def __init__(self, weigh: Callable[[str], float] | None = None) -> None:
        self.weigh = weigh
        self.known: dict[bytes, tuple[int, int, int, float]] = {}

    def look(self, word: bytes) -> tuple[int, int, int, float]:
        text = word.decode("utf-8", "replace")
        found = (
            int(PUNCTUATION_ONLY.match(text) is not None),
            int(CLEAN_END.search(text) is not None),
            int(text.lower().strip(".,;:!?") in FREQUENT),
            self.weigh(text) if self.weigh else 0.0,
        )
        if len(word) <= 60:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def statistics(self, data: bytes) -> tuple[dict[str, float], float] | None:
        """Shares that the labellers judge, and the mean weight of a word; None of a text without words.

        Shares that a few words say little of are drawn towards an inconspicuous value by some words more.
        """
        words = data.split()
        n = len(words)
        if not n:
            return None
        size = len(data)
        letters = size - len(data.translate(None, LETTERS))
        counts = Counter(words)
        lone = clean = frequent = 0
        weight = 0.0
        get = self.known.get
        for w, c in counts.items():
            x = get(w) or self.look(w)
            lone += c * x[0]
            clean += c * x[1]
            frequent += c * x[2]
            weight += c * x[3]
        triples = len(set(zip(words, words[1:], words[2:], strict=False)))
        lines = [x for x in data.split(b"\n") if x.strip()]
        return {
            "symbols": (size - len(data.translate(None, SYMBOLS))) / size,
            "capitals": (size - len(data.translate(None, CAPITALS))) / (letters + 20),
            "lone": lone / (n + 1),
            "stutter": sum(map(eq, words, words[1:])) / (n + 2),
            "triples": (max(n - 2, 0) - triples) / (n + 4),
            "top": (max(counts.values()) - 1) / (n + 4),
            "lines": (len(lines) - len(set(lines))) / (len(lines) + 2),
            "endings": (clean + 4) / (n + 4),
            "frequent": (frequent + 2) / (n + 8),
            "length": sum(map(len, words)) / n,
        }, weight / n


#: Labellers of one defect each: they vote bad from a level of a statistic on (up to it where marked -1).
DEFECTS: tuple[tuple[str, float, int], ...] = (
    ("symbols", 0.06, 1),
    ("capitals", 0.40, 1),
    ("lone", 0.12, 1),
    ("stutter", 0.25, 1),
    ("triples", 0.30, 1),
    ("top", 0.35, 1),
    ("lines", 0.60, 1),
    ("endings", 0.75, -1),
    ("frequent", 0.02, -1),
)
#: Labellers of soundness: they vote good if every one of their statistics is on the sound side of a level.
SOUND: tuple[tuple[str, tuple[tuple[str, float, int], ...]], ...] = (
    ("form", (("symbols", 0.03, 1), ("capitals", 0.20, 1), ("lone", 0.05, 1), ("endings", 0.85, -1))),
    ("variety", (("stutter", 0.10, 1), ("triples", 0.15, 1), ("lines", 0.40, 1))),
    ("language", (("frequent", 0.08, -1),)),
)
LABELLERS = (*(x[0] for x in DEFECTS), *(x[0] for x in SOUND))


def pattern(stats: dict[str, float]) -> int:
    """The votes as a number in base 3."""
    out = 0
    for name, level, side in DEFECTS:
        out = 3 * out + (BAD if side * stats[name] >= side * level else NONE)
    for _, parts in SOUND:
        out = 3 * out + (GOOD if all(side * stats[name] <= side * level for name, level, side in parts) else NONE)
    return out


def votes_of(patterns: np.ndarray) -> np.ndarray:
    m = len(LABELLERS)
    return (patterns[:, None] // 3 ** np.arange(m - 1, -1, -1)) % 3


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, dict[int, float], np.ndarray]:
    """Expectation-maximisation: (accuracy of each labeller where it votes, pattern -> probability of good, share of good and bad)."""
    votes = votes_of(patterns)
    good = 1.0 * (votes == GOOD).sum(axis=1) - 2.0 * (votes == BAD).sum(axis=1)  # a defect weighs more than soundness elsewhere
    posterior = sigmoid(good)
    for _ in range(rounds):
        weight = np.column_stack([posterior, 1 - posterior]) * counts[:, None]
        prior = (weight.sum(axis=0) + 1) / (weight.sum() + 2)
        table_ = np.stack([((votes == v)[:, :, None] * weight[:, None, :]).sum(axis=0) + 1 for v in range(3)])  # vote, labeller, class
        table_ /= table_.sum(axis=0)
        logs = np.log(prior)[None, :] + np.log(table_[votes, np.arange(votes.shape[1])[None, :], :]).sum(axis=1)
        new = sigmoid(logs[:, 0] - logs[:, 1])
        if np.abs(new - posterior).max() < 1e-9:
            break
        posterior = new
    right = prior[0] * table_[GOOD, :, 0] + prior[1] * table_[BAD, :, 1]
    voted = right + prior[0] * table_[BAD, :, 0] + prior[1] * table_[GOOD, :, 1]
    return right / voted, dict(zip(patterns.tolist(), posterior.tolist(), strict=True)), prior


def word_shape(word: str) -> str:
    out = []
    for c in word:
        kind = "X" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def hashed(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % DIMENSIONS


def word_features(word: str) -> tuple[int, int]:
    return hashed("s " + word_shape(word)), hashed("e " + word[-2:])


def level_features(stats: dict[str, float]) -> list[int]:
    return [hashed(f"{k} {int(min(v, 40)) if k == 'length' else int(v * 12)}") for k, v in stats.items()]


#: Weight of the words' shares against that of a statistic's level.
WORD_SCALE = 4.0


def features(data: bytes, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(features, values): the share of words with each word feature, and 1 for each level."""
    found = words.statistics(data)
    value: dict[int, float] = {}
    if found:
        split = data.split()
        for w, c in Counter(split).items():
            for f in word_features(w.decode("utf-8", "replace")):
                value[f] = value.get(f, 0.0) + WORD_SCALE * c / len(split)
        for f in level_features(found[0]):
            value[f] = value.get(f, 0.0) + 1.0
    return np.fromiter(value, np.int64, len(value)), np.fromiter(value.values(), np.float64, len(value))


class Scorer:
    """The fitted linear model."""

    def __init__(self, weights: dict[int, float], bias: float) -> None:
        self.weights, self.bias = weights, bias
        self.words = Words(self.weigh)

    def weigh(self, word: str) -> float:
        return WORD_SCALE * sum(self.weights.get(f, 0.0) for f in word_features(word))

    def __call__(self, data: bytes) -> float:
        found = self.words.statistics(data)
        if found is None:
            return 0.0
        return float(sigmoid(self.bias + found[1] + sum(self.weights.get(f, 0.0) for f in level_features(found[0]))))


def patterns(docs: DataFrame) -> DataFrame:
    """(doc_id, th, pattern) of every row; no pattern for a text without words."""
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("pattern", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            judged = [words.statistics(data.as_py()) for data in batch.column("data")]
            found = [pattern(x[0]) if x else None for x in judged]
            yield table({"doc_id": batch.column("doc_id"), "th": batch.column("th"), "pattern": found}, schema)

    return _keyed(docs).mapInArrow(run, "doc_id long, th long, pattern long")


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, th, data): a doc_id may have several texts, told apart by their hash."""
    return docs.select(F.col("doc_id").cast("long"), utf8().alias("data")).select("doc_id", F.xxhash64("data").alias("th"), "data")


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[Scorer, dict[str, float]]:
    """The scorer, and each labeller's estimated accuracy.

    Equal rows count each in the votes and once in the scorer's sample.
    """
    voted = materialize(patterns(docs), "votes").where("pattern is not null")
    counted = voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    if not counted:
        return Scorer({}, 0.0), {}
    accuracy, posterior, _ = estimate(np.array([r.pattern for r in counted]), np.array([r.n for r in counted], float))
    chosen = voted.groupBy("doc_id", "th").agg(F.min("pattern").alias("pattern")).orderBy(F.xxhash64("doc_id", "th"), "doc_id", "th").limit(sample)
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("pattern", pa.int64()), ("features", pa.list_(pa.int32())), ("shares", pa.list_(pa.float32()))])

    def featurize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            made = [features(data.as_py(), words) for data in batch.column("data")]
            yield table({c: batch.column(c) for c in ("doc_id", "th", "pattern")} | {"features": [m[0] for m in made], "shares": [m[1] for m in made]}, schema)

    rows = _keyed(docs)
    drawn = rows.join(F.broadcast(chosen), rows.doc_id.eqNullSafe(chosen.doc_id) & (rows.th == chosen.th)).select(rows.doc_id, rows.th, "data", "pattern")
    got = drawn.mapInArrow(featurize, "doc_id long, th long, pattern long, features array<int>, shares array<float>").dropDuplicates(["doc_id", "th"]).orderBy("doc_id", "th").toArrow()
    labels = np.array([posterior[p] for p in got.column("pattern").to_pylist()])
    named = [np.array(x, np.int64) for x in got.column("features").to_pylist()]
    data = Rows(named, [np.array(x) for x in got.column("shares").to_pylist()], least_rows=1)
    w, v = fit(data, labels, np.ones(data.n, bool), np.zeros((data.n, 0)), l1=2e-5, l2=1e-5, steps=300)
    weights = {int(f): float(x) for f, x in zip(data.names, w, strict=True) if x}
    return Scorer(weights, float(v[-1])), dict(zip(LABELLERS, accuracy.tolist(), strict=True))


def scores(docs: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, keep) of every row."""
    scorer, _ = train(docs, sample)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("keep", pa.bool_())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scorer(d.as_py()) for d in batch.column("data")]
            yield table({"doc_id": batch.column("doc_id"), "score": found, "keep": [x >= threshold for x in found]}, schema)

    return docs.select(F.col("doc_id").cast("long"), utf8().alias("data")).mapInArrow(run, "doc_id long, score double, keep boolean")


def good(docs: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs with a score of threshold or more, with all their columns."""
    scorer, _ = train(docs, sample)

    @F.pandas_udf("double")
    def score(data):  # noqa: ANN001, ANN202
        return data.map(scorer).astype(float)

    return docs.where(score(utf8()) >= threshold)
