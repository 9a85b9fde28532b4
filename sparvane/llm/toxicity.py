"""Toxicity by a classifier chain.

The categories are predicted one after the other by linear models on hashed
features of a document's words (the word and its first letters, which carry
its root where words are inflected); a later model also sees the
probabilities of the earlier categories. In training these come from models
that have not seen the document (out-of-fold predictions), so the later
models learn how far to trust them. The chain runs over insults,
degradation and disgust, which are weak labels (a labelled toxic document
with a word of the category's list), and ends with the labelled toxicity.

Models are fitted on ``sample`` labelled documents, those first in order of
a hash of their id, each with the features that depend on its category beyond
chance in its own training documents and an L1 penalty that leaves few
weights; they are applied to the whole of every text. A text's features are the different ones it has, so its length
alone adds little.

Cases: null and wordless texts are not toxic (probabilities 0); documents
with contradictory labels count as toxic; without labels of both kinds all
probabilities are 0; repeated rows get the same result; different texts of
one doc_id all have its label in training and are judged each; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparvane.llm.common import materialize, table, utf8
from sparvane.llm.decontaminate import words
from sparvane.llm.linear import Rows, fit_few, screened, sigmoid

#: Labelled documents that the models are fitted on.
SAMPLE = 20_000
THRESHOLD = 0.5
FOLDS = 3
DIMENSIONS = 1 << 24
LEAST_ROWS = 5
#: Least chi-squared of a model's feature over its training documents: less is common among so many features by chance.
LEAST_CHI = 25.0
PREFIXES = (3, 4, 5, 6, 7)
CACHE_WORDS = 300_000
#: Words by weak category.
CATEGORIES: dict[str, frozenset[bytes]] = {
    "insult": frozenset(b"clown dumb fool idiot imbecile jerk loser moron stupid".split()),
    "degradation": frozenset(b"hopeless inferior pathetic subhuman useless worthless".split()),
    "disgust": frozenset(b"disgusting filth garbage gross revolting scum trash vermin vile".split()),
}
CHAIN = (*CATEGORIES, "toxic")


def word_features(word: bytes) -> list[int]:
    """Hashes of a word and of its first letters, in code points."""
    text = word.decode("utf-8", "replace").lower()
    names = {text, *(f"^{text[:k]}" for k in PREFIXES if len(text) >= k)}
    return [zlib.crc32(n.encode()) % DIMENSIONS for n in names]


def document_features(data: bytes) -> np.ndarray:
    found: set[int] = set()
    for w in set(words(data)):
        found.update(word_features(w))
    return np.fromiter(found, np.int64, len(found))


class Chain:
    """Weights of the chain's models, by feature."""

    def __init__(self) -> None:
        #: feature -> a weight for each model
        self.weights: dict[int, tuple[float, ...]] = {}
        #: of each model, weights of the earlier probabilities and the bias
        self.dense: list[np.ndarray] = []
        self.known: dict[bytes, tuple[int, ...]] = {}

    @classmethod
    def train(cls, rows: Rows, labels: np.ndarray, fold: np.ndarray, l1: float = 1e-4, folds: int = FOLDS) -> Chain:
        """labels: a column for each model of the chain; fold: each document's, from 0 on."""
        self = cls()
        everyone = np.ones(rows.n, bool)

        def model(y: np.ndarray, inside: np.ndarray, earlier: np.ndarray) -> tuple[dict[int, float], np.ndarray, np.ndarray]:
            """Weights by feature, dense weights, and every row's probability; the model's own rows end here, before the next model's are made."""
            few = screened(rows, y, inside, LEAST_CHI)
            w, v = fit_few(few, y, inside, earlier, l1, steps=200)
            return dict(zip(few.names.tolist(), w.tolist(), strict=True)), v, sigmoid(few.dot(w) + earlier @ v[:-1] + v[-1])

        earlier = np.zeros((rows.n, 0))
        columns = []
        for k in range(labels.shape[1]):
            y = labels[:, k]
            guess = np.zeros(rows.n)
            for f in range(folds):
                out = fold == f
                guess[out] = model(y, ~out, earlier)[2][out]
            weights, v, _ = model(y, everyone, earlier)
            columns.append(weights)
            self.dense.append(v)
            earlier = np.column_stack([earlier, guess])
        used = sorted({f for c in columns for f, x in c.items() if x})
        self.weights = {f: tuple(c.get(f, 0.0) for c in columns) for f in used}
        return self

    def __call__(self, data: bytes) -> list[float]:
        """Probabilities of the chain's categories."""
        if not self.dense:
            return [0.0] * len(CHAIN)
        found = set(words(data))
        if not found:
            return [0.0] * len(self.dense)
        known, used = self.known, set()
        for w in found:
            x = known.get(w)
            if x is None:
                x = tuple(f for f in word_features(w) if f in self.weights)
                if len(w) <= 60:
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                    known[w] = x
            if x:
                used.update(x)
        total = np.sum([self.weights[f] for f in used], axis=0) if used else np.zeros(len(self.dense))
        out: list[float] = []
        for k, v in enumerate(self.dense):
            out.append(float(sigmoid(total[k] + float(np.dot(v[:-1], out)) + v[-1])))
        return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """The chain, fitted on at most ``sample`` labelled documents.

    Equal texts are in one fold. Which features depend on a category is
    counted in the cluster, once for each fold left out and once over all;
    the driver gets the sample's labels and of its features those that some
    model may start from, judged by that model's own training documents.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long"), utf8().alias("data")).withColumn("th", F.xxhash64("data"))
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), *((c, pa.bool_()) for c in CHAIN), ("features", pa.list_(pa.int32()))])
    ddl = "doc_id long, th long, " + ", ".join(f"{c} boolean" for c in CHAIN) + ", features array<int>"

    def featurize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = [t > 0 for t in batch.column("toxic").to_pylist()]
            texts = [d.as_py() for d in batch.column("data")]
            seen = [set(words(t)) for t in texts]
            columns = {c: [t and bool(s & listed) for t, s in zip(toxic, seen, strict=True)] for c, listed in CATEGORIES.items()}
            yield table(columns | {"doc_id": batch.column("doc_id"), "th": batch.column("th"), "toxic": toxic, "features": [document_features(t) for t in texts]}, schema)

    # a doc_id may have several texts: the bound holds for texts, in an order that does not depend on how they are stored
    keys = rows.select("doc_id", "th").join(F.broadcast(chosen), "doc_id").distinct().orderBy(F.xxhash64("doc_id", "th"), "doc_id", "th").limit(sample)
    drawn = rows.join(F.broadcast(keys), ["doc_id", "th"]).dropDuplicates(["doc_id", "th"])
    drawn = materialize(drawn.select("doc_id", "th", "toxic", "data").mapInArrow(featurize, ddl), "features")
    drawn = drawn.withColumn("fold", F.pmod("th", F.lit(FOLDS)).cast("int"))
    parts = drawn.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(c) for c in CHAIN]).collect()
    total = {x: sum(r[x] for r in parts) for x in ("n", *CHAIN)}
    if not 0 < total["toxic"] < total["n"]:
        return Chain()
    hits = drawn.select(F.explode("features").alias("f"), "fold", *CHAIN).groupBy("f", "fold").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(c) for c in CHAIN])
    chosen_by = F.lit(False)
    kept = []
    for out in (None, *range(FOLDS)):
        size = {x: total[x] - sum(r[x] for r in parts if r.fold == out) for x in total}
        kept += [F.sum(F.when(F.col("fold") != (-1 if out is None else out), F.col(x))).alias(f"{x}_{out}") for x in total]
        n = F.coalesce(F.col(f"n_{out}"), F.lit(0))
        for c in CHAIN:
            p = size[c] / size["n"] if size["n"] else 0.0
            spread = F.lit(p * (1 - p)) * n * (1 - n / max(size["n"], 1))
            chi = F.try_divide(F.pow(F.coalesce(F.col(f"{c}_{out}"), F.lit(0)) - n * p, F.lit(2.0)), spread)
            chosen_by = chosen_by | F.coalesce(chi >= LEAST_CHI * 0.999, F.lit(False))  # the model itself decides at the level
    pool = hits.groupBy("f").agg(*kept).where(F.col("n_None") >= LEAST_ROWS).where(chosen_by).select("f")
    wanted = np.sort(pool.toArrow().column("f").to_numpy())

    def select(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places in wanted instead of features."""
        for batch in batches:
            lists = batch.column("features")
            found = lists.flatten().to_numpy()
            place = np.minimum(np.searchsorted(wanted, found), max(len(wanted) - 1, 0)).astype(np.int32)
            keep = wanted[place] == found if len(wanted) else np.zeros(len(found), bool)
            ends = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])]
            places = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place[keep], pa.int32()))
            yield table({c: batch.column(c) for c in ("doc_id", "th", *CHAIN)} | {"features": places}, schema)

    # the sample is put in order here: to sort it in the cluster would select twice
    got = drawn.drop("fold").mapInArrow(select, ddl).toArrow()
    got = got.take(np.lexsort((got.column("th").to_numpy(), got.column("doc_id").to_numpy()))).combine_chunks()
    y = np.column_stack([got.column(c).to_numpy(zero_copy_only=False) for c in CHAIN]).astype(float)
    fold = got.column("th").to_numpy() % FOLDS
    lists = got.column("features").combine_chunks()
    counts, columns = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
    return Chain.train(Rows.indexed(counts, columns, wanted), y, fold)


def scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, p_insult, p_degradation, p_disgust, p_toxic, toxic) of every row."""
    chain = train(docs, labels, sample)
    names = [f"p_{c}" for c in CHAIN]
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.float64()) for n in names), ("toxic", pa.bool_())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [chain(d.as_py()) for d in batch.column("data")]
            yield table({"doc_id": batch.column("doc_id"), "toxic": [p[-1] >= threshold for p in found]} | {n: [p[k] for p in found] for k, n in enumerate(names)}, schema)

    return docs.select(F.col("doc_id").cast("long"), utf8().alias("data")).mapInArrow(run, "doc_id long, " + ", ".join(f"{n} double" for n in names) + ", toxic boolean")
