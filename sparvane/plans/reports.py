"""Entry point B: report text to sentences, vectors and category scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparvane.functions.text import bad_sentence, clean_sentences, kept_sentences, report_text, tidy
from sparvane.operators import boundaries, similarity

#: The categories of the lexicon, in order.
CATEGORIES = (
    "background_treatment", "detector_efficiency", "normalization_treatment", "sample_attenuation_scattering_corrections", "dead_time",
    "coincidence", "statistical_uncertainty", "uncertainty_propagation", "time_of_flight",
)

#: Sentences in a model's batch, and tokens of a sentence that a model reads.
BATCH, MOST_TOKENS = 32, 512


def split_by(text: Column, splitter: Callable[[str], list[str]]) -> Column:
    """Sentences by a caller's segmenter, which runs on the executors; none where the text is null."""

    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [] if t is None else list(splitter(t)))

    return found(text)


def sentences(reports: DataFrame, splitter: Callable[[str], list[str]] | None = None, learned: bool = False) -> DataFrame:
    """(EXFOR_Entry, Sentence_Number, Text) of (report_id, text): kept sentences, numbered from 1.

    splitter: a segmenter in place of the rule that a sentence ends at . ! or ?
    learned: boundaries by what the reports say of their abbreviations.
    """
    text = report_text(F.col("text"))
    if learned:
        found = boundaries.sentences(reports, "report_id", text).select(F.col("report_id").alias("EXFOR_Entry"), "number", tidy(F.col("sentence")).alias("Text"))
        number = F.row_number().over(Window.partitionBy("EXFOR_Entry").orderBy("number"))
        return found.where(~bad_sentence(F.col("Text"))).select("EXFOR_Entry", number.alias("Sentence_Number"), "Text")
    kept = clean_sentences(text) if splitter is None else kept_sentences(split_by(text, splitter))
    found = reports.select(F.col("report_id").alias("EXFOR_Entry"), F.posexplode(kept).alias("pos", "Text"))
    return found.select("EXFOR_Entry", (F.col("pos") + 1).alias("Sentence_Number"), "Text")


def hashing_embedder(dimensions: int = 256) -> Callable[[list[str]], np.ndarray]:
    """Sentence vectors without a model: signed hashed words and word pairs, of length 1. Deterministic."""

    def embed(texts: list[str]) -> np.ndarray:
        import zlib

        out = np.zeros((len(texts), dimensions), np.float32)
        for i, t in enumerate(texts):
            w = t.lower().split()
            for f in [*w, *(" ".join(p) for p in zip(w, w[1:], strict=False))]:
                h = zlib.crc32(f.encode())
                out[i, h % dimensions] += 1.0 if h >> 31 else -1.0
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    return embed


def embed(text: Column, embedder: Callable[[list[str]], np.ndarray] | None = None) -> Column:
    """Vectors of texts. embedder: list of texts -> float32 matrix; a null text is an empty one."""
    make = embedder or hashing_embedder()

    @F.pandas_udf("array<float>")
    def vectors(texts: pd.Series) -> pd.Series:
        return pd.Series(list(make(texts.fillna("").tolist())), dtype=object)

    return vectors(text)


def embed_by_model(text: Column, load: Callable[[], Callable[[list[str], int], tuple[np.ndarray, np.ndarray]]], batch: int = BATCH, most_tokens: int = MOST_TOKENS) -> Column:
    """Vectors of texts by a token model: the mean of the token vectors that the mask keeps.

    load() runs once a task, not once a batch, and gives encode(texts,
    most_tokens), which returns the hidden states (texts, tokens, dimensions)
    and the mask (texts, tokens) of at most ``batch`` texts. Memory is that
    of one batch. A null text is an empty one; a text without a token has a
    vector of zeros.
    """

    @F.pandas_udf("array<float>")
    def vectors(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        for texts in frames:
            all_texts, out = texts.fillna("").tolist(), []
            for i in range(0, len(all_texts), batch):
                hidden, mask = encode(all_texts[i : i + batch], most_tokens)
                weight = np.asarray(mask, np.float32)[:, :, None]
                out += list(((hidden * weight).sum(1) / np.maximum(weight.sum(1), 1e-9)).astype(np.float32))
            yield pd.Series(out, dtype=object)

    return vectors(text)


def report_features(
    reports: DataFrame,
    lexicon: DataFrame,
    keywords: dict[str, list[str]],
    embedder: Callable[[list[str]], np.ndarray] | None = None,
    gate: float = similarity.GATE,
    load: Callable[[], Callable[[list[str], int], tuple[np.ndarray, np.ndarray]]] | None = None,
    splitter: Callable[[str], list[str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(report_embeddings, sentence_embeddings).

    lexicon: (category, sentences); keywords: category -> keywords, both of
    the lexicon file. Reports without a kept sentence have no row. load, of a
    token model, takes the place of the embedder.
    """
    vectors = lambda c: embed(c, embedder) if load is None else embed_by_model(c, load)
    found = sentences(reports, splitter).withColumn("Embedding", vectors(F.col("Text")))
    templates = lexicon.select("category", F.explode("sentences").alias("s")).select("category", vectors(F.col("s")).alias("Template_Embedding"))
    scores = similarity.category_scores(similarity.gates(found, keywords, gate=gate), templates)
    wide = similarity.wide_scores(scores, list(keywords))
    return wide.join(similarity.mean_vectors(found, "EXFOR_Entry", "Embedding"), "EXFOR_Entry"), found
