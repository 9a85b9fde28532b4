"""Sentence boundaries learned from the corpus.

A full stop ends a sentence unless its word is an abbreviation, and the corpus
says which words are: those that bear the full stop far more often than words
in general do (a log-likelihood ratio), are short, hold full stops of their
own, and seldom stand without one. After an abbreviation a sentence ends
only where the next word is one that opens sentences more often than chance
(again by log-likelihood). Both statistics are counts by word, reduced before
they move; a second pass marks the boundaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparvane.sources.shared import few, materialize

#: Fixed values of the published method: least score of an abbreviation, of a word that opens sentences, and the share of full stops that abbreviations have.
ABBREVIATION, STARTER, CERTAIN = 0.3, 30.0, 0.99


def words(df: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, pos, word, type, stop, next_word, next_type): each word, with its neighbour.

    type: the word in lower case without outer punctuation and its last full
    stop; stop: ``.`` if it ends in a full stop, ``!`` in another mark, or empty.
    """
    found = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    ws = df.select(key, found.alias("ws"))
    each = F.transform("ws", lambda w, i: F.struct(i.alias("pos"), w.alias("word"), F.get(F.col("ws"), i + 1).alias("next_word")))
    out = ws.select(key, F.inline(each))
    return out.select(key, "pos", "word", type_of(F.col("word")).alias("type"), stop_of(F.col("word")).alias("stop"), "next_word", type_of(F.col("next_word")).alias("next_type"))


def stop_of(word: Column) -> Column:
    closed = F.regexp_replace(word, r"[)\]\"'»”’]+$", "")
    return F.when(closed.endswith("."), ".").when(closed.rlike("[!?…]$"), "!").otherwise("")


def type_of(word: Column) -> Column:
    bare = F.regexp_replace(F.lower(word), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}.]+$", "")
    return F.regexp_replace(bare, r"[^\p{L}\p{N}]+$", "")


def _log(x: Column) -> Column:
    return F.ln(F.greatest(x, F.lit(1e-12)))


def abbreviations(found: DataFrame) -> DataFrame:
    """(type, score) of the words that are abbreviations. found: what ``words`` gives."""
    return scored(found).where(F.col("score") >= ABBREVIATION).select("type", "score")


def scored(found: DataFrame) -> DataFrame:
    """(type, stopped, plain, score) of the words with a letter that bear a full stop somewhere."""
    # words as written are counted before any rule reads them: one scan, and the rules see each word once
    n, stopped = F.col("n"), stop_of(F.col("word")) == "."
    once = found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).select(type_of(F.col("word")).alias("type"), F.when(stopped, n).otherwise(0).alias("stopped"), F.when(stopped, 0).otherwise(n).alias("plain"))
    types = materialize(once.groupBy("type").agg(F.sum("stopped").alias("stopped"), F.sum("plain").alias("plain")), "types")
    share = types.agg((F.sum("stopped") / F.sum(F.col("stopped") + F.col("plain"))).alias("p")).scalar()
    counts = types.where(F.col("type").rlike(r"\p{L}") & (F.col("stopped") > 0))
    a, b = F.col("stopped"), F.col("plain")
    apart = 2 * (a * _log(F.lit(CERTAIN)) + b * _log(F.lit(1 - CERTAIN)) - a * _log(share) - b * _log(1 - share))
    letters = F.length(F.replace(F.col("type"), F.lit("."), F.lit("")))
    score = apart * F.exp(-letters.cast("double")) * (F.length("type") - letters + 1) * F.pow(letters.cast("double"), -b.cast("double"))
    return counts.select("type", "stopped", "plain", score.alias("score"))


def starters(found: DataFrame, abbreviated: DataFrame) -> DataFrame:
    """(type): words whose capital opens a sentence: they follow the end of one more often than chance, or have a capital nowhere inside one and small letters elsewhere.

    Ends after abbreviations tell nothing.
    """
    ends = F.col("stop") == "!"
    marked = found.join(abbreviated.select("type", F.lit(True).alias("short")), "type", "left")
    ends = ends | ((F.col("stop") == ".") & F.col("short").isNull())
    after = marked.where(F.col("next_type") != "").groupBy(F.col("next_type").alias("type")).agg(F.count(F.lit(1)).alias("all"), F.count_if(ends).alias("opens"), F.count_if(_begins(r"\p{Ll}")).alias("small"), F.count_if(_begins(r"\p{Lu}") & (F.col("stop") == "")).alias("inside"))
    after = materialize(after, "followers")
    n = after.agg(F.sum("all").alias("n")).scalar()
    m = after.agg(F.sum("opens").alias("m")).scalar()
    a, k = F.col("all"), F.col("opens")
    p, p1, p2 = m / n, k / a, F.try_divide(m - k, n - a)
    ll = lambda hits, tries, rate: hits * _log(rate) + (tries - hits) * _log(1 - rate)
    apart = 2 * (ll(k, a, p1) + ll(m - k, n - a, p2) - ll(k, a, p) - ll(m - k, n - a, p))
    return after.where(((apart >= STARTER) & (p1 > p)) | ((F.col("small") > 0) & (F.col("inside") == 0))).select("type")


def _begins(kind: str) -> Column:
    """Whether the next word begins with a letter of this kind."""
    return F.coalesce(F.regexp_replace("next_word", r"^[^\p{L}\p{N}]+", "").rlike("^" + kind), F.lit(False))


def marked(found: DataFrame) -> DataFrame:
    """found with ``ends``: whether a sentence ends behind the word."""
    short = few(materialize(abbreviations(found), "abbreviations"))
    opens = materialize(starters(found, short), "starters").select(F.col("type").alias("next_type"), F.lit(True).alias("opens"))
    known = found.join(short.select("type", F.lit(True).alias("short")), "type", "left")
    # openers may be as many as there are words: only what stands after an abbreviation or initial meets them, as the words are many times the text
    asks = (F.col("stop") == ".") & F.col("next_word").isNotNull() & (F.col("short").isNotNull() | F.col("type").rlike(r"^\p{L}$"))
    asked = known.where(asks).join(opens, "next_type", "left")
    known = asked.unionByName(known.where(~asks).withColumn("opens", F.lit(None).cast("boolean")))
    capital = _begins(r"\p{Lu}")
    initial = F.col("type").rlike(r"^\p{L}$")
    number = F.col("type").rlike(r"^\p{N}+$")
    after = (
        F.when(F.col("next_word").isNull(), True)
        .when(F.col("stop") == "!", True)
        .when(F.col("stop") == "", False)
        .when(F.col("short").isNotNull() | initial, capital & F.col("opens").isNotNull())
        .when(number, capital)
        .otherwise(True)
    )
    return known.select(*found.columns, after.alias("ends"))


def sentences(df: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, number, sentence): the sentences of each text, numbered from 1, words joined by single spaces."""
    found = marked(words(df, key, text))
    before = F.count_if("ends").over(Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    cut = found.withColumn("number", (F.coalesce(before, F.lit(0)) + 1).cast("int"))
    parts = F.array_sort(F.collect_list(F.struct("pos", "word")))
    return cut.groupBy(key, "number").agg(F.array_join(F.transform(parts, lambda p: p["word"]), " ").alias("sentence"))
