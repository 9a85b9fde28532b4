"""Report text rules as Column -> Column functions."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Headings that begin the references, and marks of page boilerplate.
REFERENCE_HEADINGS = ("references", "bibliography", "acknowledgments")
BOILERPLATE = ("doi:", "copyright", "received:", "accepted:")
#: Limits of the sentence filter.
LEAST_CHARS, LEAST_ALPHA, MOST_DIGITS, MOST_PUNCTUATION, MOST_OPERATORS = 25, 0.35, 0.45, 0.45, 3
OPERATORS = "[=<>±∑√∫≈×]"
#: White space, as the reference rules understand it.
SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def normalize(text: Column) -> Column:
    """NUL becomes a space, hyphenated line ends are joined, line ends and spaces are squeezed."""
    text = F.replace(text, F.lit("\0"), F.lit(" "))
    text = F.replace(text, F.lit("-\n"), F.lit(""))
    return F.regexp_replace(F.regexp_replace(text, "\n+", "\n"), "[ \t]+", " ")


def cut_references(text: Column) -> Column:
    """The text before the first line that is a reference heading."""
    heading = r"(?iU)\n\s*(?:" + "|".join(REFERENCE_HEADINGS) + r")\s*\n"
    return F.get(F.split(text, heading, 2), F.lit(0))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value computed once, also inside array functions, which share no subexpressions."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def drop_artifacts(text: Column) -> Column:
    """Without page numbers, lines of less than five characters and page boilerplate; kept lines keep their spaces."""
    marks = "(?i)" + "|".join(map(re.escape, BOILERPLATE))
    keep = lambda line: let(strip(line), lambda bare: (F.length(bare) >= 5) & ~bare.rlike(marks))  # noqa: E731  page numbers are shorter
    return F.array_join(F.filter(F.split(text, LINE_BREAK), keep), "\n")


def report_text(raw: Column) -> Column:
    return drop_artifacts(cut_references(normalize(raw)))


def sentences(text: Column) -> Column:
    """Rule-based segmentation: a sentence ends at . ! or ? before white space."""
    marked = F.regexp_replace(text, r"(?U)([.!?])\s+", "$1\u0001")
    return F.filter(F.transform(F.split(marked, "\u0001"), lambda s: F.trim(s)), lambda s: s != "")


def tidy(sentence: Column) -> Column:
    """White space collapsed, trimmed, in lower case."""
    return F.lower(F.trim(F.regexp_replace(sentence, r"(?U)\s+", " ")))


def _letters(s: Column) -> Column:
    return F.length(F.regexp_replace(s, r"\P{L}+", ""))


def _judge(s: Column, dense: Column, letters: Column) -> Column:
    """The sentence filter on a stripped sentence, the same without white space, and its number of letters; cheap tests first."""
    n = F.length(dense)
    # characters of a class: what is missing once they are taken out
    count = lambda pattern: n - F.length(F.regexp_replace(dense, f"{pattern}+", ""))
    return (
        (F.length(s) < LEAST_CHARS)
        | (n == 0)
        | (letters / n < LEAST_ALPHA)
        # where letters are more than all digits or punctuation leave room for, neither can be too many
        | ((letters <= n * (1 - min(MOST_DIGITS, MOST_PUNCTUATION) + 0.05)) & ((count(r"[\p{Nd}\p{No}]") / n > MOST_DIGITS) | (count(r"\p{Punct}") / n > MOST_PUNCTUATION)))
        | s.rlike(r"^\[?\d+\]?\s+[A-Z][A-Za-z\-]+")
        | ((n - letters >= MOST_OPERATORS) & (count(OPERATORS) >= MOST_OPERATORS))
    )


def bad_sentence(sentence: Column) -> Column:
    """Too short, mostly digits, punctuation or operators, or like the head of a reference."""
    bare = strip(sentence)
    judged = lambda v: let(_letters(v["dense"]), lambda letters: _judge(v["s"], v["dense"], letters))
    return F.coalesce(let(F.struct(bare.alias("s"), F.regexp_replace(bare, r"(?U)\s+", "").alias("dense")), judged), F.lit(True))


def kept_sentences(found: Column) -> Column:
    """Of an array of sentences, tidied, those that pass the filter, in order."""
    return F.filter(F.transform(found, tidy), lambda s: ~bad_sentence(s))


def clean_sentences(text: Column) -> Column:
    """Tidied sentences of a text that pass the filter, in order."""
    return kept_sentences(sentences(text))


def judged_sentences(df: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """(keys, s, bad): a row for each tidied sentence, with what the filter says of it.

    The same rules as in clean_sentences, but on rows: they are compiled,
    where those inside array functions are interpreted. Text that passes
    tidy has no other white space than single spaces. A filter on ``bad``
    would be pushed below its columns and compute each anew wherever the
    rules name it; count or sum under it instead.
    """
    found = df.select(*keys, F.explode(sentences(text)).alias("s")).select(*keys, tidy(F.col("s")).alias("s"))
    found = found.select(*keys, "s", strip(F.col("s")).alias("bare"))
    found = found.select(*keys, "s", "bare", F.replace("bare", F.lit(" "), F.lit("")).alias("dense"))
    found = found.select(*keys, "s", "bare", "dense", _letters(F.col("dense")).alias("letters"))
    return found.select(*keys, "s", F.coalesce(_judge(F.col("bare"), F.col("dense"), F.col("letters")), F.lit(True)).alias("bad"))


def keyword_pattern(keywords: list[str]) -> str:
    """One alternation of whole words for a category's keywords."""
    return "|".join(rf"\b{re.sub(r'([^A-Za-z0-9_ ])', r'\\\1', k.lower())}\b" for k in keywords)


def keyword_gate(sentence: Column, keywords: list[str], gate: float = 0.9) -> Column:
    """1 where the sentence has a keyword, else the gate."""
    if not keywords:
        return F.lit(gate)
    low = F.lower(sentence)
    # most sentences have no keyword's letters at all, which is told without the pattern
    some = reduce(Column.__or__, [F.contains(low, F.lit(k.lower())) for k in keywords])
    return F.when(some & low.rlike("(?U)" + keyword_pattern(keywords)), F.lit(1.0)).otherwise(F.lit(gate))


def file_id(name: Column) -> Column:
    """What stands before the first dot."""
    return F.get(F.split(name, r"\."), F.lit(0))
