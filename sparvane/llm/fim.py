"""Fill-in-middle documents by run-length classes of code points.

A text of n code points is cut at two places, which its doc_id decides, into
prefix, middle and suffix; the middle is put last, behind marks, so that a
model learns to fill it in. Cuts count code points, a stored text is UTF-8,
in which a code point's class is its width of one to four bytes. A batch of
texts is held as its maximal runs of one class, each with the units before it,
the byte at which it begins and its width. A cut binary-searches the run that
holds it, and its byte is the run's plus the units into the run times the
width; no text is walked or decoded.

The parts in an output are told by their marks: a text that contains a mark
itself stays plain, and no mark can arise where parts meet, since a mark
begins with its only "<". ``restored`` rebuilds a text from output and form.

Nothing is shuffled; long texts are classed a stretch at a time, and a run that
goes on over the end of a stretch is one run.

Cases: a null text is empty, an empty one plain; a null doc_id counts as no
digits; equal doc_ids are cut at equal places of their own texts; repeated
rows are treated each; an empty table gives an empty result; other columns
are kept, unless they bear the name of a result column, which then replaces
them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparvane.llm.common import column_bytes, slices, without

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents, how many are transformed, and of 100 transformed ones, how many have the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
SEED = "1"
#: Bytes classed at a time, and bytes of a group of texts.
STRETCH, BATCH_BYTES = 1 << 22, 1 << 22

#: Width in bytes of the code point that a byte begins; 0 for bytes within one.
WIDTH = np.repeat(np.array([1, 0, 2, 3, 4], np.uint8), [0x80, 0x40, 0x20, 0x10, 0x10])


class Runs:
    """Maximal runs of code points of one width in texts laid end to end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        units, places, widths = [], [], []
        self.total, last = 0, 0
        for a in range(0, len(data), STRETCH):
            width = WIDTH[data[a : a + STRETCH]]
            at = np.flatnonzero(width)
            width = width[at]
            if not len(at):
                continue
            new = np.concatenate([[width[0] != last], width[1:] != width[:-1]])
            units.append(np.flatnonzero(new) + self.total)
            places.append(at[new] + a)
            widths.append(width[new])
            self.total, last = self.total + len(at), width[-1]
        join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)
        self.units, self.places, self.widths = join(units), join(places), join(widths)
        #: Units before each text and, last, of all.
        self.before = self.unit(offsets)

    def byte(self, units: np.ndarray) -> np.ndarray:
        """Where the given numbers of units end."""
        if not len(self.units):
            return np.zeros(len(units), np.int64)
        run = np.maximum(np.searchsorted(self.units, units, side="right") - 1, 0)
        return self.places[run] + (units - self.units[run]) * self.widths[run]

    def unit(self, places: np.ndarray) -> np.ndarray:
        """The units before bytes at which code points begin or the texts end."""
        if not len(self.units):
            return np.zeros(len(places), np.int64)
        run = np.maximum(np.searchsorted(self.places, places, side="right") - 1, 0)
        return self.units[run] + (places - self.places[run]) // self.widths[run]


def draws(doc_id: int | None, seed: str) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers from the seed and a doc_id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = SEED, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """The rows without their text, with n, form (plain, psm or spm), prefix_chars and middle_chars (null if plain) and output."""
    added = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
    names = {f.name for f in added} | {text.lower()}
    kept = docs.select(*without(docs, names), F.col(key).cast("long").alias("__key"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("__text"))
    schema = T.StructType(kept.schema.fields[:-2] + added)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def group(rows: pa.RecordBatch) -> list[pa.Array]:
        offsets, data = column_bytes(rows.column(rows.num_columns - 1))
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        runs = Runs(data, offsets)
        n = np.diff(runs.before)
        whole = data.tobytes()
        texts = [whole[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        forms, low, high = [], np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        for i, (doc_id, size, found) in enumerate(zip(rows.column(rows.num_columns - 2).to_pylist(), n.tolist(), texts, strict=True)):
            h1, h2, h3, h4 = draws(doc_id, seed)
            low[i], high[i] = sorted((h1 % (size + 1), h2 % (size + 1)))
            plain = not found or h3 % 100 >= transformed or any(m in found for m in marks)
            forms.append("plain" if plain else "spm" if h4 % 100 < suffix_first else "psm")
        first = (runs.byte(runs.before[:-1] + low) - offsets[:-1]).tolist()
        second = (runs.byte(runs.before[:-1] + high) - offsets[:-1]).tolist()
        out = []
        for form, found, a, b in zip(forms, texts, first, second, strict=True):
            prefix, suffix = (marks[0], found[:a]), (marks[1], found[b:])
            parts = [found] if form == "plain" else [*prefix, *suffix] if form == "psm" else [*suffix, *prefix]
            out.append(b"".join(parts if form == "plain" else [*parts, marks[2], found[a:b]]))
        plain = np.array([f == "plain" for f in forms])
        return [pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(low, pa.int64(), mask=plain), pa.array(high - low, pa.int64(), mask=plain), pa.array(out, pa.binary()).cast(pa.string())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, batch.column(batch.num_columns - 1), BATCH_BYTES):
                yield pa.RecordBatch.from_arrays(rows.columns[:-2] + group(rows), [f.name for f in schema])

    return kept.mapInArrow(run, schema)


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text that an output was made from."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    suffix_first = form == F.lit("spm")
    second = F.when(suffix_first, F.instr(output, PREFIX)).otherwise(F.instr(output, SUFFIX))
    third = F.instr(output, MIDDLE)
    size = F.lit(len(PREFIX))
    one = F.substring(output, size + 1, second - size - 1)
    two = F.substring(output, second + size, third - second - size)
    middle = F.substring(output, third + size, F.length(output))
    return F.when(form == F.lit("plain"), output).when(suffix_first, F.concat(two, middle, one)).otherwise(F.concat(one, middle, two))


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every document."""
    made = transform(docs.select(F.col("doc_id").cast("long"), F.col("text")))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored()).alias("restored_sha256"))
