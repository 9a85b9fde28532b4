"""Missing uncertainties by quantiles of the relative uncertainty, per channel with a global fallback."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparvane.functions.clean import safe_ratio
from sparvane.operators.quantile import quantile
from sparvane.sources.shared import few, materialize

QUANTILE, CAP = 0.90, 10.0


def global_quantile(df: DataFrame, data: str = "Data", error: str = "dData", q: float = QUANTILE, name: str = "global_fraction") -> DataFrame:
    """One row: the exact quantile of error / data."""
    return quantile(df, [], safe_ratio(F.col(error), F.col(data)), q, name)


def complete(columns: list[str]) -> Column:
    """Whether a row has all of the columns."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def channel_fractions(df: DataFrame, channel: list[str], gate: list[str], data: str = "Data", error: str = "dData", q: float = QUANTILE, cap: float = CAP) -> DataFrame:
    """(channel, fraction): the capped quantile where a row of the channel has all gate columns, else null.

    Quantiles are by rank selection, so no task holds the ratios of a channel with very many rows.
    """
    whole = df.groupBy(*channel).agg(F.bool_or(complete(gate)).alias("whole"))
    found = quantile(df, channel, safe_ratio(F.col(error), F.col(data)), q, "q").withColumnsRenamed({c: f"__{c}" for c in channel})
    on = reduce(lambda a, b: a & b, [whole[c].eqNullSafe(found[f"__{c}"]) for c in channel])
    return whole.join(found, on).select(*channel, F.when(F.col("whole"), F.least("q", F.lit(cap))).alias("fraction"))


def assume_errors(df: DataFrame, channel: list[str], gate: list[str], data: str = "Data", error: str = "dData", assumed: str = "dData_assumed", fallback: DataFrame | None = None, q: float = QUANTILE, cap: float = CAP) -> DataFrame:
    """df with ``assumed``: the error, or data times the channel's fraction, or times the global one.

    fallback: one row with ``global_fraction``, by default of df itself.
    """
    fallback = global_quantile(df, data, error, q) if fallback is None else fallback
    fractions = channel_fractions(df, channel, gate, data, error, q, cap).crossJoin(F.broadcast(fallback))  # one row
    # one row a channel: the rows of a channel need not meet in a task
    fractions = few(materialize(fractions.select(*channel, F.coalesce("fraction", "global_fraction").alias("fraction")), "fractions"))
    on = reduce(lambda a, b: a & b, [df[c].eqNullSafe(fractions[c]) for c in channel])
    return df.join(fractions, on, "left").select(df["*"], F.coalesce(df[error], df[data] * fractions["fraction"]).alias(assumed))
