"""Entry point A: source measurements to measurements with metrics, rollups and the channel summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparvane.functions.clean import NEUTRON_CHANNELS, derive, known_isotope
from sparvane.operators import impute, interp, rollup

EVALUATIONS = ("endf7-1", "endf8")
CHANNEL = ["Z", "A", "Reaction"]
#: Columns of ``measurements`` before any evaluation.
BASE = ["Reaction", "Projectile", "Energy", "dEnergy", "Data", "dData", "MT", "Dataset_Number", "EXFOR_Entry", "EXFOR_Subentry", "Year", "Author1Ini", "Author1", "Target", "fullCode", "A", "Element", "Z", "Author"]


def channel_rows(source: DataFrame, channels: dict[str, int] = NEUTRON_CHANNELS) -> DataFrame:
    """Derived rows of known isotopes in the given channels, with the channel's number as ``eval_MT``."""
    df = derive(source).where(known_isotope(F.col("Z"), F.col("A")))
    number = F.create_map(*[F.lit(x) for kv in channels.items() for x in kv])
    return df.where(F.col("Reaction").isin(list(channels))).withColumn("eval_MT", F.try_element_at(number, F.col("Reaction")).cast("short"))


def measurements(source: DataFrame, curves: DataFrame, evaluations: tuple[str, ...] = EVALUATIONS, channels: dict[str, int] = NEUTRON_CHANNELS, gate: str = "all_columns", outside: str = "zero", row_id: str = "measurement_id") -> DataFrame:
    """``measurements``: assumed uncertainties, and for each evaluation its value, chi-squared and relative error.

    The evaluations are passes in order: with the gate on all columns, the
    completeness test of a later pass sees the columns that the earlier ones
    added, so a channel without the first curve uses the global fraction in
    the second pass, and each pass's chi-squared uses that pass's fraction.
    gate="uncertainty_only" asks for dData alone. The global fraction is that
    of all source rows.
    """
    fallback = impute.global_quantile(derive(source))
    df = channel_rows(source, channels)
    added: list[str] = []
    for ev in evaluations:
        columns = ["dData"] if gate == "uncertainty_only" else [*BASE, *added]
        df = impute.assume_errors(df, CHANNEL, columns, assumed="__assumed", fallback=fallback).drop("dData_assumed").withColumnRenamed("__assumed", "dData_assumed")
        grid = curves.where(F.col("evaluation") == ev).select("Z", "A", F.col("MT").alias("eval_MT"), "energy", "xs")
        df = interp.interpolate(df, grid, ["Z", "A", "eval_MT"], "Energy", "energy", "xs", ev, outside=outside)
        df = interp.with_metrics(df, ev)
        added += [f"`{ev}`", f"`{ev}_chi_squared`", f"`{ev}_relative_error`", "dData_assumed"]
    tail = [c for ev in evaluations for c in (ev, f"{ev}_chi_squared", f"{ev}_relative_error")]
    ids = [row_id] if row_id in df.columns else []
    return df.select(*ids, *BASE, "dData_assumed", *[F.col(f"`{c}`") for c in tail])


def channel_summary(source: DataFrame, curves: DataFrame, evaluations: tuple[str, ...] = EVALUATIONS, channels: dict[str, int] = NEUTRON_CHANNELS, row_id: str = "measurement_id") -> DataFrame:
    """(Z, A, Symbol, Projectile, Reaction, MT, has_<evaluation> ...): one row per channel with measurements."""
    rows = channel_rows(source, channels)
    out = rows.groupBy("Z", "A", "Reaction", F.col("eval_MT").alias("MT")).agg(F.min_by("Element", row_id).alias("Symbol"))
    known = curves.groupBy("Z", "A", "MT").agg(*[F.bool_or(F.col("evaluation") == ev).alias(f"has_{ev}") for ev in evaluations])
    out = out.join(known, ["Z", "A", "MT"], "left")
    flags = [F.coalesce(F.col(f"`has_{ev}`"), F.lit(False)).alias(f"has_{ev}") for ev in evaluations]
    return out.select("Z", "A", "Symbol", F.lower(F.substring("Reaction", 1, 1)).alias("Projectile"), "Reaction", "MT", *flags)


def curve_grids(curves: DataFrame, points: int = 1000) -> DataFrame:
    """Each curve on the export grid of 1e-5 to 1e7: (evaluation, Z, A, MT, energy, xs)."""
    from sparvane.functions.vectors import logspace

    keys = ["evaluation", "Z", "A", "MT"]
    asked = curves.select(*keys).distinct().select(*keys, F.explode(logspace(-5, 7, points)).alias("energy"))
    return interp.interpolate(asked, curves.withColumnRenamed("energy", "grid_energy").withColumnRenamed("xs", "grid_xs"), keys, "energy", "grid_energy", "grid_xs", "xs", outside="zero")


def subentries(df: DataFrame, row_id: str = "measurement_id") -> DataFrame:
    return rollup.subentries(df, "EXFOR_Subentry", ["Z", "A", "MT", "Reaction", "Element", "EXFOR_Entry", "Dataset_Number"], row_id)


def entries(df: DataFrame, row_id: str = "measurement_id") -> DataFrame:
    sets = {"Z_Values": ("Z", ","), "Elements": ("Element", ","), "A_Values": ("A", ","), "MT_Codes": ("MT", ","), "Reactions": ("Reaction", "-")}
    return rollup.entries(df, "EXFOR_Entry", sets, "EXFOR_Subentry", row_id)


def all_of(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
