"""Completeness report: what landed against what should have landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import pct
from tradeflow.sources.fixed_values import WORLD_PARTNER

MONTHS_PER_YEAR = 12
MAX_GAP_PCT = 0.5


def _listed(values: Column) -> Column:
    """A collected set as text, in order."""
    return F.array_join(F.array_sort(values).cast("array<string>"), ",")


def completeness(envelopes: DataFrame, grid: DataFrame) -> DataFrame:
    """One row per expected (reporter, year), with quality figures where a file landed.

    Figures are taken over all lines of the file, breakdowns included. Every distinct
    value kept here (months, partners, transport and customs codes) comes from a short code
    list, so the sets stay small, combine on the map side, and one grouping serves all.
    """
    line = envelopes.select("iso3", "year", "unreadable", F.explode_outer("data").alias("r")).select(
        "iso3", "year", "unreadable", F.col("r").isNotNull().alias("is_line"), "r.*"
    )
    weight = F.coalesce("netWgt", F.lit(0.0))
    is_world = F.col("partnerCode") == WORLD_PARTNER
    found = line.groupBy("iso3", "year").agg(
        F.count_if("is_line").alias("n_rows"),
        F.bool_or("unreadable").alias("unreadable"),
        F.collect_set("refMonth").alias("months"),
        F.collect_set("partnerCode").alias("partners"),
        F.collect_set("motCode").alias("mots"),
        F.collect_set("customsCode").alias("customs"),
        F.sum(F.when(is_world, weight).otherwise(0.0)).alias("world"),
        F.sum(F.when(~is_world, weight).otherwise(0.0)).alias("detail"),
        F.count_if(F.col("is_line") & (weight == 0)).alias("n_zero_netwgt"),
        F.count_if("isNetWgtEstimated").alias("n_estimated_wgt"),
    )
    gap = pct(F.abs(F.col("world") - F.col("detail")), F.col("world"))
    report = found.select(
        "iso3",
        "year",
        "unreadable",
        "n_rows",
        F.size("months").cast("long").alias("n_months"),
        _listed(F.col("months")).alias("months_present"),
        F.size("partners").cast("long").alias("n_partners"),
        F.array_contains("partners", WORLD_PARTNER).alias("has_world_line"),
        gap.alias("world_gap_pct"),
        "n_zero_netwgt",
        "n_estimated_wgt",
        _listed(F.col("mots")).alias("mot_codes"),
        _listed(F.col("customs")).alias("customs_codes"),
    )
    return grid.join(report, ["iso3", "year"], "left").select(
        F.col("iso3").alias("reporter"),
        "year",
        F.col("n_rows").isNotNull().alias("file_exists"),
        *[c for c in report.columns if c not in ("iso3", "year")],
    )


def unreadable_files(report: DataFrame) -> DataFrame:
    """Landed, but cut short or with values of another type than declared."""
    return report.filter("unreadable").select("reporter", "year")


def empty_files(report: DataFrame) -> DataFrame:
    """Landed and readable, but without lines: candidates for another download."""
    return report.filter("file_exists AND NOT unreadable AND n_rows = 0").select("reporter", "year")


def partial_years(report: DataFrame) -> DataFrame:
    return report.filter((F.col("n_rows") > 0) & (F.col("n_months") < MONTHS_PER_YEAR)).select(
        "reporter", "year", "n_months", "months_present"
    )


def gap_files(report: DataFrame, max_gap_pct: float = MAX_GAP_PCT) -> DataFrame:
    """Files whose partner lines do not add up to the World line."""
    return report.filter(F.col("world_gap_pct") > max_gap_pct).select(
        "reporter", "year", "world_gap_pct"
    )


def code_lists(report: DataFrame) -> DataFrame:
    """Distinct transport and customs code lists over all files."""
    kinds = F.array(
        *[
            F.struct(F.lit(name).alias("kind"), F.col(name).alias("codes"))
            for name in ("mot_codes", "customs_codes")
        ]
    )
    return (
        report.select(F.explode(kinds).alias("k"))
        .select("k.kind", "k.codes")
        .filter("codes IS NOT NULL")
        .distinct()
    )


def file_counts(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count("*").alias("n_expected"), F.count_if("file_exists").alias("n_present")
    )
