"""From raw declaration lines to partner detail and World lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.sources.fixed_values import (
    TOTAL_CUSTOMS,
    TOTAL_MOT,
    TOTAL_PARTNER2,
    WORLD_PARTNER,
)

BREAKDOWN_COLUMNS = ("motCode", "customsCode", "partner2Code")
CONSTANT_COLUMNS = ("flowCode", "cmdCode")


def is_total_line() -> Column:
    return (
        (F.col("motCode") == TOTAL_MOT)
        & (F.col("customsCode") == TOTAL_CUSTOMS)
        & (F.col("partner2Code") == TOTAL_PARTNER2)
    )


def totals_only(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Drop transport, customs and consignment breakdowns, which repeat the total line.

    The columns that became constant go too, except those used as grouping keys.
    """
    constant = [c for c in BREAKDOWN_COLUMNS + CONSTANT_COLUMNS if c not in keys]
    return raw.filter(is_total_line()).drop(*constant)


def totals_summary(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Lines read, kept and dropped by totals_only, in one pass."""
    kept = F.count_if(is_total_line())
    return raw.groupBy(*keys).agg(
        F.count("*").alias("n_lines"),
        kept.alias("n_kept"),
        (F.count("*") - kept).alias("n_dropped"),
    )


def split_detail(totals: DataFrame) -> DataFrame:
    """Partner lines: one row per origin."""
    return totals.filter(F.col("partnerCode") != WORLD_PARTNER)


def split_world(totals: DataFrame) -> DataFrame:
    """World lines: the reporter's own total."""
    return totals.filter(F.col("partnerCode") == WORLD_PARTNER)
