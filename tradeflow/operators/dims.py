"""Dimension tables derived from data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.functions.columns import as_date
from tradeflow.sources.fixed_values import CATCH_ALL_MARKER, PLACEHOLDER_PARTNERS


def is_special_partner(
    code: str, name: str, placeholders: Sequence[int] = PLACEHOLDER_PARTNERS
) -> Column:
    """Not a real country: a regional catch-all by name or a placeholder by code.

    The marker may stand anywhere in the name, in any case. An unnamed partner is not special
    by name. Never NULL.
    """
    by_name = F.contains(F.lower(F.col(name)), F.lit(CATCH_ALL_MARKER))
    by_code = F.col(code).isin(*placeholders)
    return F.coalesce(by_name, F.lit(False)) | F.coalesce(by_code, F.lit(False))


def partner_dim(
    areas: DataFrame, placeholders: Sequence[int] = PLACEHOLDER_PARTNERS
) -> DataFrame:
    """Published partner list -> partnerCode, partnerName, iso2, iso3, is_special_partner."""
    return areas.select(
        F.col("PartnerCode").alias("partnerCode"),
        F.col("PartnerDesc").alias("partnerName"),
        F.col("PartnerCodeIsoAlpha2").alias("iso2"),
        F.col("PartnerCodeIsoAlpha3").alias("iso3"),
        is_special_partner("PartnerCode", "PartnerDesc", placeholders).alias(
            "is_special_partner"
        ),
    )


def _with_calendar(days: DataFrame) -> DataFrame:
    return days.select(
        "Date",
        F.year("Date").alias("Year"),
        F.month("Date").alias("Month"),
        F.date_format("Date", "MMM").alias("MonthName"),
    )


def _months(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("Date")


def date_dim(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """One row per month from start to end, both included."""
    return _with_calendar(spark.range(1).select(_months(as_date(start), as_date(end))))


def date_dim_of(flows: DataFrame) -> DataFrame:
    """Month dimension spanning the months of a fact table, gaps included."""
    first_day = F.make_date("refYear", "refMonth", F.lit(1))
    span = flows.agg(F.min(first_day).alias("first"), F.max(first_day).alias("last"))
    return _with_calendar(span.select(_months(F.col("first"), F.col("last"))))
