"""Star-schema tables for reporting: facts and dimensions related by a first-of-month Date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import month_start, until
from tradeflow.operators.quality import enforce, orphan_dates
from tradeflow.operators.zone import zone_flag
from tradeflow.sources.fixed_values import END_PERIOD
from tradeflow.sources.tables import write_csv

END_DATE = f"{END_PERIOD}-01"

FLOW_COLUMNS = (
    "refYear", "refMonth", "reporterCode", "reporterName", "partnerCode", "partnerName",
    "iso2", "iso3", "is_special_partner", "isExtraZone",
    "netWgt", "primaryValue", "isNetWgtEstimated",
)


def flows_mart(
    flows: DataFrame,
    zone: DataFrame | None = None,
    end_date: str | date | None = END_DATE,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Flows with isExtraZone and Date. The zone is read off all flows, not just those kept."""
    flagged = zone_flag(flows, zone)
    return until(flagged, end_date).select(*keys, *FLOW_COLUMNS, month_start().alias("Date"))


def price_flow_mart(price_flow: DataFrame, end_date: str | date | None = None) -> DataFrame:
    return until(price_flow, end_date).withColumnRenamed("date", "Date")


def market_shares_mart(shares: DataFrame, end_date: str | date | None = None) -> DataFrame:
    return until(shares, end_date).withColumn("Date", month_start())


def tonne_miles_mart(monthly: DataFrame, end_date: str | date | None = None) -> DataFrame:
    return until(monthly, end_date).withColumnRenamed("date", "Date")


def star_schema(
    flows: DataFrame,
    price_flow: DataFrame,
    shares: DataFrame,
    tonne_miles: DataFrame,
    distances: DataFrame,
    calendar: DataFrame,
    zone: DataFrame | None = None,
    end_date: str | date | None = END_DATE,
    keys: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """All reporting tables by name, every fact cut at end_date."""
    return {
        "flows": flows_mart(flows, zone, end_date, keys),
        "date_dim": calendar,
        "price_flow_monthly": price_flow_mart(price_flow, end_date),
        "distances": distances,
        "market_shares": market_shares_mart(shares, end_date),
        "tonne_miles": tonne_miles_mart(tonne_miles, end_date),
    }


def check_dates(marts: dict[str, DataFrame], dimension: str = "date_dim") -> None:
    """Fail if a fact holds a date that the date dimension lacks."""
    for name, mart in marts.items():
        if name != dimension and "Date" in mart.columns:
            enforce(orphan_dates(mart, marts[dimension]), f"dates of {name}")


# Columns that exported tables are ordered by, as far as a table has them: time, then size or name.
ORDER = (
    "refYear", "refMonth", "Date", "lag", "reporter", "year", "reporterCode", "partnerCode",
    "-total_t", "-tonnes", "origin", "partnerName", "confidence", "reporterName",
)


def in_order(mart: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows in the order of the keys and of ORDER; a range-partitioned sort, not a single task."""
    named = [c for c in ORDER if c.removeprefix("-") in mart.columns]
    by = [F.asc(k) for k in keys] + [F.desc(c[1:]) if c[0] == "-" else F.asc(c) for c in named]
    return mart.orderBy(*by) if by else mart


def export(marts: dict[str, DataFrame], folder: str, keys: Sequence[str] = ()) -> None:
    """Write each mart as CSV with a header under folder/name, rows in order over its files."""
    for name, mart in marts.items():
        write_csv(in_order(mart, [k for k in keys if k in mart.columns]), f"{folder}/{name}")
