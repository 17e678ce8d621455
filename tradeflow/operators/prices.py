"""Prices, the refining margin, and its correlation with volumes at a lag."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import month_index, month_start, pearson, until, year_month_between
from tradeflow.sources.fixed_values import (
    CRUDE,
    END_PERIOD,
    GALLONS_PER_BARREL,
    KG_PER_TONNE,
    MAX_LAG,
    PRICE_SERIES,
    PRODUCT,
    START_PERIOD,
)


def tidy_prices(
    points: DataFrame,
    series: Sequence[str] = PRICE_SERIES,
    start: str = START_PERIOD,
    end: str = END_PERIOD,
) -> DataFrame:
    """(series, period, value) -> one row per month with a column per series.

    A month known to one series only keeps NULL in the others, like a full outer join, but
    grouped in one pass. Periods are zero-padded 'YYYY-MM' text, so they compare as text.
    """
    columns = [F.max(F.when(F.col("series") == s, F.col("value"))).alias(s) for s in series]
    part = F.split("period", "-")
    return (
        points.filter(F.col("period").between(start, end) & F.col("series").isin(*series))
        .groupBy("period")
        .agg(*columns)
        .select(
            *series,
            part[0].cast("int").alias("refYear"),
            part[1].cast("int").alias("refMonth"),
        )
    )


def crack_spread(
    prices: DataFrame,
    crude: str = CRUDE,
    product: str = PRODUCT,
    per_barrel: float = GALLONS_PER_BARREL,
) -> DataFrame:
    """Product price per barrel and its margin over crude."""
    product_bbl = F.col(product) * per_barrel
    return prices.select(
        "refYear",
        "refMonth",
        crude,
        product,
        product_bbl.alias("diesel_usd_bbl"),
        (product_bbl - F.col(crude)).alias("crack_spread_usd_bbl"),
    )


def crack_spread_view(prices: DataFrame, name: str = "crack_spread", **columns: str) -> None:
    """Register the margin as a view, computed when queried."""
    crack_spread(prices, **columns).createOrReplaceTempView(name)


def crack_spread_window(spread: DataFrame, start: str | date, end: str | date) -> DataFrame:
    return spread.filter(year_month_between(start, end)).select(
        "refYear", "refMonth", "crack_spread_usd_bbl"
    )


def monthly_volume(flows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return flows.groupBy(*keys, "refYear", "refMonth").agg(
        (F.sum("netWgt") / KG_PER_TONNE).alias("extra_zone_tonnes")
    )


def price_flow(
    flows: DataFrame,
    spread: DataFrame,
    keys: Sequence[str] = (),
    end_date: str | date | None = None,
) -> DataFrame:
    """Monthly tonnes beside the margin, for months that have both.

    Volumes are summed before the join, so it meets one row per month, not every flow.
    """
    margin = spread.select("refYear", "refMonth", "crack_spread_usd_bbl")
    return (
        until(monthly_volume(flows, keys), end_date)
        .join(margin, ["refYear", "refMonth"])
        .withColumn("date", month_start())
        .select(*keys, "refYear", "refMonth", "date", "extra_zone_tonnes", "crack_spread_usd_bbl")
    )


def _earlier(column: str, k: int, keys: Sequence[str], calendar: bool) -> str:
    """Value k rows earlier, or exactly k months earlier when calendar (NULL if that month is absent)."""
    by = f"PARTITION BY {', '.join(keys)} " if keys else ""
    if calendar:
        exact = f"RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING" if k else "RANGE BETWEEN CURRENT ROW AND CURRENT ROW"
        return f"max({column}) OVER ({by}ORDER BY _month {exact})"
    return f"lag({column}, {k}) OVER ({by}ORDER BY _month)"


def lag_correlation(
    monthly: DataFrame,
    volume: str = "extra_zone_tonnes",
    price: str = "crack_spread_usd_bbl",
    max_lag: int = MAX_LAG,
    keys: Sequence[str] = (),
    changes: bool = False,
    calendar: bool = False,
) -> DataFrame:
    """Correlation of volume with the price k months before, k = 0..max_lag, on (keys, lag, r, n).

    changes compares month-over-month differences instead of levels. By default a lag counts
    rows, so a missing month shifts what follows; calendar counts months. r is NULL when a side
    is constant or fewer than two pairs exist. All lags come from one sort per key.
    """
    series = monthly.select(
        *keys, month_index().alias("_month"), F.col(volume).alias("x"), F.col(price).alias("y")
    )
    if changes:
        series = series.selectExpr(
            *keys, "_month", *[f"{c} - {_earlier(c, 1, keys, calendar)} AS {c}" for c in "xy"]
        )
    lags = range(max_lag + 1)
    lagged = series.selectExpr(
        *keys, "x", *[f"{_earlier('y', k, keys, calendar)} AS y{k}" for k in lags]
    )
    per_lag = F.array(
        *[
            F.struct(
                pearson("x", f"y{k}").alias("r"),
                F.expr(f"count_if(x IS NOT NULL AND y{k} IS NOT NULL) AS n"),
            )
            for k in lags
        ]
    )
    return (
        lagged.groupBy(*keys)
        .agg(per_lag.alias("by_lag"))
        .select(*keys, F.posexplode("by_lag").alias("lag", "fit"))
        .select(*keys, "lag", "fit.r", "fit.n")
    )


def best_lag(correlations: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The lag with the largest r, and the one with the largest |r|; ties go to the shorter lag."""
    shorter = -F.col("lag")
    return (
        correlations.filter(F.col("r").isNotNull())
        .groupBy(*keys)
        .agg(
            F.max_by("lag", F.struct("r", shorter)).alias("best_lag"),
            F.max("r").alias("best_r"),
            F.max_by("lag", F.struct(F.abs("r"), shorter)).alias("best_abs_lag"),
            F.max(F.abs("r")).alias("best_abs_r"),
        )
    )
