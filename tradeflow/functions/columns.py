"""Column helpers shared by the operators. All are built-in expressions, so they stay in codegen."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_start(year: str = "refYear", month: str = "refMonth") -> Column:
    """First day of the month held in two integer columns."""
    return F.make_date(F.col(year), F.col(month), F.lit(1))


def month_index(year: str = "refYear", month: str = "refMonth") -> Column:
    """Months since year 0: consecutive months are consecutive integers."""
    return (F.col(year) * 12 + F.col(month) - 1).cast("int")


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is zero (ANSI division would fail the job)."""
    return F.try_divide(num, den)


def pct(num: Column, den: Column) -> Column:
    return ratio(num, den) * 100


def pearson(x: str, y: str) -> Column:
    """Pearson correlation over rows where both are present; NULL if either side is constant."""
    return F.expr(
        f"try_divide(covar_pop({x}, {y}), "
        f"stddev_pop(if({y} IS NULL, NULL, {x})) * stddev_pop(if({x} IS NULL, NULL, {y})))"
    )


def as_date(value: str | date) -> Column:
    return F.lit(value).cast("date")


def until(df: DataFrame, end_date: str | date | None) -> DataFrame:
    """Keep months up to and including end_date; None keeps all.

    Besides the exact test it states the year bound on the bare column, which prunes
    partitions of a table partitioned by refYear.
    """
    if end_date is None:
        return df
    end = as_date(end_date)
    return df.filter((F.col("refYear") <= F.year(end)) & (month_start() <= end))


def year_month_between(start: str | date, end: str | date) -> Column:
    """Month window test on refYear / refMonth, with the year bounds stated for pruning."""
    first, last = as_date(start), as_date(end)
    return (
        F.col("refYear").between(F.year(first), F.year(last))
        & month_start().between(first, last)
    )
