"""Data-quality checks. Each returns its violations as rows; enforce() turns them into a failure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import month_start, pct
from tradeflow.sources.fixed_values import CONSTANT_CODES, WORLD_PARTNER


class DataQualityError(ValueError):
    """A check found rows that must not exist."""


def enforce(violations: DataFrame, name: str, show: int = 20) -> None:
    """Raise if there is any violation, quoting at most `show` of them."""
    rows = violations.limit(show).collect()
    if rows:
        listed = "; ".join(str(r.asDict()) for r in rows)
        raise DataQualityError(f"{name}: {listed}")


def constant_violations(
    df: DataFrame, expected: Mapping[str, Sequence[str]] = CONSTANT_CODES
) -> DataFrame:
    """Values of the given columns outside their expected set, and expected values never seen.

    Columns: column, value, n_rows (0 for a value that is absent). Lines are counted by the values
    of all columns together, once, and only these few groups are taken apart by column.
    """
    names = list(expected)

    def pair(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("column"), value.cast("string").alias("value"))

    def apart(source: DataFrame, pairs: list[Column], n: Column, wanted: bool) -> DataFrame:
        return source.select(
            F.explode(F.array(*pairs)).alias("pair"), n.alias("n"), F.lit(wanted).alias("wanted")
        )

    groups = df.groupBy(*names).agg(F.count("*").alias("n_lines"))
    seen = apart(groups, [pair(name, F.col(name)) for name in names], F.col("n_lines"), False)
    listed = [pair(name, F.lit(v)) for name, values in expected.items() for v in values]
    wanted = apart(df.sparkSession.range(1), listed, F.lit(0).cast("long"), True)
    return (
        seen.unionByName(wanted)
        .groupBy("pair.column", "pair.value")
        .agg(F.sum("n").alias("n_rows"), F.bool_or("wanted").alias("wanted"))
        .filter((F.col("n_rows") == 0) | ~F.col("wanted"))
        .drop("wanted")
    )


def unmatched_codes(df: DataFrame, dim: DataFrame, code: str) -> DataFrame:
    """Distinct codes of df that the dimension does not know."""
    return df.select(code).distinct().join(dim, code, "left_anti")


def unknown_codes(df: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Codes of df that their dimension does not know, for several columns in one scan of df.

    Columns: column, code. The scan leaves the distinct combinations of codes, a short list.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("code")) for c in dims]
    seen = df.select(*dims).distinct().select(F.explode(F.array(*pairs)).alias("pair"))
    known = [dim.select(F.lit(c).alias("column"), F.col(c).alias("code")) for c, dim in dims.items()]
    return seen.select("pair.*").distinct().join(
        reduce(DataFrame.unionByName, known), ["column", "code"], "left_anti"
    )


def duplicate_keys(dim: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; joining such a dimension would multiply the facts."""
    return dim.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def missing_prices(prices: DataFrame, series: Sequence[str]) -> DataFrame:
    """Months of a tidy price table in which a series has no value."""
    gaps = F.filter(
        F.array(*[F.when(F.col(s).isNull(), F.lit(s)) for s in series]), lambda s: s.isNotNull()
    )
    return prices.select("refYear", "refMonth", F.explode(gaps).alias("series"))


def absent_months(prices: DataFrame, months: DataFrame) -> DataFrame:
    """Months of a date dimension that a tidy price table does not hold at all."""
    expected = months.select(F.year("Date").alias("refYear"), F.month("Date").alias("refMonth"))
    return expected.join(prices, ["refYear", "refMonth"], "left_anti")


def orphan_dates(fact: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Dates of a mart fact that the date dimension lacks."""
    return fact.select("Date").distinct().join(date_dim, "Date", "left_anti")


def _reconciled(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per reporter and month: weight of partner lines beside weight of World lines.

    One conditional pass instead of two groupings and a join. A group whose weights are
    all NULL sums to 0; the line counts tell it from a group that has no lines.
    """
    is_world = F.col("partnerCode") == WORLD_PARTNER
    weight = F.col("netWgt")
    return totals.groupBy(*keys, "reporterCode", "refYear", "refMonth").agg(
        F.coalesce(F.sum(F.when(~is_world, weight)), F.lit(0.0)).alias("detail"),
        F.coalesce(F.sum(F.when(is_world, weight)), F.lit(0.0)).alias("world"),
        F.count_if(~is_world).alias("n_detail"),
        F.count_if(is_world).alias("n_world"),
    )


def _comparable() -> Column:
    return (F.col("n_detail") > 0) & (F.col("n_world") > 0) & (F.col("world") > 0)


def world_recon_monthly(totals: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Reporter-months where partner detail can be held against a non-zero World line."""
    return recon_monthly_of(_reconciled(totals, keys), keys)


def recon_monthly_of(reconciled: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return (
        reconciled.filter(_comparable())
        .select(
            *keys, "reporterCode", "refYear", "refMonth", "detail", "world",
            F.abs(F.col("detail") - F.col("world")).alias("gap"),
        )
    )


def world_recon(totals: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Overall gap between partner detail and World, and how many World lines weigh zero."""
    return recon_of(_reconciled(totals, keys), keys)


def recon_of(reconciled: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    ok = _comparable()
    gap = F.sum(F.when(ok, F.abs(F.col("detail") - F.col("world"))))
    return (
        reconciled.groupBy(*keys)
        .agg(
            F.count_if(ok).alias("n_reporter_months"),
            pct(gap, F.sum(F.when(ok, F.col("world")))).alias("gap_pct"),
            F.count_if((F.col("n_world") > 0) & (F.col("world") == 0)).alias("n_zero_world"),
        )
    )


def reporters_per_month(flows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """How many reporters have published each month."""
    return (
        flows.groupBy(*keys, "refYear", "refMonth")
        .agg(F.count_distinct("reporterCode").alias("n_reporters"))
        .withColumn("date", month_start())
    )
