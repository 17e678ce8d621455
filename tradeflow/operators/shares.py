"""Origin rankings, monthly volumes, market shares and the speed of a transition.

Every function takes flows already filtered to what should count (zone.countries for all
declared imports, zone.extra_zone_countries for external sourcing). The fact table is read
once into an origin x month rollup; ranking and monthly volumes both start from its one
shuffle, and joins and windows only ever see rolled-up rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.functions import month_start, pct, until, year_month_between
from tradeflow.functions.columns import as_date
from tradeflow.plans.running import in_ranges, running
from tradeflow.sources.fixed_values import CUTOVER, KG_PER_TONNE, LOW_SHARE_PCT, TOP_N

OTHER = "Other"


def origin_month(flows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Weight per origin and month: the rollup the analyses share."""
    return flows.groupBy(*keys, "refYear", "refMonth", "partnerName").agg(
        F.sum("netWgt").alias("netWgt")
    )


def _tonnes(weight: Column) -> Column:
    return weight / KG_PER_TONNE


def top_origins(flows: DataFrame, n: int = TOP_N, keys: Sequence[str] = ()) -> DataFrame:
    """The n largest origins by volume; ties go by name. rank starts at 1."""
    total = flows.groupBy(*keys, "partnerName").agg(_tonnes(F.sum("netWgt")).alias("total_t"))
    by_volume = Window.partitionBy(*keys).orderBy(F.desc("total_t"), "partnerName")
    return total.withColumn("rank", F.row_number().over(by_volume)).filter(F.col("rank") <= n)


def _ranked_months(flows: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """The rollup with the rank of each origin, NULL for those beyond the top n."""
    rollup = origin_month(flows, keys)
    top = top_origins(rollup, n, keys).drop("total_t")
    return rollup.join(top, [*keys, "partnerName"], "left")


def origin_monthly(
    flows: DataFrame,
    n: int = TOP_N,
    keys: Sequence[str] = (),
    end_date: str | date | None = None,
) -> DataFrame:
    """Monthly tonnes of the top n origins, the rest pooled as Other.

    The ranking is over all months; end_date then cuts the months returned. The rolled-up rows
    are placed by month, where both this grouping and a share of the month find them: one
    shuffle for the two. A month has one row per origin, so no place is overfull.
    """
    origin = F.when(F.col("rank").isNotNull(), F.col("partnerName")).otherwise(OTHER)
    return (
        until(_ranked_months(flows, n, keys), end_date)
        .repartition(*keys, "refYear", "refMonth")
        .groupBy(*keys, "refYear", "refMonth", origin.alias("origin"))
        .agg(_tonnes(F.sum("netWgt")).alias("tonnes"))
    )


def origin_pivot(
    flows: DataFrame,
    n: int = TOP_N,
    keys: Sequence[str] = (),
    end_date: str | date | None = None,
) -> DataFrame:
    """Month x origin matrix with columns top1..topN, other; a missing cell is 0.

    Columns are numbered by rank, so the schema does not depend on the data; top_origins
    holds the name behind each number.
    """

    def cell(condition: Column) -> Column:
        return F.coalesce(_tonnes(F.sum(F.when(condition, F.col("netWgt")))), F.lit(0.0))

    slots = [cell(F.col("rank") == i).alias(f"top{i}") for i in range(1, n + 1)]
    return (
        until(_ranked_months(flows, n, keys), end_date)
        .groupBy(*keys, month_start().alias("date"))
        .agg(*slots, cell(F.col("rank").isNull()).alias("other"))
    )


def _with_share(monthly: DataFrame, keys: Sequence[str]) -> DataFrame:
    month = Window.partitionBy(*keys, "refYear", "refMonth")
    return monthly.withColumn("share_pct", pct(F.col("tonnes"), F.sum("tonnes").over(month)))


def market_share(
    flows: DataFrame,
    n: int = TOP_N,
    keys: Sequence[str] = (),
    end_date: str | date | None = None,
) -> DataFrame:
    """Tonnes of each top origin and Other, and their percentage of the month's total."""
    return _with_share(origin_monthly(flows, n, keys, end_date), keys)


def origin_share(
    flows: DataFrame, keys: Sequence[str] = (), end_date: str | date | None = None
) -> DataFrame:
    """Monthly share of every origin by its own name, none pooled."""
    monthly = until(origin_month(flows, keys), end_date).select(
        *keys,
        "refYear",
        "refMonth",
        F.col("partnerName").alias("origin"),
        _tonnes(F.col("netWgt")).alias("tonnes"),
    )
    return _with_share(monthly, keys)


def transition_speed(
    shares: DataFrame,
    cutover: str | date = CUTOVER,
    threshold_pct: float = LOW_SHARE_PCT,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Per origin: mean share before the cutover, and how soon after it fell under a threshold.

    months_elapsed and first_low are NULL when it never did (ever_low = false). Shares from
    origin_share cover origins that market_share would pool into Other.
    """
    cut = as_date(cutover)
    is_low = (F.col("date") >= cut) & (F.col("share_pct") < threshold_pct)
    per_origin = (
        shares.withColumn("date", month_start())
        .groupBy(*keys, "origin")
        .agg(
            F.avg(F.when(F.col("date") < cut, F.col("share_pct"))).alias("baseline_share_pct"),
            F.avg(F.when(F.col("date") >= cut, F.col("share_pct"))).alias("after_share_pct"),
            F.min(F.when(is_low, F.col("date"))).alias("first_low"),
        )
    )
    elapsed = (F.year("first_low") - F.year(cut)) * 12 + F.month("first_low") - F.month(cut)
    return per_origin.withColumn("months_elapsed", elapsed.cast("int")).withColumn(
        "ever_low", F.col("first_low").isNotNull()
    )


def share_window(
    shares: DataFrame, origin: str, start: str | date, end: str | date
) -> DataFrame:
    """Shares of one origin in a range of months."""
    return shares.filter((F.col("origin") == origin) & year_month_between(start, end))


def coverage(flows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Tonnes per origin and the running percentage of the total, largest first.

    Origins of equal volume share one running value. Without keys the ranking window is one
    task, over one row per origin.
    """
    total = flows.groupBy(*keys, "partnerName").agg(F.sum("netWgt").alias("netWgt"))
    everything = Window.partitionBy(*keys)
    largest_first = everything.orderBy(F.desc("netWgt")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return total.select(
        *keys,
        "partnerName",
        _tonnes(F.col("netWgt")).alias("tonnes"),
        pct(F.sum("netWgt").over(largest_first), F.sum("netWgt").over(everything)).alias(
            "cumulative_pct"
        ),
    )


def coverage_ranges(flows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """coverage() for any number of origins: no task holds all of a key's, and ties share a value all the same.

    Origins are dealt into ranges by volume, summed within them, and each range is raised by the sums of the
    ones before. The origins' sums are written once; coverage() is quicker for a list of countries.
    """
    total = flows.groupBy(*keys, "partnerName").agg(F.sum("netWgt").alias("netWgt"))
    order = [F.col("netWgt").desc()]
    ranges = in_ranges(total, [*keys, *order], "origins")
    upto = running(ranges, keys, order, {"upto": ("sum", F.col("netWgt"))}, peers=True)
    # One row a key, or one at all; what a key has in sum is not known within its ranges.
    whole = ranges.groupBy(*keys).agg(F.sum("netWgt").alias("whole"))
    if keys:
        whole = whole.select(*[F.col(k).alias(f"_{k}") for k in keys], "whole")
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        joined = upto.join(whole, reduce(Column.__and__, same))
    else:
        joined = upto.withColumn("whole", whole.scalar())
    return joined.select(
        *keys,
        "partnerName",
        _tonnes(F.col("netWgt")).alias("tonnes"),
        pct(F.col("upto"), F.col("whole")).alias("cumulative_pct"),
    )


def coverage_covered(
    coverage_report: DataFrame, distances: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Running percentage reached by the origins that have a distance."""
    known = coverage_report.join(distances, "partnerName", "left_semi")
    return known.groupBy(*keys).agg(
        F.count("*").alias("n_origins"), F.max("cumulative_pct").alias("covered_pct")
    )
