"""Tonne-miles and the distance table's reach."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.functions import month_start, pct, ratio, until
from tradeflow.functions.columns import as_date
from tradeflow.sources.fixed_values import CUTOVER, KG_PER_TONNE

NO_DISTANCE = "none"


def tonne_miles(
    flows: DataFrame,
    distances: DataFrame,
    keys: Sequence[str] = (),
    end_date: str | date | None = None,
) -> DataFrame:
    """Per month: tonnes, tonne-nautical-miles and the volume-weighted distance.

    Origins without a distance drop out. The distance table is small (stored or literal), so
    the facts are joined where they lie and shuffled once, as partial monthly sums.
    """
    weight = F.sum("netWgt")
    work = F.sum(F.col("netWgt") * F.col("nm_to_rotterdam"))
    return (
        until(flows, end_date)
        .join(distances.select("partnerName", "nm_to_rotterdam"), "partnerName")
        .groupBy(*keys, "refYear", "refMonth")
        .agg(
            (weight / KG_PER_TONNE).alias("extra_zone_tonnes"),
            (work / KG_PER_TONNE).alias("tonne_nm"),
            ratio(work, weight).alias("avg_distance_nm"),
        )
        .withColumn("date", month_start())
    )


def before_after(
    monthly: DataFrame, cutover: str | date = CUTOVER, keys: Sequence[str] = ()
) -> DataFrame:
    """Months before a date against months from it on.

    avg_distance is the plain mean of the monthly distances; pooled_distance weighs every
    tonne alike.
    """
    cut = as_date(cutover)
    before, after = F.col("date") < cut, F.col("date") >= cut

    def mean(column: str, side: Column) -> Column:
        return F.avg(F.when(side, F.col(column)))

    def pooled(side: Column) -> Column:
        return ratio(
            F.sum(F.when(side, F.col("tonne_nm"))),
            F.sum(F.when(side, F.col("extra_zone_tonnes"))),
        )

    was, now = mean("tonne_nm", before), mean("tonne_nm", after)
    return monthly.groupBy(*keys).agg(
        F.count_if(before).alias("months_before"),
        F.count_if(after).alias("months_after"),
        was.alias("tonne_nm_before"),
        now.alias("tonne_nm_after"),
        pct(now - was, was).alias("increase_pct"),
        mean("avg_distance_nm", before).alias("avg_distance_before"),
        mean("avg_distance_nm", after).alias("avg_distance_after"),
        pooled(before).alias("pooled_distance_before"),
        pooled(after).alias("pooled_distance_after"),
    )


def confidence_coverage(
    flows: DataFrame, distances: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Tonnes and share of volume per confidence of the distance used, 'none' where there is none."""
    confidence = F.coalesce("confidence", F.lit(NO_DISTANCE))
    sums = (
        flows.join(distances.select("partnerName", "confidence"), "partnerName", "left")
        .groupBy(*keys, confidence.alias("confidence"))
        .agg((F.sum("netWgt") / KG_PER_TONNE).alias("tonnes"))
    )
    total = F.sum("tonnes").over(Window.partitionBy(*keys))
    return sums.withColumn("volume_pct", pct(F.col("tonnes"), total))
