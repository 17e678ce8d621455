"""Inside or outside the reporting zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import checked_broadcast, pct
from tradeflow.sources.fixed_values import KG_PER_TONNE


def zone_of(flows: DataFrame) -> DataFrame:
    """Codes of the reporters that have rows: the zone as the flows themselves show it."""
    return flows.select("reporterCode").filter(F.col("reporterCode").isNotNull()).distinct()


def _zone_side(flows: DataFrame, zone: DataFrame | None) -> DataFrame:
    """Zone as the small side of a join on partnerCode.

    A stored zone table is sized by Spark itself. A zone derived from the flows has no size
    until it has run, so it is counted before it is broadcast; an unchecked plan would
    shuffle the whole fact table on partnerCode.
    """
    side = checked_broadcast(zone_of(flows)) if zone is None else zone
    return side.select(F.col("reporterCode").alias("partnerCode"))


def countries(flows: DataFrame) -> DataFrame:
    """Flows from real countries; a NULL flag is dropped like a true one."""
    return flows.filter(~F.col("is_special_partner"))


def extra_zone(flows: DataFrame, zone: DataFrame | None = None) -> DataFrame:
    """Flows whose partner is known and is not itself a reporter.

    zone defaults to the reporters present in flows; pass a declared list to fix it.
    """
    return flows.filter(F.col("partnerCode").isNotNull()).join(
        _zone_side(flows, zone), "partnerCode", "left_anti"
    )


def extra_zone_countries(flows: DataFrame, zone: DataFrame | None = None) -> DataFrame:
    """What the analyses run on: real countries outside the zone."""
    return extra_zone(countries(flows), _or_zone_of(flows, zone))


def _or_zone_of(flows: DataFrame, zone: DataFrame | None) -> DataFrame:
    # The zone is read off all flows, before any row of them is filtered out.
    return checked_broadcast(zone_of(flows)) if zone is None else zone


def _outside(partner: str, marker: str) -> Column:
    return F.when(F.col(partner).isNotNull(), F.col(marker).isNull())


def zone_flag(
    flows: DataFrame, zone: DataFrame | None = None, flag: str = "isExtraZone"
) -> DataFrame:
    """Flows with a boolean: is the partner outside the zone. NULL for an unknown partner.

    A left join on the distinct codes; a projected NOT IN would compare every row with
    every code.
    """
    marked = _zone_side(flows, zone).distinct().withColumn("_in_zone", F.lit(True))
    return (
        flows.join(marked, "partnerCode", "left")
        .withColumn(flag, _outside("partnerCode", "_in_zone"))
        .select(*flows.columns, flag)
    )


def hub_ratio(
    flows: DataFrame, zone: DataFrame | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Per reporter: how much of its imports another reporter has sent (transit hubs)."""
    inside = F.sum(F.when(~F.col("isExtraZone"), F.col("netWgt")))
    sums = (
        zone_flag(flows, zone)
        .groupBy(*keys, "reporterCode", "reporterName")
        .agg(
            (F.sum("netWgt") / KG_PER_TONNE).alias("tonnes"),
            (F.coalesce(inside, F.lit(0.0)) / KG_PER_TONNE).alias("intra_zone_tonnes"),
        )
    )
    return sums.withColumn("intra_zone_pct", pct(F.col("intra_zone_tonnes"), F.col("tonnes")))
