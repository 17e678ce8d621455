"""Quality reports from one table of partial sums.

lattice() shrinks the total lines to one narrow row per reporter, partner and month, World included: lines,
lines with a weight, lines that weigh nothing, and the weight. It is what every report on what the reporters
declared needs, so a job that writes many of them reads the raw lines once, for the lattice, and the flows not
at all: what zero fill would add is counted from the lattice's months. Each report has the columns and values
of the one over flows or lines that bears its name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import month_start, pct
from tradeflow.operators import densify, quality, zone
from tradeflow.sources.fixed_values import KG_PER_TONNE, WORLD_PARTNER

CELL = ("reporterCode", "partnerCode", "refYear", "refMonth")


def lattice(totals: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Total lines (clean.totals_only) summed per cell; netWgt is NULL where no line has a weight."""
    return totals.groupBy(*keys, *CELL).agg(
        F.count("*").alias("n_lines"),
        F.count("netWgt").alias("n_weights"),
        F.count_if(F.col("netWgt") == 0).alias("n_zero"),
        F.sum("netWgt").alias("netWgt"),
    )


def _detail(cells: DataFrame) -> DataFrame:
    return cells.filter(F.col("partnerCode") != WORLD_PARTNER)


def _reconciled(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    is_world = F.col("partnerCode") == WORLD_PARTNER
    of = lambda side, what: F.coalesce(F.sum(F.when(side, F.col(what))), F.lit(0))
    return cells.groupBy(*keys, "reporterCode", "refYear", "refMonth").agg(
        of(~is_world, "netWgt").cast("double").alias("detail"),
        of(is_world, "netWgt").cast("double").alias("world"),
        of(~is_world, "n_lines").alias("n_detail"),
        of(is_world, "n_lines").alias("n_world"),
    )


def world_recon_monthly(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return quality.recon_monthly_of(_reconciled(cells, keys), keys)


def world_recon(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return quality.recon_of(_reconciled(cells, keys), keys)


def special_share(cells: DataFrame, partners: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sums by partner first: the dimension meets a short list of codes."""
    by_partner = _detail(cells).groupBy(*keys, "partnerCode").agg(F.sum("netWgt").alias("netWgt"))
    named = by_partner.join(partners.select("partnerCode", "is_special_partner"), "partnerCode", "left")
    special = F.coalesce(F.sum(F.when(F.col("is_special_partner"), F.col("netWgt"))), F.lit(0.0))
    sums = named.groupBy(*keys).agg(
        (F.sum("netWgt") / KG_PER_TONNE).alias("total_t"), (special / KG_PER_TONNE).alias("special_t")
    )
    return sums.withColumn("special_pct", pct(F.col("special_t"), F.col("total_t")))


def zero_fill_summary(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    lanes = densify.dense_lanes(_detail(cells), keys, n_rows=F.sum("n_lines"))
    sums = lanes.groupBy(*keys).agg(F.sum("n_rows").alias("n_before"), F.sum("n_silent").alias("n_added"))
    return sums.withColumn("n_after", F.col("n_before") + F.col("n_added"))


def lane_summary(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows and zero rows each lane has once it is filled."""
    lanes = densify.dense_lanes(_detail(cells), keys, n_rows=F.sum("n_lines"), n_zero=F.sum("n_zero"))
    filled = [(F.col(n) + F.col("n_silent")).alias(n) for n in ("n_rows", "n_zero")]
    return lanes.select(*keys, "reporterCode", "partnerCode", *filled)


def hub_ratio(cells: DataFrame, reporters: DataFrame, members: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sums by lane first; then as over flows."""
    lanes = _detail(cells).groupBy(*keys, "reporterCode", "partnerCode").agg(F.sum("netWgt").alias("netWgt"))
    return zone.hub_ratio(lanes.join(reporters, "reporterCode", "left"), members, keys)


def reporters_per_month(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """How many reporters have a line with a partner in each month."""
    months = _detail(cells).groupBy(*keys, "refYear", "refMonth").agg(
        F.count_distinct("reporterCode").alias("n_reporters")
    )
    return months.withColumn("date", month_start())
