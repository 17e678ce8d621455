"""Registered queries: one per operator, over the adapter's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.operators import (
    clean,
    completeness,
    densify,
    dims,
    distance,
    enrich,
    lattice,
    prices,
    quality,
    shares,
    zone,
)
from tradeflow.plans import build, marts, upkeep
from tradeflow.schemas import FLOWS
from tradeflow.sources import landing
from tradeflow.streaming import ingest
from workload.adapter import (
    COMMODITY,
    CUTOVER,
    END_DATE,
    LAST_FIRST_BATCH_YEAR,
    LATE_REPORTER,
    PRICED_PERIOD,
    YEARS,
    Fixture,
    fixture,
)

REPORTER, PARTNER = 4, 10
LANE = ("refYear", "refMonth", "reporterCode", "partnerCode", "netWgt")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six decimals and dates as ISO text, so that two engines can be compared."""

    def column(field: T.StructField):
        if isinstance(field.dataType, T.DoubleType):
            return F.round(field.name, 6).alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def query(build_df: Callable[[Fixture], DataFrame]) -> Callable[[Fixture], DataFrame]:
    """Register a function of the fixture under its own name, less the underscore that keeps
    it apart from an imported module.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build_df(fixture(spark, sf_dir)))

    QUERIES[build_df.__name__.rstrip("_")] = run
    return build_df


# -- landing and raw lines -------------------------------------------------------------


def _envelopes(fx: Fixture) -> DataFrame:
    return fx.landed_envelopes


def _grid(fx: Fixture) -> DataFrame:
    return landing.expected_grid(fx.reporters, YEARS)


def _report(fx: Fixture) -> DataFrame:
    return completeness.completeness(_envelopes(fx), _grid(fx))


@query
def raw_lines(fx: Fixture) -> DataFrame:
    return fx.raw


@query
def stack_raw(fx: Fixture) -> DataFrame:
    return landing.stack_raw(fx.whole_envelopes)


@query
def landing_gaps(fx: Fixture) -> DataFrame:
    present = landing.landed(fx.spark, fx.landing, "partitioned")
    return landing.landing_gaps(_grid(fx), present)


@query
def ingest_incremental(fx: Fixture) -> DataFrame:
    """Files land in two steps, with a run after each and one more with nothing new."""
    run = fx.store.path(f"incremental-{uuid.uuid4().hex}")
    folder, manifest, table = (f"{run}/{part}" for part in ("landing", "manifest", "raw"))
    first = F.col("year") <= LAST_FIRST_BATCH_YEAR
    for part in (first, ~first, None):
        if part is not None:
            files = fx.envelopes(whole=True).filter(part)
            files.write.mode("append").partitionBy("iso3", "year").json(folder)
        ingest.ingest_new_files(fx.spark, folder, table, manifest, "partitioned", False)
    return ingest.read_raw(fx.spark, table, manifest)


@query
def ingest_relanded(fx: Fixture) -> DataFrame:
    """All reporter-years land without their lines of later months, and then once more in full."""
    run = fx.store.path(f"relanded-{uuid.uuid4().hex}")
    folder, manifest, table = (f"{run}/{part}" for part in ("landing", "manifest", "raw"))
    whole = fx.envelopes(whole=True)
    early = F.filter("data", lambda line: line["refMonth"] <= 6)
    for files in (whole.withColumn("data", early), whole):
        files.write.mode("overwrite").partitionBy("iso3", "year").json(folder)
        ingest.ingest_new_files(fx.spark, folder, table, manifest, "partitioned", False)
    return ingest.read_raw(fx.spark, table, manifest)


@query
def ingest_compacted(fx: Fixture) -> DataFrame:
    """All files land, year after year; one reporter's are then deleted, and the runs are merged."""
    run = fx.store.path(f"compacted-{uuid.uuid4().hex}")
    folder, manifest, table = (f"{run}/{part}" for part in ("landing", "manifest", "raw"))
    whole = fx.envelopes(whole=True)
    first = F.col("year") <= LAST_FIRST_BATCH_YEAR
    stays = F.col("iso3") != F.format_string("N%02d", F.lit(LATE_REPORTER))
    for part in (first, F.lit(True), stays):
        whole.filter(part).write.mode("overwrite").partitionBy("iso3", "year").json(folder)
        ingest.ingest_new_files(fx.spark, folder, table, manifest, "partitioned", False)
    ingest.compact(fx.spark, table, manifest)
    ingest.vacuum(fx.spark, table, manifest, keep=1)
    return ingest.read_raw(fx.spark, table, manifest)


@query
def completeness_(fx: Fixture) -> DataFrame:
    return _report(fx)


@query
def completeness_empty(fx: Fixture) -> DataFrame:
    return completeness.empty_files(_report(fx))


@query
def completeness_partial(fx: Fixture) -> DataFrame:
    return completeness.partial_years(_report(fx))


@query
def completeness_gap(fx: Fixture) -> DataFrame:
    return completeness.gap_files(_report(fx))


@query
def completeness_codes(fx: Fixture) -> DataFrame:
    return completeness.code_lists(_report(fx))


@query
def completeness_files(fx: Fixture) -> DataFrame:
    return completeness.file_counts(_report(fx))


@query
def dq_constants(fx: Fixture) -> DataFrame:
    expected = {"flowCode": ["M"], "cmdCode": ["X"], "customsCode": ["C00", "C09"]}
    return quality.constant_violations(fx.raw, expected)


@query
def totals_only(fx: Fixture) -> DataFrame:
    return clean.totals_only(fx.raw)


@query
def totals_summary(fx: Fixture) -> DataFrame:
    return clean.totals_summary(fx.raw)


@query
def split_detail(fx: Fixture) -> DataFrame:
    return clean.split_detail(clean.totals_only(fx.raw))


@query
def split_world(fx: Fixture) -> DataFrame:
    return clean.split_world(clean.totals_only(fx.raw))


@query
def world_recon(fx: Fixture) -> DataFrame:
    return quality.world_recon(clean.totals_only(fx.raw))


@query
def world_recon_monthly(fx: Fixture) -> DataFrame:
    return quality.world_recon_monthly(clean.totals_only(fx.raw))


@query
def world_recon_flawed(fx: Fixture) -> DataFrame:
    """Over declarations in which partners and World disagree and weights are missing."""
    return quality.world_recon(clean.totals_only(fx.raw_flawed))


@query
def world_recon_monthly_flawed(fx: Fixture) -> DataFrame:
    return quality.world_recon_monthly(clean.totals_only(fx.raw_flawed))


# -- dimensions, enrichment, zero fill --------------------------------------------------


@query
def partner_dim(fx: Fixture) -> DataFrame:
    return fx.partners


@query
def distances_dim(fx: Fixture) -> DataFrame:
    return fx.distances


@query
def date_dim(fx: Fixture) -> DataFrame:
    return dims.date_dim_of(fx.flows)


@query
def enrich_(fx: Fixture) -> DataFrame:
    return fx.named


@query
def enrich_unmatched(fx: Fixture) -> DataFrame:
    """Against the distance-covered nations only, so that some codes have no match."""
    covered = fx.partners.join(fx.distances, "partnerName", "left_semi")
    return quality.unmatched_codes(clean.split_detail(clean.totals_only(fx.raw)), covered, "partnerCode")


@query
def duplicate_keys(fx: Fixture) -> DataFrame:
    return quality.duplicate_keys(fx.raw, ["reporterCode", "partnerCode", "refYear"])


@query
def special_share(fx: Fixture) -> DataFrame:
    return enrich.special_share(fx.named)


@query
def zero_fill(fx: Fixture) -> DataFrame:
    return densify.zero_fill(fx.named).select(*FLOWS.fieldNames())


@query
def flows(fx: Fixture) -> DataFrame:
    """The whole build from raw lines, as the stored fact table holds it."""
    return build.flows(fx.raw, fx.partners, fx.reporters)


@query
def zero_fill_summary(fx: Fixture) -> DataFrame:
    return densify.zero_fill_summary(fx.named)


@query
def zero_fill_flawed(fx: Fixture) -> DataFrame:
    """A line without a weight stays, and its cell is filled beside it."""
    return densify.zero_fill(fx.named_flawed).select(*FLOWS.fieldNames())


@query
def zero_fill_summary_flawed(fx: Fixture) -> DataFrame:
    return densify.zero_fill_summary(fx.named_flawed)


@query
def market_share_flawed(fx: Fixture) -> DataFrame:
    return shares.market_share(fx.extra_flawed)


@query
def flows_refreshed(fx: Fixture) -> DataFrame:
    """Flows in two pieces: all reporters, and the one whose files came later."""
    return fx.refreshed.get("flows", FLOWS)


@query
def rollup_refreshed(fx: Fixture) -> DataFrame:
    """The rollup from which the reporter's old sums were taken and to which its new ones were added."""
    return fx.refreshed.get("extra_zone_monthly", upkeep.rollup_schema())


@query
def lane_series(fx: Fixture) -> DataFrame:
    return densify.lane_series(fx.flows, REPORTER, PARTNER).select(*LANE)


@query
def lane_summary(fx: Fixture) -> DataFrame:
    return densify.lane_summary(fx.flows)


@query
def reporters_per_month(fx: Fixture) -> DataFrame:
    return quality.reporters_per_month(fx.flows)


# -- quality reports from the shared partial sums ---------------------------------------


@query
def lattice_world_recon(fx: Fixture) -> DataFrame:
    return lattice.world_recon(fx.lattice)


@query
def lattice_world_recon_monthly(fx: Fixture) -> DataFrame:
    return lattice.world_recon_monthly(fx.lattice)


@query
def lattice_special_share(fx: Fixture) -> DataFrame:
    return lattice.special_share(fx.lattice, fx.partners)


@query
def lattice_zero_fill_summary(fx: Fixture) -> DataFrame:
    return lattice.zero_fill_summary(fx.lattice)


@query
def lattice_lane_summary(fx: Fixture) -> DataFrame:
    return lattice.lane_summary(fx.lattice)


@query
def lattice_hub_ratio(fx: Fixture) -> DataFrame:
    return lattice.hub_ratio(fx.lattice, fx.reporters, fx.zone)


@query
def lattice_reporters_per_month(fx: Fixture) -> DataFrame:
    return lattice.reporters_per_month(fx.lattice)


# -- zone ------------------------------------------------------------------------------


@query
def extra_zone(fx: Fixture) -> DataFrame:
    return zone.extra_zone(fx.flows, fx.zone).select(*fx.flows.columns)


@query
def extra_zone_derived(fx: Fixture) -> DataFrame:
    """The zone read off the flows in the same query."""
    return zone.extra_zone_countries(fx.flows).select(*fx.flows.columns)


@query
def zone_flag(fx: Fixture) -> DataFrame:
    return zone.zone_flag(fx.flows, fx.zone).select(*LANE, "isExtraZone")


@query
def hub_ratio(fx: Fixture) -> DataFrame:
    return zone.hub_ratio(fx.flows, fx.zone)


# -- origins and shares ----------------------------------------------------------------


@query
def top_origins_all(fx: Fixture) -> DataFrame:
    return shares.top_origins(zone.countries(fx.flows))


@query
def top_origins_extra(fx: Fixture) -> DataFrame:
    return shares.top_origins(fx.extra)


@query
def origin_monthly_all(fx: Fixture) -> DataFrame:
    return shares.origin_monthly(zone.countries(fx.flows))


@query
def origin_monthly_extra(fx: Fixture) -> DataFrame:
    return shares.origin_monthly(fx.extra)


@query
def extra_zone_monthly(fx: Fixture) -> DataFrame:
    return shares.origin_month(fx.extra)


@query
def origin_pivot(fx: Fixture) -> DataFrame:
    return shares.origin_pivot(fx.extra, end_date=END_DATE)


@query
def market_share(fx: Fixture) -> DataFrame:
    return shares.market_share(fx.extra)


@query
def origin_share(fx: Fixture) -> DataFrame:
    return shares.origin_share(fx.extra)


@query
def transition_speed(fx: Fixture) -> DataFrame:
    return shares.transition_speed(shares.origin_share(fx.extra), CUTOVER)


@query
def share_window(fx: Fixture) -> DataFrame:
    return shares.share_window(
        shares.origin_share(fx.extra), "NATION_9", "1997-08-01", "1998-08-01"
    )


@query
def coverage(fx: Fixture) -> DataFrame:
    return shares.coverage(fx.extra)


@query
def coverage_ranges(fx: Fixture) -> DataFrame:
    """The running coverage summed in ranges, for origins too many for one task."""
    return shares.coverage_ranges(fx.extra)


@query
def coverage_covered(fx: Fixture) -> DataFrame:
    return shares.coverage_covered(shares.coverage(fx.extra), fx.distances)


# -- prices ----------------------------------------------------------------------------


@query
def prices_tidy(fx: Fixture) -> DataFrame:
    start, end = PRICED_PERIOD
    return prices.tidy_prices(fx.price_points, start=start, end=end)


@query
def prices_missing(fx: Fixture) -> DataFrame:
    return quality.missing_prices(fx.prices, prices.PRICE_SERIES)


@query
def crack_spread(fx: Fixture) -> DataFrame:
    return fx.spread


@query
def crack_spread_window(fx: Fixture) -> DataFrame:
    return prices.crack_spread_window(fx.spread, "1997-06-01", "1998-12-01")


def _price_flow(fx: Fixture) -> DataFrame:
    return prices.price_flow(fx.extra, fx.spread)


@query
def price_flow(fx: Fixture) -> DataFrame:
    return _price_flow(fx)


@query
def lag_corr_levels(fx: Fixture) -> DataFrame:
    return prices.lag_correlation(_price_flow(fx))


@query
def lag_corr_changes(fx: Fixture) -> DataFrame:
    return prices.lag_correlation(_price_flow(fx), changes=True)


@query
def lag_corr_calendar(fx: Fixture) -> DataFrame:
    """By calendar month, over all months."""
    return prices.lag_correlation(_price_flow(fx), calendar=True)


@query
def best_lag(fx: Fixture) -> DataFrame:
    return prices.best_lag(prices.lag_correlation(_price_flow(fx)))


# -- distance --------------------------------------------------------------------------


@query
def tonne_miles(fx: Fixture) -> DataFrame:
    return distance.tonne_miles(fx.extra, fx.distances)


@query
def before_after(fx: Fixture) -> DataFrame:
    return distance.before_after(distance.tonne_miles(fx.extra, fx.distances), CUTOVER)


@query
def before_after_cut(fx: Fixture) -> DataFrame:
    monthly = distance.tonne_miles(fx.extra, fx.distances, end_date=END_DATE)
    return distance.before_after(monthly, CUTOVER)


@query
def confidence_coverage(fx: Fixture) -> DataFrame:
    return distance.confidence_coverage(fx.extra, fx.distances)


# -- marts -----------------------------------------------------------------------------


@query
def mart_flows(fx: Fixture) -> DataFrame:
    return marts.flows_mart(fx.flows, fx.zone, END_DATE)


@query
def mart_price_flow(fx: Fixture) -> DataFrame:
    return marts.price_flow_mart(_price_flow(fx))


@query
def mart_market_shares(fx: Fixture) -> DataFrame:
    return marts.market_shares_mart(shares.market_share(fx.extra), END_DATE)


@query
def mart_tonne_miles(fx: Fixture) -> DataFrame:
    return marts.tonne_miles_mart(distance.tonne_miles(fx.extra, fx.distances), END_DATE)


@query
def mart_orphan_dates(fx: Fixture) -> DataFrame:
    """Dates of the uncut flows mart that a date dimension ending at the priced period lacks."""
    uncut = marts.flows_mart(fx.flows, fx.zone, None)
    priced = prices.crack_spread_window(fx.spread, "1995-01-01", END_DATE)
    return quality.orphan_dates(uncut, dims.date_dim_of(priced))


# -- the same operators over many commodities ------------------------------------------


@query
def zero_fill_by_commodity(fx: Fixture) -> DataFrame:
    dense = densify.zero_fill(fx.named_by_type, COMMODITY)
    return dense.select(*COMMODITY, *FLOWS.fieldNames())


@query
def world_recon_by_commodity(fx: Fixture) -> DataFrame:
    return quality.world_recon(clean.totals_only(fx.raw_by_type, COMMODITY), COMMODITY)


@query
def top_origins_by_commodity(fx: Fixture) -> DataFrame:
    return shares.top_origins(fx.extra_by_type, keys=COMMODITY)


@query
def market_share_by_commodity(fx: Fixture) -> DataFrame:
    return shares.market_share(fx.extra_by_type, keys=COMMODITY)


@query
def coverage_by_commodity(fx: Fixture) -> DataFrame:
    return shares.coverage(fx.extra_by_type, keys=COMMODITY)


@query
def lag_corr_by_commodity(fx: Fixture) -> DataFrame:
    monthly = prices.price_flow(fx.extra_by_type, fx.spread, COMMODITY)
    return prices.lag_correlation(monthly, keys=COMMODITY)


@query
def tonne_miles_by_commodity(fx: Fixture) -> DataFrame:
    return distance.tonne_miles(fx.extra_by_type, fx.distances, COMMODITY)


# -- the study's own path --------------------------------------------------------------


class StoredRollup:
    """The fixture as the study's results see it: the stored rollup stands in for the flows."""

    def __init__(self, fx: Fixture):
        self._fx = fx

    def __getattr__(self, name: str):
        return getattr(self._fx, "extra_monthly" if name == "extra" else name)


# Name of the registered query, and the analysis over flows that has the same answer.
STUDY = {
    f"study_{f.__name__}": f
    for f in (
        top_origins_extra, market_share, transition_speed, coverage, coverage_covered, price_flow,
        tonne_miles, before_after, confidence_coverage,
    )
}


def _over_rollup(build_df: Callable[[Fixture], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: comparable(build_df(StoredRollup(fixture(spark, sf_dir))))


QUERIES.update({name: _over_rollup(f) for name, f in STUDY.items()})
