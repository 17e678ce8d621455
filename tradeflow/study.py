"""The whole study as a Spark job: landed files -> tables -> results and reporting marts.

    spark-submit -m tradeflow.study build  --landing L --partners P --prices E --store S
    spark-submit -m tradeflow.study check  --landing L --store S --out O
    spark-submit -m tradeflow.study export --store S --out O
    spark-submit -m tradeflow.study compact --store S

build may be run again after files have landed, changed or gone: it ingests those reporter-years alone,
computes the flows of those reporters and corrects the rollup by what they had and have. compact merges
what many builds have left and removes what no longer counts. check writes the completeness report, its exceptions, the
gap list, the reconciliation with World and the zero-fill figures. --layout partitioned and --lines
read large reporters as many envelopes, one a line. --keys cmdCode,flowCode runs the same study for every commodity and
flow direction at once.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tradeflow.operators import (
    completeness,
    dims,
    distance,
    lattice,
    prices,
    quality,
    shares,
    zone,
)
from tradeflow.operators.clean import totals_only
from tradeflow.plans import marts, upkeep
from tradeflow.plans.store import Store
from tradeflow.plans.upkeep import ZONE, flows_schema, rollup_schema
from tradeflow.schemas import DOUBLE, INT, PARTNER_DIM
from tradeflow.session import SETTINGS
from tradeflow.sources import landing, reference, tables
from tradeflow.sources.envelopes import quarantined
from tradeflow.sources.fixed_values import CONSTANT_CODES, PRICE_SERIES, YEARS
from tradeflow.streaming import ingest

START_DATE = f"{prices.START_PERIOD}-01"
PRICES = T.StructType(
    [T.StructField(s, DOUBLE) for s in PRICE_SERIES]
    + [T.StructField(c, INT) for c in ("refYear", "refMonth")]
)


# From this share of the reporters on a build computes all of them.
MOST_REFRESHED = 0.5
# A list of reporters has a few hundred codes; more than this are not listed in the driver.
MOST_CODES = 10_000


def refuse_unreadable(store: Store, envelopes: DataFrame, source: str) -> None:
    """Put what could not be read into the table quarantine, and raise by name, if there is any."""
    found = quarantined(envelopes, source)
    if found.limit(1).collect():
        quality.enforce(store.put("quarantine", found), f"unreadable {source}")


def changed_reporters(
    spark: SparkSession, store: Store, partners: DataFrame, keys: Sequence[str]
) -> list[int] | None:
    """Codes of the reporters whose lines have changed since the flows were built.

    None if all have to be computed: on a first build, with other keys or partners than before, if the
    changes are no longer known, or if a line has no reporter.
    """
    built = store.state()["notes"].get("flows")
    if built is None or built["keys"] != list(keys):
        return None
    before = store.get("partners", partners.schema)
    if partners.exceptAll(before).limit(1).collect() or before.exceptAll(partners).limit(1).collect():
        return None
    changed = ingest.changed_since(spark, store.path("raw-manifest"), built["ingested"])
    if changed is None:
        return None
    lines = ingest.lines_of(spark, store.path("raw"), changed)
    # A short code list, whatever the number of lines.
    codes = [r[0] for r in lines.select("reporterCode").distinct().limit(MOST_CODES + 1).collect()]
    return None if None in codes or len(codes) > MOST_CODES else sorted(codes)


def build_tables(
    spark: SparkSession,
    landing_dir: str,
    partner_file: str,
    price_dir: str,
    store: Store,
    keys: Sequence[str] = (),
    layout: str = "named",
    multi_line: bool = True,
) -> None:
    """Ingest what is new, check it, and bring the tables flows, zone, prices, origin_cells and the rollup
    extra_zone_monthly, which most analyses read in place of the flows, up to date.

    Reporters without changed files keep their rows where they are. All tables switch together at the
    end; if a check or a step fails, readers keep the ones before.
    """
    raw_table, manifest = store.path("raw"), store.path("raw-manifest")
    ingest.ingest_new_files(spark, landing_dir, raw_table, manifest, layout, multi_line)
    ingested = ingest.position(spark, manifest)
    raw = ingest.read_raw(spark, raw_table, manifest)
    constant = {name: codes for name, codes in CONSTANT_CODES.items() if name not in keys}
    refuse_unreadable(store, reference.partner_files(spark, partner_file), "partner list")
    refuse_unreadable(store, reference.price_files(spark, price_dir), "price files")

    reporters = tables.reporters(spark)
    listed = dims.partner_dim(reference.read_partner_areas(spark, partner_file))
    codes = changed_reporters(spark, store, listed, keys)
    with store.change():
        partners = listed if codes is not None else store.put("partners", listed)
        if codes is None or len(codes) > MOST_REFRESHED * reporters.count():
            upkeep.rebuild(store, raw, partners, reporters, keys, constant)
        elif codes:
            upkeep.refresh(store, raw, partners, reporters, codes, keys, constant)
        store.note("flows", {"ingested": ingested, "keys": list(keys)})

        points = reference.read_price_series(spark, price_dir)
        quality.enforce(quality.duplicate_keys(points, ["series", "period"]), "repeated prices")
        tidy = store.put("prices", prices.tidy_prices(points))
        months = dims.date_dim(spark, START_DATE, f"{prices.END_PERIOD}-01")
        quality.enforce(quality.absent_months(tidy, months), "months without prices")
        quality.enforce(quality.missing_prices(tidy, PRICE_SERIES), "missing prices")


def compact(spark: SparkSession, store: Store, keys: Sequence[str] = (), keep: int = 2) -> list[str]:
    """Merge the runs of raw and the pieces of flows, and remove folders that no longer count; their paths.

    For a time when no build or analysis is under way.
    """
    raw_table, manifest = store.path("raw"), store.path("raw-manifest")
    ingest.compact(spark, raw_table, manifest)
    if store.has("flows") and len(store.pieces("flows")) > 1:
        store.put("flows", store.get("flows", flows_schema(keys)), ["refYear"])
    return ingest.vacuum(spark, raw_table, manifest, keep) + store.vacuum(keep)


def missing_files(
    spark: SparkSession, landing_dir: str, years: range, layout: str = "named"
) -> DataFrame:
    """What the next download has to fetch."""
    grid = landing.expected_grid(tables.reporters(spark), years)
    return landing.landing_gaps(grid, landing.landed(spark, landing_dir, layout))


def checks(
    spark: SparkSession,
    landing_dir: str,
    store: Store,
    keys: Sequence[str] = (),
    layout: str = "named",
    multi_line: bool = True,
) -> dict[str, DataFrame]:
    """Reports on what landed and what became of it."""
    grid = landing.expected_grid(tables.reporters(spark), YEARS)
    envelopes = landing.read_envelopes(spark, landing_dir, layout, multi_line)
    report = store.put("completeness", completeness.completeness(envelopes, grid))
    raw = ingest.read_raw(spark, store.path("raw"), store.path("raw-manifest"))
    # Raw is read once, for the partial sums that the reports on declarations share.
    cells = store.put("lattice", lattice.lattice(totals_only(raw, keys), keys), ["refYear"])
    partners, members = store.get("partners", PARTNER_DIM), store.get("zone", ZONE)
    return {
        "completeness": report.orderBy("reporter", "year"),
        "unreadable_files": completeness.unreadable_files(report),
        "empty_files": completeness.empty_files(report),
        "partial_years": completeness.partial_years(report),
        "gap_files": completeness.gap_files(report),
        "code_lists": completeness.code_lists(report),
        "missing_files": missing_files(spark, landing_dir, YEARS, layout),
        "world_reconciliation": lattice.world_recon(cells, keys),
        "world_reconciliation_monthly": lattice.world_recon_monthly(cells, keys),
        "special_share": lattice.special_share(cells, partners, keys),
        "zero_fill": lattice.zero_fill_summary(cells, keys),
        "lanes": lattice.lane_summary(cells, keys),
        "hub_ratio": lattice.hub_ratio(cells, tables.reporters(spark), members, keys),
        "reporters_per_month": lattice.reporters_per_month(cells, keys),
    }


def register_views(spark: SparkSession, store: Store, keys: Sequence[str] = ()) -> None:
    """The stored tables under the names flows, zone, eia_prices, crack_spread and distances,
    for queries written in SQL.
    """
    store.get("flows", flows_schema(keys)).createOrReplaceTempView("flows")
    store.get("zone", ZONE).createOrReplaceTempView("zone")
    tidy = store.get("prices", PRICES)
    tidy.createOrReplaceTempView("eia_prices")
    prices.crack_spread_view(tidy)
    tables.distances(spark).createOrReplaceTempView("distances")


def results(
    spark: SparkSession, store: Store, keys: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Every answer of the study, lazily, over the stored tables.

    The rollup stands in for the extra-zone flows: the operators sum weights, and sums of its
    sums are the same. It has a row per origin and month where the flows have one per reporter.
    """
    flows, members = store.get("flows", flows_schema(keys)), store.get("zone", ZONE)
    extra = store.get("extra_zone_monthly", rollup_schema(keys))
    spread = prices.crack_spread(store.get("prices", PRICES))
    distances = tables.distances(spark)
    declared = zone.countries(flows)
    cut = marts.END_DATE
    price_flow = prices.price_flow(extra, spread, keys)
    levels = prices.lag_correlation(price_flow, keys=keys)
    miles = distance.tonne_miles(extra, distances, keys)
    coverage = shares.coverage(extra, keys)
    own_shares = shares.origin_share(extra, keys)
    return {
        "top_origins_all": shares.top_origins(declared, keys=keys),
        "origin_pivot_all": shares.origin_pivot(declared, keys=keys, end_date=cut),
        "top_origins_extra": shares.top_origins(extra, keys=keys),
        "origin_pivot_extra": shares.origin_pivot(extra, keys=keys, end_date=cut),
        "market_shares": shares.market_share(extra, keys=keys),
        "transition_speed": shares.transition_speed(own_shares, keys=keys),
        "coverage": coverage,
        "coverage_covered": shares.coverage_covered(coverage, distances, keys),
        "confidence_coverage": distance.confidence_coverage(extra, distances, keys),
        "price_flow": price_flow,
        "lag_corr_levels": levels,
        "lag_corr_changes": prices.lag_correlation(price_flow, keys=keys, changes=True),
        "best_lag": prices.best_lag(levels, keys),
        "tonne_miles": miles,
        "before_after": distance.before_after(miles, keys=keys),
        "hub_ratio": zone.hub_ratio(flows, members, keys),
        "reporters_per_month": quality.reporters_per_month(flows, keys),
    }


def reporting_marts(
    spark: SparkSession, store: Store, keys: Sequence[str] = ()
) -> dict[str, DataFrame]:
    found = results(spark, store, keys)
    return marts.star_schema(
        store.get("flows", flows_schema(keys)),
        found["price_flow"],
        found["market_shares"],
        found["tonne_miles"],
        tables.distances(spark),
        dims.date_dim(spark, START_DATE, marts.END_DATE),
        store.get("zone", ZONE),
        keys=keys,
    )


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Trade-flow study on Spark")
    steps = parser.add_subparsers(dest="step", required=True)
    build_step = steps.add_parser("build", help="ingest new files and write the tables")
    for option in ("landing", "partners", "prices", "store"):
        build_step.add_argument(f"--{option}", required=True)
    check_step = steps.add_parser("check", help="write the reports on what landed as CSV")
    for option in ("landing", "store", "out"):
        check_step.add_argument(f"--{option}", required=True)
    for step in (build_step, check_step):
        step.add_argument("--layout", choices=("named", "partitioned"), default="named")
        step.add_argument("--lines", action="store_true", help="one envelope a line")
    export_step = steps.add_parser("export", help="write results and marts as CSV")
    for option in ("store", "out"):
        export_step.add_argument(f"--{option}", required=True)
    compact_step = steps.add_parser("compact", help="merge what builds have left, remove what no longer counts")
    compact_step.add_argument("--store", required=True)
    for step in (build_step, check_step, export_step, compact_step):
        step.add_argument("--keys", type=lambda text: text.split(","), default=[])
    args = parser.parse_args(argv)

    builder = SparkSession.builder.appName("tradeflow")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    store = Store(spark, args.store)
    if args.step == "build":
        build_tables(
            spark, args.landing, args.partners, args.prices, store, args.keys, args.layout, not args.lines
        )
    elif args.step == "compact":
        compact(spark, store, args.keys)
    elif args.step == "check":
        reports = checks(spark, args.landing, store, args.keys, args.layout, not args.lines)
        marts.export(reports, f"{args.out}/checks", args.keys)
    else:
        star = reporting_marts(spark, store, args.keys)
        marts.check_dates(star)
        marts.export(star, f"{args.out}/marts", args.keys)
        marts.export(results(spark, store, args.keys), f"{args.out}/results", args.keys)


if __name__ == "__main__":
    main()
