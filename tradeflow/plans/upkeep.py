"""Flows, zone and rollup, built whole or brought up to date for some reporters.

The zero fill of a reporter needs all of its own lines and no other's, so the reporter is the unit of
upkeep: refresh() computes the flows of the reporters whose files have changed and writes them beside
the rest, which is not read. The rollup is kept as cells, one per origin and month, with the sum and the number
of rows behind it: what the reporters had before is taken off and what they have now is added. Sums are
decimals, so taking off what was added leaves nothing behind, and a cell without rows is gone.
Cells do not know the zone, which may change with any reporter; it is applied to them at the end.

Checks ride on the write: odd values of constant columns and codes without a name are counted while the
facts pass. Only a count above zero, or an empty result, is looked into by a scan of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.functions import counts_of
from tradeflow.operators import zone
from tradeflow.operators.enrich import check_dimensions
from tradeflow.operators.quality import constant_violations, duplicate_keys, enforce
from tradeflow.plans import build
from tradeflow.plans.store import Store
from tradeflow.schemas import FLOWS, INT, RAW_RECORD

ZONE = T.StructType([T.StructField("reporterCode", INT)])
ORIGIN_MONTH = ("refYear", "refMonth", "partnerName", "netWgt")
WEIGHT = "decimal(38,6)"
UNIT = "reporterCode"


def flows_schema(keys: Sequence[str] = ()) -> T.StructType:
    return T.StructType([*(RAW_RECORD[k] for k in keys), *FLOWS.fields])


def rollup_schema(keys: Sequence[str] = ()) -> T.StructType:
    return T.StructType([*(RAW_RECORD[k] for k in keys), *(FLOWS[c] for c in ORIGIN_MONTH)])


def cells_schema(keys: Sequence[str] = ()) -> T.StructType:
    sums = [T.StructField("weight", T.DecimalType(38, 6)), *(T.StructField(n, T.LongType()) for n in ("n_rows", "n_weights"))]
    place = [FLOWS[c] for c in ("refYear", "refMonth", "partnerCode", "partnerName")]
    return T.StructType([*(RAW_RECORD[k] for k in keys), *place, *sums])


def _place(keys: Sequence[str]) -> list[str]:
    return [*keys, "refYear", "refMonth", "partnerCode", "partnerName"]


def origin_cells(flows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Weight, rows and rows with a weight of each country and month."""
    weight = F.col("netWgt").cast(WEIGHT)
    return zone.countries(flows).groupBy(*_place(keys)).agg(
        F.coalesce(F.sum(weight).cast(WEIGHT), F.lit(0).cast(WEIGHT)).alias("weight"),
        F.count("*").alias("n_rows"),
        F.count("netWgt").alias("n_weights"),
    )


def moved(cells: DataFrame, gone: DataFrame, come: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Cells less those of rows that are gone and plus those of rows that have come."""
    sums = ("weight", "n_rows", "n_weights")
    less = gone.select(*_place(keys), *[(-F.col(c)).cast(gone.schema[c].dataType).alias(c) for c in sums])
    added = cells.unionByName(less).unionByName(come).groupBy(*_place(keys))
    return added.agg(
        F.sum("weight").cast(WEIGHT).alias("weight"), F.sum("n_rows").alias("n_rows"), F.sum("n_weights").alias("n_weights")
    ).filter("n_rows > 0")


def origin_month_of(cells: DataFrame, members: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The rollup of countries outside the zone, as shares.origin_month has it from the flows."""
    outside = zone.extra_zone(cells, members)
    netwgt = F.when(F.sum("n_weights") > 0, F.sum("weight").cast("double"))
    return outside.groupBy(*keys, "refYear", "refMonth", "partnerName").agg(netwgt.alias("netWgt"))


def checked_flows(
    raw: DataFrame,
    partners: DataFrame,
    reporters: DataFrame,
    keys: Sequence[str] = (),
    constant: Mapping[str, Sequence[str]] | None = None,
    all_seen: bool = True,
) -> tuple[DataFrame, Callable[[], None]]:
    """Flows, and a check to call once they are written, which raises DataQualityError.

    The check is for values of constant columns outside their list, values of the list that no line has
    (with all_seen), and codes without a name.
    """
    constant = dict(constant or {})
    lines, named = Observation(), Observation()
    odd = [F.count_if(F.coalesce(~F.col(c).isin(list(v)), F.lit(True))).alias(f"odd_{c}") for c, v in constant.items()]
    absent = [
        F.count_if(F.col(c) == value).alias(f"has_{c}_{i}") for c, v in constant.items() for i, value in enumerate(v)
    ]
    marked = [dim.withColumn(f"_{key}", F.lit(True)) for dim, key in ((partners, "partner"), (reporters, "reporter"))]
    enforce(duplicate_keys(partners, ["partnerCode"]), "duplicate partner codes")
    enforce(duplicate_keys(reporters, ["reporterCode"]), "duplicate reporter codes")
    facts = raw.observe(lines, F.count("*").alias("n"), *odd, *absent)
    dense = build.coded(raw, keys, facts)
    flows = build.enrich(dense, *marked)
    flows = flows.observe(named, F.count_if(F.col("_partner").isNull() | F.col("_reporter").isNull()).alias("n_unnamed"))

    def check() -> None:
        of_lines, of_names = counts_of(lines), counts_of(named)
        if constant:
            told = of_lines is not None and of_lines["n"] > 0
            bad = told and any(n > 0 for c, n in of_lines.items() if c.startswith("odd_"))
            bad |= told and all_seen and any(n == 0 for c, n in of_lines.items() if c.startswith("has_"))
            if bad or not told:
                violations = constant_violations(raw, constant)
                enforce(violations if all_seen else violations.filter("n_rows > 0"), "constant columns")
        if of_names is None or of_names["n_unnamed"]:
            check_dimensions(build.detail(raw, keys), partners, reporters)

    return flows.select(*keys, *FLOWS.fieldNames()), check


def rebuild(
    store: Store,
    raw: DataFrame,
    partners: DataFrame,
    reporters: DataFrame,
    keys: Sequence[str] = (),
    constant: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Write flows, zone, origin_cells and extra_zone_monthly from all lines; they switch together."""
    with store.change():
        computed, check = checked_flows(raw, partners, reporters, keys, constant)
        flows = store.put("flows", computed, ["refYear"])
        check()
        members = store.put("zone", zone.zone_of(flows))
        cells = store.put("origin_cells", origin_cells(flows, keys), ["refYear"])
        store.put("extra_zone_monthly", origin_month_of(cells, members, keys), ["refYear"])


def refresh(
    store: Store,
    raw: DataFrame,
    partners: DataFrame,
    reporters: DataFrame,
    codes: Sequence[int],
    keys: Sequence[str] = (),
    constant: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Bring the four tables up to date after lines of the reporters with these codes have changed."""
    mine = F.col(UNIT).isin(list(codes))
    before = store.get("flows", flows_schema(keys)).filter(mine)
    with store.change():
        computed, check = checked_flows(raw.filter(mine), partners, reporters, keys, constant, all_seen=False)
        now = store.replace_units("flows", computed, UNIT, codes, ["refYear"])
        check()
        others = store.get("zone", ZONE).filter(~mine)
        members = store.put("zone", others.unionByName(zone.zone_of(now)))
        cells = moved(store.get("origin_cells", cells_schema(keys)), origin_cells(before, keys), origin_cells(now, keys), keys)
        cells = store.put("origin_cells", cells, ["refYear"])
        store.put("extra_zone_monthly", origin_month_of(cells, members, keys), ["refYear"])
