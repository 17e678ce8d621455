"""Zero-fill: make silent cells explicit, without inventing data for unpublished months.

A lane is one (reporter, partner). A reporter's lane has a zero in every month the reporter
published something and the lane has no weight. A lane's year is one number: a bit for each month it
has a row in and, 32 places up, one for each month it has a weight in. Facts shrink to these numbers
by bit_or, a state of fixed width that combines on the map side. The months a reporter published are
the bit_or of its lanes' numbers, not another pass over the facts; what is silent is one `and not` a
year, and only its bits are expanded. The reporter x month x partner grid is never built and the facts
are not joined with it; the shuffles carry lane-years, not cells. A lane's years, and a reporter's, are
listed side by side: as many as the calendar has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTNER_ATTRIBUTES = ("reporterName", "partnerName", "iso2", "iso3", "is_special_partner")

# Bits of a lane's year: months 1 to 12 with a row from bit 0 on, with a weight from this one on.
WEIGHED = 32
MONTHS = 0xFFF


def _bits(null_is_present: bool) -> Column:
    """The bits a row sets; NULL, which sets none, for a row outside the calendar."""
    place = F.col("refMonth") - 1
    seen = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    weighed = F.call_function("shiftleft", F.lit(1).cast("long"), place + WEIGHED)
    if not null_is_present:
        weighed = F.when(F.col("netWgt").isNotNull(), weighed).otherwise(F.lit(0).cast("long"))
    dated = F.col("refYear").isNotNull() & F.col("refMonth").between(1, 12)
    return F.when(dated, seen.bitwiseOR(weighed))


def _lane_years(flows: DataFrame, by: Sequence[str], null_is_present: bool, *more: Column) -> DataFrame:
    return flows.groupBy(*by, "partnerCode", "refYear").agg(F.bit_or(_bits(null_is_present)).alias("bits"), *more)


def _published(lane_years: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per reporter the list of its years, each with the months it published."""
    months = F.bit_or("bits").bitwiseAND(F.lit(MONTHS).cast("long"))
    years = lane_years.filter("bits IS NOT NULL").groupBy(*by, "refYear").agg(months.alias("months"))
    return years.groupBy(*by).agg(F.collect_list(F.struct("refYear", "months")).alias("published"))


def _silent(year: Column) -> Column:
    """Months of a published year that the lane has no weight in, as bits."""
    has = F.shiftrightunsigned(F.coalesce(F.try_element_at("own_years", year["refYear"]), F.lit(0).cast("long")), WEIGHED)
    return year["months"].bitwiseAND(F.bitwise_not(has))


def _lanes(
    flows: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    null_is_present: bool,
    counts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per lane: its attributes, own_years (its bits by year) and its reporter's published years,
    and the counts asked for, each a sum over rows.
    """
    by = [*keys, "reporterCode"]
    more = [count.alias(name) for name, count in (counts or {}).items()]
    gathered = [F.sum(name).alias(name) for name in counts or {}]
    if attributes:
        # All attributes of one row: a partner spelt in two ways keeps name and code together.
        more.append(F.max(F.struct(*attributes)).alias("own"))
        gathered.append(F.max("own").alias("own"))
    years = _lane_years(flows, by, null_is_present, *more)
    dated = F.when(F.col("bits").isNotNull(), F.struct("refYear", "bits"))
    lanes = years.groupBy(*by, "partnerCode").agg(
        F.map_from_entries(F.collect_list(dated)).alias("own_years"), *gathered
    )
    if attributes:
        lanes = lanes.select("*", "own.*").drop("own")
    # A null-safe join states no filter on its sides: both then begin with the same shuffled lane-years,
    # and Spark reads the facts for them once. Rows without a reporter, or a key, get no zeros.
    published = _published(_lane_years(flows, by, null_is_present), by)
    published = published.select(*[F.col(c).alias(f"_{c}") for c in by], "published")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in by])
    joined = lanes.join(published, reduce(Column.__and__, same), "left")
    return joined.withColumn("published", F.when(known, F.col("published"))).drop(*[f"_{c}" for c in by])


def zero_rows(
    flows: DataFrame,
    keys: Sequence[str] = (),
    attributes: Sequence[str] = PARTNER_ATTRIBUTES,
    null_is_present: bool = False,
) -> DataFrame:
    """The rows zero_fill adds.

    A row without a weight does not count as present unless null_is_present.
    """
    def cells(year: Column) -> Column:
        silent = _silent(year)
        bit = lambda m: F.call_function("shiftright", silent, m - 1).bitwiseAND(F.lit(1).cast("long")) == 1
        months = F.filter(F.sequence(F.lit(1), F.lit(12)), bit)
        return F.transform(months, lambda m: F.struct(year["refYear"].alias("refYear"), m.alias("refMonth")))

    listed = F.flatten(F.transform("published", cells))
    lanes = _lanes(flows, keys, attributes, null_is_present).withColumn("cell", F.explode(listed))
    return lanes.select(
        *keys, "cell.refYear", "cell.refMonth", "reporterCode", "partnerCode", *attributes, F.lit(0.0).alias("netWgt")
    )


def zero_fill(
    flows: DataFrame,
    keys: Sequence[str] = (),
    attributes: Sequence[str] = PARTNER_ATTRIBUTES,
    null_is_present: bool = False,
) -> DataFrame:
    """Flows plus a zero row per silent cell; columns other than attributes are NULL there.

    Pass attributes=() for flows that carry codes only and get their names afterwards.
    """
    added = zero_rows(flows, keys, attributes, null_is_present)
    return flows.unionByName(added, allowMissingColumns=True)


def _n_silent() -> Column:
    """Silent months of a lane, from its own and its reporter's years."""
    add = lambda total, year: total + F.bit_count(_silent(year))
    return F.aggregate(F.coalesce("published", F.array()), F.lit(0), add).cast("long")


def dense_lanes(flows: DataFrame, keys: Sequence[str] = (), **counts: Column) -> DataFrame:
    """Per lane the months that zero fill adds (n_silent), and sums over the rows it has."""
    lanes = _lanes(flows, keys, (), False, counts)
    return lanes.select(*keys, "reporterCode", "partnerCode", *counts, _n_silent().alias("n_silent"))


def zero_fill_summary(flows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows before, added and after, counted per lane without expanding the added rows."""
    sums = (
        dense_lanes(flows, keys, n_rows=F.count("*"))
        .groupBy(*keys)
        .agg(F.sum("n_rows").alias("n_before"), F.sum("n_silent").alias("n_added"))
    )
    return sums.withColumn("n_after", F.col("n_before") + F.col("n_added"))


def lane_series(flows: DataFrame, reporter: int, partner: int) -> DataFrame:
    """One lane in time order."""
    lane = (F.col("reporterCode") == reporter) & (F.col("partnerCode") == partner)
    return flows.filter(lane).orderBy("refYear", "refMonth")


def lane_summary(flows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows and zero rows per lane: a continuous lane has as many rows as published months."""
    return flows.groupBy(*keys, "reporterCode", "partnerCode").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("netWgt") == 0).alias("n_zero")
    )
