"""Maps the driver's order tables onto the trade-flow data model.

A reporter is a European customer nation, a partner is a supplier nation, a flow is what was
shipped between them in a month. Nothing is generated: every row derives from the tables.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.operators import clean, dims, lattice, prices, shares, zone
from tradeflow.plans import build, upkeep
from tradeflow.plans.store import Store
from tradeflow.schemas import RAW_RECORD
from tradeflow.sources import landing
from tradeflow.sources.fixed_values import CRUDE, PRODUCT
from tradeflow.sources.tables import read_parquet

EUROPE = 3
PLACEHOLDERS = (22, 25)
YEARS = range(1995, 2002)
FULL_PERIOD = ("1995-01", "2001-12")
PRICED_PERIOD = ("1995-01", "2001-08")
CUTOVER = "1998-02-01"
END_DATE = "2000-12-01"
COMMODITY = ("cmdCode",)
LAST_FIRST_BATCH_YEAR = 1998
LATE_REPORTER = 7

LINE = ("refYear", "refMonth", "reporterCode", "partnerCode", "l_returnflag", "l_linestatus")


def _code(column: str):
    # 0 stands for World, so codes start at 1.
    return (F.col(column) + 1).cast("int")


def _iso3(code: str):
    return F.concat(F.lit("N"), F.lpad(F.col(code).cast("string"), 2, "0"))


def _partner_name():
    is_catch_all = F.expr("right(n_name, 2) = '_2'")
    return F.when(is_catch_all, F.concat("n_name", F.lit(", NES"))).otherwise(F.col("n_name"))


class Fixture:
    """Trade-flow tables of one data directory; a table several queries read is written once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.store = Store(spark)
        self._tables: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def table(self, name: str) -> DataFrame:
        """One of the driver's tables."""
        return self._once(
            name, lambda: read_parquet(self.spark, f"{self.sf_dir}/{name}.parquet")
        )

    def stored(
        self, name: str, build_df: Callable[[], DataFrame], partition_by: Sequence[str] = ()
    ) -> DataFrame:
        return self._once(
            f"stored {name}", lambda: self.store.put(name, build_df(), partition_by)
        )

    def _once(self, key: str, make: Callable[[], DataFrame]) -> DataFrame:
        with self._lock:
            if key not in self._tables:
                self._tables[key] = make()
            return self._tables[key]

    # -- raw lines ---------------------------------------------------------------------

    def shipments(self, by_type: bool) -> DataFrame:
        """Shipped quantity and value per line group: the finest grain a raw line may have.

        Orders are cut to European customers before they meet the line items, and everything
        later works on this aggregate. Join strategies are Spark's, by the sizes it finds.
        """
        europe = self.table("nation").filter(F.col("n_regionkey") == EUROPE)
        buyers = self.table("customer").join(
            europe, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"
        )
        orders = self.table("orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        lines = (
            self.table("lineitem")
            .join(
                orders.select("o_orderkey", _code("c_nationkey").alias("reporterCode")),
                F.col("l_orderkey") == F.col("o_orderkey"),
            )
            .join(
                self.table("supplier").select("s_suppkey", _code("s_nationkey").alias("partnerCode")),
                F.col("l_suppkey") == F.col("s_suppkey"),
            )
        )
        if by_type:
            lines = lines.join(
                self.table("part").select("p_partkey", "p_type"),
                F.col("l_partkey") == F.col("p_partkey"),
            )
        commodity = F.col("p_type") if by_type else F.lit("X")
        return (
            lines.withColumn("refYear", F.year("l_shipdate"))
            .withColumn("refMonth", F.month("l_shipdate"))
            .withColumn("cmdCode", commodity)
            .groupBy("cmdCode", *LINE)
            .agg(F.sum("l_quantity").alias("qty"), F.sum("l_extendedprice").alias("val"))
        )

    def raw_lines(self, by_type: bool = False) -> DataFrame:
        """Raw lines with World totals and two breakdowns, as reporters publish them."""
        month = ["cmdCode", "refYear", "refMonth", "reporterCode"]
        partner = [*month, "partnerCode"]
        sets = [month, partner, [*partner, "l_returnflag"], [*partner, "l_linestatus"]]
        lines = (
            self.shipments(by_type)
            .groupingSets(sets, "cmdCode", *LINE)
            .agg(
                F.sum("qty").alias("qty"),
                F.sum("val").alias("val"),
                F.grouping("partnerCode").alias("all_partners"),
                F.grouping("l_returnflag").alias("all_flags"),
                F.grouping("l_linestatus").alias("all_statuses"),
            )
        )
        is_world = F.col("all_partners") == 1
        unweighed = is_world & ((F.col("reporterCode") + F.col("refMonth")) % 7 == 0)
        columns = {
            "partnerCode": F.when(is_world, 0).otherwise(F.col("partnerCode")),
            "partner2Code": F.lit(0),
            "netWgt": F.when(unweighed, 0.0).otherwise(F.col("qty")),
            "primaryValue": F.round("val", 2),
            "isNetWgtEstimated": F.col("qty").cast("int") % 5 == 0,
            "motCode": F.when(F.col("all_flags") == 1, 0).otherwise(F.ascii("l_returnflag")),
            "customsCode": F.when(F.col("all_statuses") == 1, "C00").otherwise(
                F.concat(F.lit("C0"), F.col("l_linestatus"))
            ),
            "flowCode": F.lit("M"),
        }
        return lines.select(
            *[columns.get(c, F.col(c)).alias(c) for c in RAW_RECORD.fieldNames()]
        )

    @property
    def raw(self) -> DataFrame:
        return self.stored("raw", self.raw_lines, ["refYear"])

    @property
    def raw_by_type(self) -> DataFrame:
        return self.stored("raw_by_type", lambda: self.raw_lines(by_type=True), ["refYear"])

    # -- dimensions --------------------------------------------------------------------

    @property
    def partners(self) -> DataFrame:
        areas = self.table("nation").select(
            _code("n_nationkey").alias("PartnerCode"), _partner_name().alias("PartnerDesc")
        )
        return dims.partner_dim(
            areas.withColumn(
                "PartnerCodeIsoAlpha2", F.lpad(F.col("PartnerCode").cast("string"), 2, "0")
            ).withColumn("PartnerCodeIsoAlpha3", _iso3("PartnerCode")),
            PLACEHOLDERS,
        )

    @property
    def reporters(self) -> DataFrame:
        europe = self.table("nation").filter(F.col("n_regionkey") == EUROPE)
        return europe.select(_code("n_nationkey").alias("reporterCode")).withColumn(
            "reporterName", _iso3("reporterCode")
        )

    @property
    def distances(self) -> DataFrame:
        nation = F.col("n_nationkey")
        confidence = (
            F.when(nation % 3 == 0, "verified")
            .when(nation % 3 == 1, "verified_proxy_port")
            .otherwise("estimated")
        )
        return self.table("nation").filter(nation <= 17).select(
            _partner_name().alias("partnerName"),
            F.concat(F.lit("PORT_"), nation.cast("string")).alias("port"),
            (nation * 137 + 1000).cast("int").alias("nm_to_rotterdam"),
            confidence.alias("confidence"),
        )

    # -- flows -------------------------------------------------------------------------

    @property
    def named(self) -> DataFrame:
        return build.named_detail(self.raw, self.partners, self.reporters)

    @property
    def named_by_type(self) -> DataFrame:
        return build.named_detail(self.raw_by_type, self.partners, self.reporters, COMMODITY)

    @property
    def flows(self) -> DataFrame:
        return self.stored(
            "flows", lambda: build.flows(self.raw, self.partners, self.reporters), ["refYear"]
        )

    @property
    def flows_by_type(self) -> DataFrame:
        return self.stored(
            "flows_by_type",
            lambda: build.flows(self.raw_by_type, self.partners, self.reporters, COMMODITY),
            ["refYear"],
        )

    @property
    def zone(self) -> DataFrame:
        """Reporters present in flows, stored beside them so that their size is known."""
        return self.stored("zone", lambda: zone.zone_of(self.flows))

    @property
    def extra(self) -> DataFrame:
        return zone.extra_zone_countries(self.flows, self.zone)

    @property
    def extra_monthly(self) -> DataFrame:
        """The rollup that the study stores and reads in place of the flows."""
        return self.stored(
            "extra_zone_monthly", lambda: shares.origin_month(self.extra), ["refYear"]
        )

    @property
    def zone_by_type(self) -> DataFrame:
        return self.stored("zone_by_type", lambda: zone.zone_of(self.flows_by_type))

    @property
    def extra_by_type(self) -> DataFrame:
        return zone.extra_zone_countries(self.flows_by_type, self.zone_by_type)

    # -- flawed declarations -----------------------------------------------------------

    @property
    def raw_flawed(self) -> DataFrame:
        """The raw lines with World lines that disagree with their partners, and lines without a weight."""
        is_world = F.col("partnerCode") == 0
        is_total = (F.col("motCode") == 0) & (F.col("customsCode") == "C00")
        place = F.col("reporterCode") + F.col("refMonth")
        weight = (
            F.when(is_world & is_total & (place % 5 == 0), F.col("netWgt") * 1.25 + 1)
            .when(is_world & (place % 11 == 0), None)
            .when(~is_world & ((place + F.col("partnerCode")) % 9 == 0), None)
            .otherwise(F.col("netWgt"))
        )
        return self.stored("raw_flawed", lambda: self.raw.withColumn("netWgt", weight), ["refYear"])

    @property
    def named_flawed(self) -> DataFrame:
        return build.named_detail(self.raw_flawed, self.partners, self.reporters)

    @property
    def extra_flawed(self) -> DataFrame:
        flows = self.stored(
            "flows_flawed", lambda: build.flows(self.raw_flawed, self.partners, self.reporters), ["refYear"]
        )
        members = self.stored("zone_flawed", lambda: zone.zone_of(flows))
        return zone.extra_zone_countries(flows, members)

    @property
    def lattice(self) -> DataFrame:
        """Partial sums of the declarations, which the quality reports share."""
        return self.stored("lattice", lambda: lattice.lattice(clean.totals_only(self.raw)), ["refYear"])

    # -- upkeep ------------------------------------------------------------------------

    @property
    def refreshed(self) -> Store:
        """A store built while one reporter lacked its later years, and then brought up to date for it."""

        def make() -> Store:
            store = Store(self.spark, self.store.path("refreshed"))
            late = (F.col("reporterCode") == LATE_REPORTER) & (F.col("refYear") > LAST_FIRST_BATCH_YEAR)
            upkeep.rebuild(store, self.raw.filter(~late), self.partners, self.reporters)
            upkeep.refresh(store, self.raw, self.partners, self.reporters, [LATE_REPORTER])
            return store

        return self._once("refreshed", make)

    # -- prices ------------------------------------------------------------------------

    def monthly_prices(self) -> DataFrame:
        """Monthly means as (series, period, value), to six decimals.

        Order totals are whole cents, so their mean can lie exactly halfway between two
        six-decimal values. It is rounded half up in integers, which no engine does differently.
        """

        def monthly(source: DataFrame, series: str, day: str, value: str) -> DataFrame:
            mean = source.groupBy(F.year(day).alias("y"), F.month(day).alias("m")).agg(
                F.expr(value).alias("value")
            )
            period = F.format_string("%04d-%02d", "y", "m")
            return mean.select(F.lit(series).alias("series"), period.alias("period"), "value")

        cents, n = "sum(cast(round(o_totalprice * 100) AS bigint))", "count(o_totalprice)"
        crude = monthly(
            self.table("orders"),
            CRUDE,
            "o_orderdate",
            f"((20 * {cents} + {n}) div (2 * {n})) / 1000000",
        )
        product = monthly(
            self.table("lineitem"),
            PRODUCT,
            "l_shipdate",
            "round(avg(try_divide(l_extendedprice, l_quantity)) / 1000, 6)",
        )
        return crude.unionByName(product)

    @property
    def price_points(self) -> DataFrame:
        """Stored like a landed price series, so that bounds on the period text filter points."""
        return self.stored("price_points", self.monthly_prices)

    @property
    def prices(self) -> DataFrame:
        start, end = FULL_PERIOD
        return self.stored(
            "prices", lambda: prices.tidy_prices(self.price_points, start=start, end=end)
        )

    @property
    def spread(self) -> DataFrame:
        return prices.crack_spread(self.prices)

    # -- landing folder ----------------------------------------------------------------

    def envelopes(self, whole: bool = False) -> DataFrame:
        """Landed envelopes, one per reporter and month.

        Some years are missing and some empty, as completeness reports want it; with `whole` all
        lines land. An envelope is bounded: it lists one reporter's partner lines of one month.
        """
        key = F.col("reporterCode") + F.col("refYear")
        record = F.struct(*RAW_RECORD.fieldNames())
        return (
            self.raw.join(self.reporters, "reporterCode")
            .filter(F.lit(whole) | (key % 13 != 5))
            .groupBy(F.col("reporterName").alias("iso3"), F.col("refYear").alias("year"), "refMonth")
            .agg(F.collect_list(F.when(F.lit(whole) | (key % 11 != 0), record)).alias("data"))
            .select("iso3", "year", F.size("data").alias("count"), "data")
        )

    @property
    def landing(self) -> str:
        """Folder of the landed envelopes."""
        path = self.store.path("landing")

        def land() -> DataFrame:
            files = self.envelopes()
            files.write.mode("overwrite").partitionBy("iso3", "year").json(path)
            return files

        self._once("landing", land)
        return path

    @property
    def whole_envelopes(self) -> DataFrame:
        """All lines, landed and read back."""
        path = self.store.path("landing_whole")

        def land() -> DataFrame:
            files = self.envelopes(whole=True)
            files.write.mode("overwrite").partitionBy("iso3", "year").json(path)
            return landing.read_envelopes(self.spark, path, "partitioned", multi_line=False)

        return self._once("whole envelopes", land)

    @property
    def landed_envelopes(self) -> DataFrame:
        """The landed envelopes, their folder listed once."""
        return self._once(
            "landed envelopes",
            lambda: landing.read_envelopes(
                self.spark, self.landing, "partitioned", multi_line=False
            ),
        )


_fixtures: dict[tuple[str, str], Fixture] = {}


def fixture(spark: SparkSession, sf_dir: str) -> Fixture:
    """The fixture of a session and data directory; its tables are written on first use."""
    return _fixtures.setdefault(
        (spark.sparkContext.applicationId, sf_dir), Fixture(spark, sf_dir)
    )
