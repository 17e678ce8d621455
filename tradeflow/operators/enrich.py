"""Names on codes, and the volume behind codes that are not countries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import pct
from tradeflow.operators.quality import duplicate_keys, enforce, unknown_codes
from tradeflow.sources.fixed_values import KG_PER_TONNE


def enrich(detail: DataFrame, partners: DataFrame, reporters: DataFrame) -> DataFrame:
    """Add partner and reporter names; every flow row stays, matched or not.

    No broadcast hint: Spark knows the size of a stored dimension and broadcasts it when
    it is small, and literal_table() dimensions carry their own hint.
    """
    return detail.join(partners, "partnerCode", "left").join(reporters, "reporterCode", "left")


def check_dimensions(detail: DataFrame, partners: DataFrame, reporters: DataFrame) -> None:
    """Fail on codes without a name, and on a dimension that would multiply the flows."""
    enforce(duplicate_keys(partners, ["partnerCode"]), "duplicate partner codes")
    enforce(duplicate_keys(reporters, ["reporterCode"]), "duplicate reporter codes")
    enforce(unknown_codes(detail, {"partnerCode": partners, "reporterCode": reporters}), "unmatched codes")


def special_share(named: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Total tonnes, tonnes of special partners, and their share in percent."""
    total = F.sum("netWgt") / KG_PER_TONNE
    special = F.coalesce(F.sum(F.when(F.col("is_special_partner"), F.col("netWgt"))), F.lit(0.0))
    sums = named.groupBy(*keys).agg(
        total.alias("total_t"), (special / KG_PER_TONNE).alias("special_t")
    )
    return sums.withColumn("special_pct", pct(F.col("special_t"), F.col("total_t")))
