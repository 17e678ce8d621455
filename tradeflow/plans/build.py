"""From landed lines to the flows fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tradeflow.operators.clean import split_detail, totals_only
from tradeflow.operators.densify import zero_rows
from tradeflow.operators.enrich import enrich
from tradeflow.schemas import FLOWS


def detail(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Raw lines -> one row per reporter, partner and month, breakdowns removed."""
    return split_detail(totals_only(raw, keys))


def named_detail(
    raw: DataFrame, partners: DataFrame, reporters: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Raw lines -> partner detail with names."""
    return enrich(detail(raw, keys), partners, reporters)


def coded(raw: DataFrame, keys: Sequence[str] = (), facts: DataFrame | None = None) -> DataFrame:
    """Raw lines -> dense partner detail on bare codes.

    raw is read twice, for its rows and for what is silent; facts may be raw with something observed on
    the way, for the first.
    """
    rows = detail(raw if facts is None else facts, keys)
    return rows.unionByName(zero_rows(detail(raw, keys), keys, attributes=()), allowMissingColumns=True)


def flows(
    raw: DataFrame, partners: DataFrame, reporters: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Raw lines -> the dense fact table, columns in the published order after the keys.

    Zeros are filled in on bare codes and names joined last: names depend on the codes alone,
    so the result is that of filling named detail, without carrying text through the shuffle.
    """
    return enrich(coded(raw, keys), partners, reporters).select(*keys, *FLOWS.fieldNames())
