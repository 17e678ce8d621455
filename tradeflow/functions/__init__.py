from tradeflow.functions.columns import (
    month_index,
    month_start,
    pearson,
    pct,
    ratio,
    until,
    year_month_between,
)
from tradeflow.functions.sizing import checked_broadcast, counts_of

__all__ = [
    "checked_broadcast",
    "counts_of",
    "month_index",
    "month_start",
    "pct",
    "pearson",
    "ratio",
    "until",
    "year_month_between",
]
