"""Running sums in a sorted table without a task that holds a whole key, or the whole table.

The table is dealt into ranges of its order, each row with the number of its range, and written.
Within a range a plain window sums; what a key has summed in the ranges before is one row per range,
which is added to all rows of the key there. Only keys that reach over a border need such a row, and
a border cuts one key, so there are at most two of them a range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.plans.store import Store

PART = "range_part"

_SUMS = {
    "sum": (F.sum, lambda own, before: F.coalesce(own + before, own, before)),
    "xor": (F.bit_xor, lambda own, before: F.coalesce(own.bitwiseXOR(before), own, before)),
    "max": (F.max, F.greatest),
}


def in_ranges(df: DataFrame, order: Sequence[str | Column], name: str = "ranges") -> DataFrame:
    """df dealt into ranges of the order and written, with the number of the range in PART.

    Rows that are equal in the order share a range.
    """
    dealt = df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id())
    return Store(df.sparkSession).put(name, dealt)


def running(
    ranges: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    of: Mapping[str, tuple[str, Column]],
    peers: bool = False,
) -> DataFrame:
    """ranges with a column per entry of `of`: name -> (sum, xor or max, of what) up to the row itself.

    ranges is a table of in_ranges, dealt by keys and then order. Rows of a key that are equal in the
    order share a value with peers=True and follow one another in any order otherwise. A column is NULL
    as long as all it has met is NULL.
    """
    first = Window.unboundedPreceding
    own = Window.partitionBy(PART, *keys).orderBy(*order)
    own = own.rangeBetween(first, Window.currentRow) if peers else own.rowsBetween(first, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(first, -1)
    before = {name: f"{name}_before" for name in of}
    whole = ranges.groupBy(PART, *keys).agg(
        *[_SUMS[kind][0](what).alias(name) for name, (kind, what) in of.items()]
    )
    carried = whole.select(
        F.col(PART).alias("_part"),
        *[F.col(k).alias(f"_{k}") for k in keys],
        *[_SUMS[kind][0](name).over(earlier).alias(before[name]) for name, (kind, _) in of.items()],
    )
    carried = carried.filter(reduce(Column.__or__, [F.col(b).isNotNull() for b in before.values()]))
    same = [F.col(PART) == F.col("_part"), *[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]]
    summed = ranges.repartition(PART).select(
        "*", *[_SUMS[kind][0](what).over(own).alias(name) for name, (kind, what) in of.items()]
    )
    # At most two rows a range: small whatever the table's size.
    joined = summed.join(F.broadcast(carried), reduce(Column.__and__, same), "left")
    return joined.select(
        *ranges.columns,
        *[_SUMS[kind][1](F.col(name), F.col(before[name])).alias(name) for name, (kind, _) in of.items()],
    )
