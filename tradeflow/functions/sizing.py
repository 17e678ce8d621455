"""Broadcast only what has been counted; counts taken on the way of a write."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# Code lists (countries, reporters) have a few hundred rows; this leaves ample room
# while a broadcast of this many short rows still stays at a few megabytes.
MAX_BROADCAST_ROWS = 100_000


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if df has at most max_rows rows, otherwise leave the join to Spark.

    For sides whose size Spark cannot know when it plans, such as a DISTINCT over a fact
    table. Beyond the bound the same join runs as a shuffle join, where adaptive execution
    splits hot keys. Pass a stored table instead to save the count.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def counts_of(seen: Observation) -> dict | None:
    """What was observed by a job that has run; None if its result was empty.

    Adaptive execution replaces an empty result, and the observed step with it, once it knows.
    """
    try:
        return seen.get
    except Py4JJavaError:
        return None
