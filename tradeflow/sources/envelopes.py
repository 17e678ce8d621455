"""Landed JSON envelopes of any kind, with what could not be read set apart.

An envelope that is cut short, or holds a value of another type than declared, is unreadable as a whole:
it gives no rows, and its path and beginning go to the quarantine, so that no reader mistakes it
for an empty one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.schemas import STRING

CORRUPT = "_corrupt_record"
SHOWN = 200
QUARANTINE = T.StructType([T.StructField(c, STRING) for c in ("source", "path", "record")])


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    rows: str,
    multi_line: bool = True,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """One row per envelope: the fields of the schema but the outermost holding the rows; rows, an array that is
    null where unreadable; unreadable; path; record, the beginning of what is unreadable.

    `rows` names the array in the envelope, with dots where it is nested.
    """
    reader = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, STRING)]))
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    outer = rows.split(".")[0]
    # Spark does not answer a query on the corrupt record alone, so the flag looks at the array too.
    bad = F.col(CORRUPT).isNotNull() & (F.coalesce(F.size(rows), F.lit(0)) >= -1)
    flagged = reader.json(path).select(
        *[f.name for f in schema.fields if f.name != outer],
        F.col(rows).alias("rows"),
        bad.alias("unreadable"),
        F.col("_metadata.file_path").alias("path"),
        F.substring(CORRUPT, 1, SHOWN).alias("record"),
    )
    return flagged.withColumn("rows", F.when(~F.col("unreadable"), F.col("rows")))


def quarantined(envelopes: DataFrame, source: str) -> DataFrame:
    """source, path and beginning of every unreadable envelope."""
    return envelopes.filter("unreadable").select(F.lit(source).alias("source"), "path", "record")
