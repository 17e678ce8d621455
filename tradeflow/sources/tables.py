"""Table, CSV and literal sources and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.schemas import DISTANCE_DIM, REPORTER_DIM
from tradeflow.sources.fixed_values import DISTANCES, REPORTERS


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A dimension written down in code. Its size is that of the list, so it may be broadcast."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def reporters(spark: SparkSession) -> DataFrame:
    return literal_table(spark, REPORTERS, REPORTER_DIM)


def distances(spark: SparkSession) -> DataFrame:
    return literal_table(spark, DISTANCES, DISTANCE_DIM)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite path. Partitioned output is rebalanced on the partition columns first:

    adaptive execution then merges small and splits hot partitions into even files,
    instead of every task writing a sliver of every partition.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Create or replace a table of the catalog and return it.

    The rows go to a folder of their own in the warehouse and the name is then turned to it, in one step:
    until the end, and if the write fails, the name shows the old rows. Folders turned away from stay
    for readers that are still at work.
    """
    spark = df.sparkSession
    folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}-{uuid.uuid4().hex}"
    write_parquet(df, folder, partition_by)
    columns = ", ".join(f"CAST(`{c}` AS {dtype}) AS `{c}`" for c, dtype in df.dtypes)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{folder}`")
    return spark.table(name)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
