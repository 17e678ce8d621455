"""What the operators share: words, fresh column names, tables written between steps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.plans.store import shared_folder

# A word is a run of characters other than these six.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
ROWS_A_FILE, TEXTS_A_FILE = 100_000, 2_000  # of a few numbers each, and of whole documents


def folder(spark: SparkSession, name: str) -> str:
    """A new folder of that name which all executors reach."""
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"


def in_files(df: DataFrame, rows: int, a_file: int = ROWS_A_FILE) -> DataFrame:
    """df of at most so many rows in no more partitions than these need, however many a shuffle made.

    Each file a task writes costs a task, and on a local disk child processes of the executor as well, which
    count as large as the executor until they have started. Partitions are merged, never split.
    """
    return df.coalesce(max(1, -(-rows // a_file)))


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df as a table in the shared folder: later jobs read it instead of computing it again.

    rows: a bound of the number of rows, where one is known; few rows then go into few files.
    """
    path = folder(df.sparkSession, name)
    if rows is not None:
        df = in_files(df, rows)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Names not taken yet, whatever columns a caller brings along."""
    used = {t.lower() for t in taken}
    found = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        found.append(name)
    return found


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(column: str) -> Column:
    """A null text is an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def quoted(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
