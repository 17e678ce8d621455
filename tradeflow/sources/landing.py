"""Landed JSON declarations: reading, stacking and finding what is missing.

A landing folder holds envelopes {count, data: [...]} of one (reporter, year) each, in one of
two layouts:

* ``named``        comtrade_{ISO3}_{YYYY}.json, one envelope per file
* ``partitioned``  iso3={ISO3}/year={YYYY}/*.json, which lets Spark skip whole folders

An envelope is one JSON value, so one task reads it. In the partitioned layout a large reporter
lands as many envelopes, one per line, over any number of files; every reader takes them together.

An envelope that is cut short, or holds a value of another type than declared, is unreadable: it is
marked, counts as neither empty nor landed lines, and ingest refuses it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.schemas import FLOW_ENVELOPE, INT, STRING
from tradeflow.sources.envelopes import read_json

# How keys are spelt in a landed path.
NAMED_GLOB = "comtrade_*.json"
NAMED_KEYS = r"comtrade_([A-Z0-9]{3})_([0-9]{4})\.json"
PARTITIONED_GLOB = "*.json"
PARTITIONED_KEYS = r"iso3=([A-Z0-9]{3})/year=([0-9]{4})/"

_LAYOUTS = {"named": (NAMED_GLOB, NAMED_KEYS), "partitioned": (PARTITIONED_GLOB, PARTITIONED_KEYS)}


def path_keys(path: Column, layout: str) -> list[Column]:
    pattern = _LAYOUTS[layout][1]
    return [
        F.regexp_extract(path, pattern, 1).alias("iso3"),
        F.regexp_extract(path, pattern, 2).try_cast("int").alias("year"),
    ]


def envelope_files(
    spark: SparkSession,
    path: str | list[str],
    layout: str = "named",
    multi_line: bool = True,
    base: str | None = None,
) -> DataFrame:
    """One row per envelope: iso3, year, data, unreadable, path, record.

    Pass multi_line=False if envelopes are written one per line, so big files can be split, and
    the landing folder as base if path lists some of its files.
    """
    options = {"pathGlobFilter": _LAYOUTS[layout][0], "recursiveFileLookup": layout == "named"}
    if base is not None:
        options["basePath"] = base
    fields = FLOW_ENVELOPE.fields
    if layout == "partitioned":  # keys are read off the folder names
        fields = [*fields, T.StructField("iso3", STRING), T.StructField("year", INT)]
    files = read_json(spark, path, T.StructType(fields), "data", multi_line, options)
    keys = ["iso3", "year"] if layout == "partitioned" else path_keys(F.col("path"), layout)
    return files.select(*keys, F.col("rows").alias("data"), "unreadable", "path", "record")


def read_envelopes(
    spark: SparkSession,
    path: str | list[str],
    layout: str = "named",
    multi_line: bool = True,
    base: str | None = None,
) -> DataFrame:
    """One row per envelope: iso3, year, data, unreadable. See envelope_files."""
    return envelope_files(spark, path, layout, multi_line, base).select("iso3", "year", "data", "unreadable")


def stack_raw(envelopes: DataFrame) -> DataFrame:
    """All records of all envelopes; an empty envelope adds none."""
    return envelopes.select(F.explode("data").alias("record")).select("record.*")


def landed_files(spark: SparkSession, path: str, layout: str = "named") -> DataFrame:
    """path, length, modified, iso3, year of every landed file, from the listing alone.

    A file without a byte is not listed: it has not landed yet, and the gap list says so.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", _LAYOUTS[layout][0])
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return listing.select(
        "path",
        "length",
        F.col("modificationTime").alias("modified"),
        *path_keys(F.col("path"), layout),
    )


def odd_files(files: DataFrame) -> DataFrame:
    """Landed files whose name tells no reporter and year."""
    return files.filter("iso3 = '' OR year IS NULL").select("path", "length")


def landed(spark: SparkSession, path: str, layout: str = "named") -> DataFrame:
    """(iso3, year) of every landed file with a telling name: no file is opened."""
    files = landed_files(spark, path, layout)
    return files.filter("iso3 != '' AND year IS NOT NULL").select("iso3", "year").distinct()


def expected_grid(reporters: DataFrame, years: Iterable[int]) -> DataFrame:
    """reporterCode, iso3, year for every file that should exist."""
    wanted = F.array(*[F.lit(y).cast("int") for y in years])
    return reporters.select(
        "reporterCode", F.col("reporterName").alias("iso3"), F.explode(wanted).alias("year")
    )


def landing_gaps(grid: DataFrame, present: DataFrame) -> DataFrame:
    """Expected files that have not landed: what the next download has to fetch."""
    return grid.join(present, ["iso3", "year"], "left_anti").select("reporterCode", "iso3", "year")
