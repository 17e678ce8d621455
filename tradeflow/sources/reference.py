"""Readers for the partner list and the price series.

price_files and partner_files tell what could not be read; see sources.envelopes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.schemas import PARTNER_ENVELOPE, PRICE_ENVELOPE
from tradeflow.sources.envelopes import read_json

# Spelling of a landed price file.
PRICE_GLOB = "eia_*.json"
PRICE_KEY = r"eia_([^/]+)\.json$"


def partner_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed partner list: rows, unreadable, path, record."""
    return read_json(spark, path, PARTNER_ENVELOPE, "results")


def read_partner_areas(spark: SparkSession, path: str) -> DataFrame:
    """Partner list as published, one row per code; an unreadable list has none."""
    return partner_files(spark, path).select(F.explode("rows").alias("area")).select("area.*")


def price_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed price file: series, rows, unreadable, path, record; the file names the series."""
    files = read_json(spark, path, PRICE_ENVELOPE, "response.data", options={"pathGlobFilter": PRICE_GLOB})
    return files.withColumn("series", F.regexp_extract("path", PRICE_KEY, 1))


def read_price_series(spark: SparkSession, path: str) -> DataFrame:
    """Landed price files as (series, period, value); an unreadable file has no rows."""
    points = price_files(spark, path).select("series", F.explode("rows").alias("point"))
    return points.select("series", "point.period", "point.value")
