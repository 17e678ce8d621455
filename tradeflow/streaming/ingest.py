"""Incremental landing: the raw table holds what the landed files hold now.

Files are known by path, length and modification time. A run compares the listing with the manifest,
takes the reporter-years with files that are new, changed or gone, reads all their present files, and
writes the lines into a partition of its own. What the run found is the manifest's next change: a row
per present file of those reporter-years, and a mark for each file that is gone. A log entry, written
last, names the changes and runs that count, so

* a file landed late with an old time, replaced under its name, emptied or deleted is seen, the last one
  of the folder too;
* a run that is killed leaves folders that no entry names, and is repeated as a whole;
* what is read never mixes two states of a reporter-year.

The manifest grows by what changed, not by the number of files: its state is a base and the changes
since, and after CHECKPOINT_EVERY changes they become the next base. Lines of superseded runs are
skipped when read; compact() writes the lines that count into one run, which a run does by itself once
more than MOST_RUNS are alive, and vacuum() removes folders that no longer count.

All present files of a reporter-year count together: a correction replaces its file, it does
not lie beside it. The driver sees counts, run names, and the paths of at most MOST_PATHS files;
beyond that the folder is read and cut to the reporter-years by a join.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.functions import counts_of
from tradeflow.operators.quality import DataQualityError, enforce
from tradeflow.plans.log import Log
from tradeflow.schemas import INT, RAW_RECORD, STRING
from tradeflow.sources import landing as source

RUN, YEAR = "run", "refYear"
KEYS = ["iso3", "year"]
LANDED = T.StructType(
    [
        *RAW_RECORD.fields,
        T.StructField("landedIso3", STRING),
        T.StructField("landedYear", INT),
        T.StructField(RUN, STRING),
    ]
)
MANIFEST = T.StructType(
    [
        T.StructField("path", STRING),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("iso3", STRING),
        T.StructField("year", INT),
        T.StructField(RUN, STRING),
        T.StructField("seq", INT),
        T.StructField("gone", T.BooleanType()),
    ]
)
CHECKPOINT_EVERY = 10
MOST_RUNS = 16
MOST_PATHS = 10_000


def _log(spark: SparkSession, manifest: str) -> Log:
    return Log(spark, f"{manifest}/_log")


def _rows(spark: SparkSession, manifest: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(*[f"{manifest}/{f}" for f in folders])


def _state(spark: SparkSession, manifest: str, entry: dict) -> DataFrame:
    """The files that count by an entry of the log: of each path the latest row."""
    base = [entry["base"]] if entry.get("base") else []
    rows = _rows(spark, manifest, [*base, *entry.get("changes", [])])
    latest = rows.groupBy("path").agg(F.max_by(F.struct(*MANIFEST.fieldNames()), "seq").alias("row"))
    return latest.select("row.*").filter("NOT gone")


def current(spark: SparkSession, manifest: str) -> DataFrame:
    """The files that counted after the last run, each with its run; no rows before the first."""
    return _state(spark, manifest, _log(spark, manifest).last()[1])


def compared(files: DataFrame, known: DataFrame) -> DataFrame:
    """All files, landed and known, of the reporter-years where any is new, changed or gone.

    Columns of files, and gone.
    """
    before = known.select("path", *[F.col(c).alias(f"_{c}") for c in ("length", "modified", *KEYS)])
    same = (F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified"))
    both = files.join(before, "path", "full").select(
        "path",
        *[F.coalesce(c, f"_{c}").alias(c) for c in ("length", "modified", *KEYS)],
        F.col("length").isNull().alias("gone"),
        F.coalesce(same, F.lit(False)).alias("same"),
    )
    untouched = F.bool_and("same").over(Window.partitionBy(*KEYS))
    return both.withColumn("same", untouched).filter("NOT same").drop("same")


def unreadable(envelopes: DataFrame) -> DataFrame:
    """Reporter-years with an envelope that could not be read as declared."""
    return envelopes.filter("unreadable").select(KEYS).distinct()


def _write_lines(
    spark: SparkSession, landing: str, table: str, run: str, present: DataFrame, n: int, layout: str, multi_line: bool
) -> None:
    """The lines of the present files, in a partition of the run; envelopes are checked on the way."""
    if n <= MOST_PATHS:
        paths = sorted(r["path"] for r in present.select("path").collect())
        envelopes = source.read_envelopes(spark, paths, layout, multi_line, landing)
    else:
        envelopes = source.read_envelopes(spark, landing, layout, multi_line)
        envelopes = envelopes.join(present.select(KEYS).distinct(), KEYS, "left_semi")
    seen = Observation()
    lines = envelopes.observe(seen, F.count_if("unreadable").alias("n_unreadable")).select(
        *KEYS, F.explode("data").alias("record")
    )
    lines = lines.select(
        "record.*", F.col("iso3").alias("landedIso3"), F.col("year").alias("landedYear"), F.lit(run).alias(RUN)
    )
    # Merged and split to even files; without it every task leaves a sliver of every year.
    lines = lines.hint("rebalance", YEAR)
    lines.write.mode("append").partitionBy(RUN, YEAR).parquet(table)
    counts = counts_of(seen)
    if counts is None or counts["n_unreadable"]:
        enforce(unreadable(envelopes), "unreadable files")
    if counts is not None and counts["n_unreadable"]:
        raise DataQualityError("unreadable files: they have changed meanwhile")


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    table: str,
    manifest: str,
    layout: str = "named",
    multi_line: bool = True,
) -> int:
    """Bring the raw table up to date with the landing folder; the number of files read.

    Raises DataQualityError, and changes nothing that counts, if a file has an odd name or holds an
    unreadable envelope.
    """
    log = _log(spark, manifest)
    number, entry = log.last()
    run, folder = uuid.uuid4().hex, f"c-{uuid.uuid4().hex}"
    files = source.landed_files(spark, landing, layout)
    found = compared(files, _state(spark, manifest, entry))
    stamped = found.withColumn(RUN, F.lit(run)).withColumn("seq", F.lit(number + 1))
    stamped.select(MANIFEST.fieldNames()).write.parquet(f"{manifest}/{folder}")
    change = _rows(spark, manifest, [folder])
    present = change.filter("NOT gone")
    n, n_odd, n_gone = change.selectExpr(
        "count_if(NOT gone)", "count_if(NOT gone AND (iso3 = '' OR year IS NULL))", "count_if(gone)"
    ).first()
    if n_odd:
        enforce(source.odd_files(present), "odd files")
    if not n and not n_gone:
        log.remove(f"{manifest}/{folder}")
        return 0
    if n:
        _write_lines(spark, landing, table, run, present, n, layout, multi_line)

    now = {"base": entry.get("base"), "changes": [*entry.get("changes", []), folder], "change": folder}
    if len(now["changes"]) >= CHECKPOINT_EVERY:
        base = f"b-{uuid.uuid4().hex}"
        _state(spark, manifest, now).write.parquet(f"{manifest}/{base}")
        now |= {"base": base, "changes": []}
    now["runs"] = sorted(r[0] for r in _state(spark, manifest, now).select(RUN).distinct().collect())
    log.commit(number + 1, now)
    if len(now["runs"]) > MOST_RUNS:
        compact(spark, table, manifest)
    return n


def _live(spark: SparkSession, table: str, manifest: str, entry: dict) -> DataFrame:
    """LANDED lines that count by an entry; the runs it names are the only partitions read."""
    if not entry.get("runs") or not _log(spark, manifest).folders(table):
        return spark.createDataFrame([], LANDED)
    counting = _state(spark, manifest, entry).select(
        F.col("iso3").alias("landedIso3"), F.col("year").alias("landedYear"), RUN
    )
    lines = spark.read.schema(LANDED).parquet(table).filter(F.col(RUN).isin(entry["runs"]))
    return lines.join(counting.distinct(), ["landedIso3", "landedYear", RUN], "left_semi")


def read_raw(spark: SparkSession, table: str, manifest: str) -> DataFrame:
    """The raw table, partitioned by year: the lines of the runs that count."""
    entry = _log(spark, manifest).last()[1]
    return _live(spark, table, manifest, entry).select(RAW_RECORD.fieldNames())


def compact(spark: SparkSession, table: str, manifest: str) -> None:
    """Write the lines that count into one run; what the raw table holds stays the same."""
    log = _log(spark, manifest)
    number, entry = log.last()
    if len(entry.get("runs", [])) < 2:
        return
    run, base = uuid.uuid4().hex, f"b-{uuid.uuid4().hex}"
    lines = _live(spark, table, manifest, entry).withColumn(RUN, F.lit(run)).select(LANDED.fieldNames())
    lines.hint("rebalance", YEAR).write.mode("append").partitionBy(RUN, YEAR).parquet(table)
    _state(spark, manifest, entry).withColumn(RUN, F.lit(run)).write.parquet(f"{manifest}/{base}")
    log.commit(number + 1, {"base": base, "changes": [], "change": None, "runs": [run]})


def vacuum(spark: SparkSession, table: str, manifest: str, keep: int = 2) -> list[str]:
    """Remove runs and manifest folders that none of the last `keep` entries names; their paths.

    For a time when no run is under way. changed_since() no longer answers for what was removed.
    """
    log = _log(spark, manifest)
    numbers = log.numbers()[-keep:]
    entries = [log.entry(n) for n in numbers]
    runs = {f"{RUN}={r}" for e in entries for r in e["runs"]}
    kept = {f for e in entries for f in (e["base"], *e["changes"], e["change"])}
    gone = [f"{table}/{f}" for f in log.folders(table) if f.startswith(f"{RUN}=") and f not in runs]
    gone += [f"{manifest}/{f}" for f in log.folders(manifest) if f[:2] in ("b-", "c-") and f not in kept]
    for path in gone:
        log.remove(path)
    if numbers:
        log.forget(numbers[0])
    return gone


def position(spark: SparkSession, manifest: str) -> int:
    """Number of the last entry: what has been ingested up to now."""
    return _log(spark, manifest).last()[0]


def changed_since(spark: SparkSession, manifest: str, number: int) -> DataFrame | None:
    """Reporter-years (iso3, year) that runs after an entry have touched; None if no longer known."""
    log = _log(spark, manifest)
    numbers = log.numbers()
    if number not in numbers:
        return None
    later = [log.entry(n)["change"] for n in numbers if n > number]
    there = set(log.folders(manifest))
    folders = [f for f in later if f]
    if not there.issuperset(folders):
        return None
    return _rows(spark, manifest, folders).select(KEYS).distinct()


def lines_of(spark: SparkSession, table: str, reporter_years: DataFrame) -> DataFrame:
    """Lines of all runs, superseded ones too, that landed under the given reporter-years."""
    if not Log(spark, table).folders(table):
        return spark.createDataFrame([], LANDED)
    wanted = reporter_years.select(F.col("iso3").alias("landedIso3"), F.col("year").alias("landedYear"))
    return spark.read.schema(LANDED).parquet(table).join(wanted, ["landedIso3", "landedYear"], "left_semi")
