"""Tables written between steps, and tables that readers keep while they are replaced.

A step that several others read is written once as Parquet, so they neither recompute it
nor depend on executors that held it, and Spark knows its size when it plans their joins.

Each version of a table is a folder of its own, and a log entry names the folder of each table that
counts. put() writes the folder, then the entry; inside a change() the entry comes at the end, so
several tables switch together or, if the job dies, none does. A DataFrame of an earlier version stays
readable until vacuum() removes what the last entries no longer name.

A table whose rows belong to units, as flows belong to reporters, can be kept up to date in pieces:
replace_units() writes the new rows of some units beside the old ones, and the entry says which units each
older piece has lost. Reading skips those, by a filter that reaches the scan.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.plans.log import Log
from tradeflow.sources.tables import read_parquet, write_parquet

SHARED_FOLDER = "spark.checkpoint.dir"
LOG = "_log"
MOST_PIECES = 8


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tradeflow-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the session names.

    Only a local session, where driver and executors are one process, falls back to a
    temporary folder of this machine, one for all its tables.
    """
    named = spark.conf.get(SHARED_FOLDER, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_FOLDER} to a folder that all executors share")
    return _local_folder()


class Store:
    """Named tables under a folder of their own in the shared folder."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self._root = root
        self._log: Log | None = None
        self._changing: dict | None = None

    @property
    def root(self) -> str:
        if self._root is None:
            self._root = f"{shared_folder(self.spark)}/tradeflow-{uuid.uuid4().hex}"
        return self._root

    @property
    def log(self) -> Log:
        if self._log is None:
            self._log = Log(self.spark, f"{self.root}/{LOG}")
        return self._log

    def path(self, name: str) -> str:
        """Folder of what belongs to a name; its versions lie below."""
        return f"{self.root}/{name}"

    def state(self) -> dict:
        """What the log, or the change under way, says: tables (pieces by name) and notes."""
        found = self.log.last()[1] if self._changing is None else self._changing
        return {"tables": {}, "notes": {}, **found}

    @contextmanager
    def change(self) -> Iterator[Store]:
        """All tables put, and notes made, in this block count from its end on; none if it fails.

        Inside the block the store itself already reads them.
        """
        if self._changing is not None:
            yield self
            return
        number, before = self.log.last()
        self._changing = {
            "tables": dict(before.get("tables", {})), "notes": dict(before.get("notes", {})),
        }
        try:
            yield self
            self.log.commit(number + 1, self._changing)
        finally:
            self._changing = None

    def note(self, name: str, value: object) -> None:
        """A small value that counts together with the tables, for example what they were built from."""
        with self.change():
            self._changing["notes"][name] = value

    def has(self, name: str) -> bool:
        return name in self.state()["tables"]

    def pieces(self, name: str, version: int | None = None) -> list[dict]:
        """folder, unit and lost units of each piece of a table, oldest first."""
        state = self.state() if version is None else self.log.entry(version)
        if name not in state["tables"]:
            raise KeyError(f"no table {name} in {self.root}")
        return state["tables"][name]

    def _read(self, name: str, piece: dict, schema: T.StructType) -> DataFrame:
        df = read_parquet(self.spark, f"{self.path(name)}/{piece['folder']}", schema).select(schema.fieldNames())
        if piece["lost"]:
            unit = F.col(piece["unit"])
            df = df.filter(unit.isNull() | ~unit.isin(piece["lost"]))
        return df

    def get(self, name: str, schema: T.StructType, version: int | None = None) -> DataFrame:
        """The table as it counts now, or as of an entry of the log."""
        found = [self._read(name, piece, schema) for piece in self.pieces(name, version)]
        return reduce(DataFrame.unionByName, found)

    def _write(self, name: str, df: DataFrame, partition_by: Sequence[str], unit: str | None = None) -> dict:
        folder = f"v-{uuid.uuid4().hex}"
        write_parquet(df, f"{self.path(name)}/{folder}", partition_by)
        return {"folder": folder, "unit": unit, "lost": []}

    def put(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write df as the next version and return it, with the columns and types of df."""
        piece = self._write(name, df, partition_by)
        with self.change():
            self._changing["tables"][name] = [piece]
            return self.get(name, df.schema)

    def replace_units(
        self, name: str, df: DataFrame, unit: str, units: Sequence, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write df, the rows of the given units, in place of all that these units had; returned is df as written.

        The units are values of the column, not null, few enough for a filter. A table of more than
        MOST_PIECES pieces is then written anew in one.
        """
        fresh = self._write(name, df, partition_by, unit)
        with self.change():
            older = [{**p, "unit": unit, "lost": sorted({*p["lost"], *units})} for p in self.pieces(name)]
            self._changing["tables"][name] = [*older, fresh]
            written = self._read(name, fresh, df.schema)
            if len(older) >= MOST_PIECES:
                self.put(name, self.get(name, df.schema), partition_by)
            return written

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove versions that none of the last `keep` entries names; their paths.

        For a time when no other job writes: what it has written and not yet committed looks unused.
        """
        numbers = self.log.numbers()[-keep:]
        kept = [self.log.entry(n).get("tables", {}) for n in numbers]
        names = {name for tables in kept for name in tables}
        gone = [
            f"{self.path(name)}/{folder}"
            for name in sorted(names)
            for folder in self.log.folders(self.path(name))
            if folder.startswith("v-")
            and not any(piece["folder"] == folder for tables in kept for piece in tables.get(name, []))
        ]
        for path in gone:
            self.log.remove(path)
        if numbers:
            self.log.forget(numbers[0])
        return gone
