"""Runs queries beside their oracle SQL and reports the differences.

    python -m workload.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from tradeflow.session import local_session
from workload.oracle import oracle_sql
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


_SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if the query and its oracle agree in columns, types and values."""
    cursor = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    names = list(types)
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    found = [
        f"type of {name}: {dtype} != {types[name]}"
        for name, dtype in df.dtypes
        if _SAME_TYPE.get(dtype, dtype) != types[name]
    ]
    ours, theirs = _bag(df.columns, df.collect()), _bag(names, cursor.fetchall())
    if ours != theirs:
        found.append(
            f"rows {ours.total()} != {theirs.total()}; only here {list((ours - theirs).items())[:2]}; "
            f"only oracle {list((theirs - ours).items())[:2]}"
        )
    return found


def main(spark: SparkSession, sf_dir: str, names: list[str]) -> int:
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name in names:
        if name not in sqls:
            print(f"{name}: no oracle")
            continue
        found = differences(QUERIES[name](spark, sf_dir), con, sqls[name])
        bad += bool(found)
        print(f"{name}: {'ok' if not found else found}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(main(local_session(8), directory, sys.argv[2:] or list(QUERIES)) > 0)
