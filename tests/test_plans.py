"""What the physical plans must not contain."""

import os
import re

import pytest
from pyspark.sql import functions as F

from workload.queries import QUERIES

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")

# Streaming writes its table in jobs of its own; its result is a plain scan.
FORBIDDEN = ("NestedLoopJoin", "CartesianProduct", "PythonUDF", "EvalPython", "MapInPandas", "Scan ExistingRDD")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan(spark, name):
    plan = physical(QUERIES[name](spark, SMALL))
    for word in FORBIDDEN:
        assert word not in plan, word
    assert not single_tasks_over_rows(plan), "one task over unaggregated rows"


def single_tasks_over_rows(plan):
    """What lies below each exchange into one task, along the left side of joins, if no aggregate or top-n."""
    lines = [re.sub(r"^[\s:|+-]*(\*\(\d+\) )?", "", line) for line in plan.splitlines()]
    found = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            passed = ("Project", "Filter", "Sort ", "AQEShuffleRead", "ShuffleQueryStage", "Exchange", "InputAdapter", "WholeStage", "Window", "BroadcastHashJoin", "SortMergeJoin")
            below = next((x for x in lines[i + 1 :] if not x.startswith(passed)), "")
            if not re.match(r"\w*Aggregate|TakeOrdered|Range|LocalTableScan|ReusedExchange", below):
                found.append(below)
    return found


def test_a_single_task_over_rows_is_found(spark):
    rows = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    window = rows.selectExpr("row_number() OVER (ORDER BY l_orderkey) AS n", "l_suppkey")
    assert single_tasks_over_rows(physical(window))
    assert not single_tasks_over_rows(physical(rows.selectExpr("sum(l_quantity)")))


def test_facts_are_shuffled_once_as_partial_sums(spark):
    """The zone and distance joins run where the facts lie; only monthly sums move."""
    plan = physical(QUERIES["tonne_miles"](spark, SMALL))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("BroadcastHashJoin") == 2


def test_ranking_and_months_read_the_facts_once(spark):
    df = QUERIES["market_share"](spark, SMALL)
    df.collect()
    assert "ReusedExchange" in physical(df)


def test_scan_reads_only_what_is_used(spark):
    plan = QUERIES["market_share"](spark, SMALL)._jdf.queryExecution().toString()
    schema = max(re.findall(r"ReadSchema: struct<([^>]*)>", plan), key=len)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "refMonth", "partnerCode", "partnerName", "is_special_partner", "netWgt",
    }
    assert "Not(EqualTo(is_special_partner,true)), IsNotNull(partnerCode)]" in plan


def test_date_cut_prunes_partitions(spark):
    plan = QUERIES["mart_flows"](spark, SMALL)._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(refYear#\d+\), \(refYear#\d+ <= 2000\)", plan)


def test_hot_join_key_is_split(spark):
    """One order with a third of the lines: its partition is read in pieces."""
    lines = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    orders = spark.range(300_000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("r"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = lines.join(orders, "k").groupBy("r").agg(F.count("*").alias("n"), F.max("v").alias("v"))
        assert sum(r.n for r in joined.collect()) == 300_000
        assert "skew=true" in physical(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
