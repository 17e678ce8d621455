"""Running sums over ranges against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tradeflow.plans.running import PART, in_ranges, running


@pytest.fixture
def many_ranges(spark):
    """Small tables are dealt over several ranges, too."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


@pytest.fixture(scope="module")
def facts():
    """Half of all rows in one key, and a key that is null."""
    rng = random.Random(5)
    return [(rng.choice([7, 7, 7, None, 1, 2, 3]), i, rng.randint(-9, 9), rng.getrandbits(62)) for i in range(600)]


def test_sums_by_key_across_ranges(spark, many_ranges, facts):
    df = spark.createDataFrame(facts, "k int, i int, v long, x long").repartition(3)
    ranges = in_ranges(df, ["k", "i"])
    found = running(
        ranges, ["k"], ["i"], {"s": ("sum", F.col("v")), "h": ("xor", F.col("x")), "m": ("max", F.when(F.col("v") > 8, F.col("i")))}
    ).collect()
    hot = {r[PART] for r in found if r.k == 7}
    assert len(hot) > 1 and len(found) == len(facts)
    for r in found:
        mine = [f for f in facts if f[0] == r.k and f[1] <= r.i]
        h = 0
        for f in mine:
            h ^= f[3]
        assert (r.s, r.h, r.m) == (sum(f[2] for f in mine), h, max((f[1] for f in mine if f[2] > 8), default=None))


def test_sums_without_keys_and_with_peers(spark, many_ranges, facts):
    df = spark.createDataFrame(facts, "k int, i int, v long, x long")
    found = running(in_ranges(df, [F.desc("v")]), [], [F.desc("v")], {"s": ("sum", F.col("i"))}, peers=True).collect()
    assert {r[PART] for r in found} != {0}
    for r in found:
        assert r.s == sum(f[1] for f in facts if f[2] >= r.v)


def test_empty_table(spark):
    df = spark.createDataFrame([], "k int, i int, v long")
    assert running(in_ranges(df, ["k", "i"]), ["k"], ["i"], {"s": ("sum", F.col("v"))}).collect() == []
