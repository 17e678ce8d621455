import random

import pytest
from pyspark.sql import functions as F

from tradeflow.operators import densify

CELL = ("reporterCode", "refYear", "refMonth", "partnerCode", "netWgt")


def test_silent_cells_become_zero(flows, rows):
    df = flows(
        (2020, 1, 1, 8, 5.0), (2020, 12, 1, 9, 7.0), (2021, 1, 1, 9, 1.0),
        (2020, 1, 2, 9, 3.0),  # reporter 2 published one month only
    )
    filled = densify.zero_fill(df)
    assert rows(filled, *CELL) == [
        (1, 2020, 1, 8, 5.0), (1, 2020, 1, 9, 0.0), (1, 2020, 12, 8, 0.0), (1, 2020, 12, 9, 7.0),
        (1, 2021, 1, 8, 0.0), (1, 2021, 1, 9, 1.0), (2, 2020, 1, 9, 3.0),
    ]
    zero = filled.filter("netWgt = 0").first()
    assert (zero.reporterName, zero.primaryValue, zero.isNetWgtEstimated) == ("R1", None, None)
    assert zero.partnerName == f"P{zero.partnerCode}" and zero.is_special_partner is False
    assert filled.columns == df.columns
    assert rows(densify.zero_fill_summary(df)) == [(4, 3, 7)]


def test_silent_reporter_gets_nothing(flows, rows):
    """A reporter that never published has no rows, whatever others know."""
    filled = densify.zero_fill(flows((2020, 1, 1, 8, 5.0), (2020, 2, 1, 8, 5.0)))
    assert {r[0] for r in rows(filled, "reporterCode")} == {1}


def test_null_weight_counts_as_missing(flows, rows):
    df = flows((2020, 1, 1, 5, None), (2020, 2, 1, 5, 3.0))
    assert rows(densify.zero_fill(df), "refMonth", "netWgt") == [(1, 0.0), (1, None), (2, 3.0)]
    kept = densify.zero_fill(df, null_is_present=True)
    assert rows(kept, "refMonth", "netWgt") == [(1, None), (2, 3.0)]


def test_idempotent_and_weight_preserving(flows):
    df = flows((2020, 1, 1, 8, 5.0), (2020, 2, 1, 9, 7.0), (2020, 3, 1, 8, 1.0))
    once = densify.zero_fill(df)
    assert densify.zero_rows(once).count() == 0
    assert once.agg(F.sum("netWgt")).first()[0] == 13.0


def test_published_months_do_not_cross_keys(spark, flows, rows):
    df = flows((2020, 1, 1, 8, 5.0), (2020, 2, 1, 9, 7.0), (2020, 3, 1, 9, 7.0)).withColumn(
        "cmdCode", F.when(F.col("partnerCode") == 8, "a").otherwise("b")
    )
    assert densify.zero_rows(df, ["cmdCode"]).count() == 0
    assert densify.zero_rows(df).count() == 3


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force_with_a_hot_lane(flows, rows, seed):
    """A third of all rows in one reporter, and repeated rows in one of its lanes."""
    rng = random.Random(seed)
    facts = [
        (2019 + rng.randrange(2), 1 + rng.randrange(12), rng.choice([1, 1, 1, 2, 3]),
         rng.randrange(10, 16), rng.choice([None, 0.0, 1.0, 2.0]))
        for _ in range(80)
    ]
    facts += [(2020, 5, 1, 10, 1.0)] * 40
    expected = []
    for r in {f[2] for f in facts}:
        mine = [f for f in facts if f[2] == r]
        weighed = {(f[0], f[1], f[3]) for f in mine if f[4] is not None}
        expected += [
            (r, y, m, p, 0.0)
            for y, m in {f[:2] for f in mine}
            for p in {f[3] for f in mine}
            if (y, m, p) not in weighed
        ]
    df = flows(*facts)
    assert rows(densify.zero_rows(df), *CELL) == sorted(expected, key=repr)
    assert rows(densify.zero_fill_summary(df)) == [(120, len(expected), 120 + len(expected))]


def test_lane(flows, rows):
    df = densify.zero_fill(flows((2020, 2, 528, 643, 5.0), (2020, 1, 528, 9, 7.0), (2020, 3, 528, 643, 2.0)))
    series = densify.lane_series(df, 528, 643).select("refMonth", "netWgt").collect()
    assert [tuple(r) for r in series] == [(1, 0.0), (2, 5.0), (3, 2.0)]
    assert rows(densify.lane_summary(df)) == [(528, 643, 3, 1), (528, 9, 3, 2)]


def test_rows_outside_the_calendar_or_without_keys(flows, rows):
    """A row without a reporter or a month, and a month 13, add no zeros and stay as they are."""
    df = flows(
        (2020, 1, 1, 8, 5.0), (2020, 2, 1, 9, 7.0), (None, 3, 1, 8, 1.0), (2020, None, 1, 8, 1.0), (2020, 13, 1, 8, 1.0),
        (2020, 1, None, 8, 1.0), (2020, 2, None, 9, 1.0), (2020, 1, 1, None, 2.0),
    )
    assert rows(densify.zero_rows(df), *CELL) == [
        (1, 2020, 1, 9, 0.0), (1, 2020, 2, 8, 0.0), (1, 2020, 2, None, 0.0),
    ]
    assert rows(densify.zero_fill_summary(df)) == [(8, 3, 11)]


def test_facts_are_read_twice(spark, tmp_path, flows):
    """Once for their rows and once for the states of lane-years, which both sides of the join share."""
    flows((2020, 1, 1, 8, 5.0), (2020, 2, 1, 9, 7.0)).write.parquet(str(tmp_path / "facts"))
    df = densify.zero_fill(spark.read.parquet(str(tmp_path / "facts")), attributes=())
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2 and "ReusedExchange" in plan
