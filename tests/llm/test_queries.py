"""Registered queries: names, and SQL for those that have it."""

import os
import re

import pytest

import __spark_entry__
from tradeflow.llm.queries import ORACLE_SQL, QUERIES
from workload.compare import connect, differences

SMALL = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    numbers = [int(re.match(r"op(\d+)_[a-z]", name)[1]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and set(ORACLE_SQL) < set(QUERIES)
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_agrees_with_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE_SQL[name]) == []
