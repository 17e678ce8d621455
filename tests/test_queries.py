"""Every registered query against its oracle, and the figures known for the test data."""

import os

import pytest

from workload.adapter import fixture
from workload.compare import connect, differences
from workload.oracle import oracle_sql
from workload.queries import QUERIES

DATA = "/root/testdata"
SMALL, MEDIUM = f"{DATA}/sf0.001", f"{DATA}/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")


@pytest.fixture(scope="module")
def oracle():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_agrees_with_sql(spark, oracle, name):
    assert differences(QUERIES[name](spark, SMALL), oracle, oracle_sql()[name]) == []


def test_running_again_gives_the_same(spark):
    for name in ("ingest_incremental", "flows"):
        assert QUERIES[name](spark, SMALL).count() == QUERIES[name](spark, SMALL).count()


def test_known_figures(spark):
    fx = fixture(spark, MEDIUM)
    assert fx.raw.count() == 24_996
    summary = QUERIES["zero_fill_summary"](spark, MEDIUM).first()
    assert tuple(summary) == (6_462, 3_913, 10_375)
    assert QUERIES["special_share"](spark, MEDIUM).first().total_t == 311.291
    recon = QUERIES["world_recon"](spark, MEDIUM).first()
    assert (recon.n_reporter_months, recon.gap_pct, recon.n_zero_world) == (353, 0.0, 62)
    flawed = QUERIES["world_recon_flawed"](spark, MEDIUM).first()
    assert flawed.gap_pct > 5 and flawed.n_zero_world > recon.n_zero_world
    assert QUERIES["world_recon_monthly_flawed"](spark, MEDIUM).filter("gap > 0").count() > 50
    assert QUERIES["zero_fill_flawed"](spark, MEDIUM).filter("netWgt IS NULL").count() > 100
    tonnes = {r.confidence: r.tonnes for r in QUERIES["confidence_coverage"](spark, MEDIUM).collect()}
    assert tonnes == {"verified": 75.218, "verified_proxy_port": 59.403, "estimated": 67.289, "none": 35.585}
    assert QUERIES["market_share"](spark, MEDIUM).count() == 83 * 7
    assert QUERIES["prices_missing"](spark, MEDIUM).count() == 3


def test_invariants(spark):
    shares = QUERIES["market_share"](spark, MEDIUM)
    for row in shares.groupBy("refYear", "refMonth").agg({"share_pct": "sum"}).collect():
        assert row[2] == pytest.approx(100, abs=1e-4)
    report = sorted(QUERIES["coverage"](spark, MEDIUM).collect(), key=lambda r: -r.tonnes)
    running = [r.cumulative_pct for r in report]
    assert running == sorted(running) and running[-1] == pytest.approx(100)
    total = sum(r.tonnes for r in report)
    assert sum(r.tonnes for r in shares.collect()) == pytest.approx(total)
    miles = QUERIES["tonne_miles"](spark, MEDIUM).collect()
    assert sum(r.extra_zone_tonnes for r in miles) < total
