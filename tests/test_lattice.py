"""Reports from the shared partial sums, against those over lines and flows."""

import random

import pytest
from pyspark.sql import functions as F

from tradeflow.operators import densify, enrich, lattice, quality, zone
from tradeflow.schemas import PARTNER_DIM, REPORTER_DIM

TOTALS = "refYear int, refMonth int, reporterCode int, partnerCode int, netWgt double, primaryValue double, isNetWgtEstimated boolean, cmdCode string"


def lines(seed):
    """A hot reporter, World lines that disagree, missing weights, zero weights and repeated lines."""
    rng = random.Random(seed)
    found = [
        (2019 + rng.randrange(2), 1 + rng.randrange(12), rng.choice([1, 1, 1, 2, 3]), rng.choice([0, 0, 1, 2, 10, 11, 12, 13]),
         rng.choice([None, 0.0, 1.0, 2.5]), 1.0, False, rng.choice("ab"))
        for _ in range(150)
    ]
    return found + found[:10]


@pytest.mark.parametrize(("seed", "keys"), [(0, []), (1, ["cmdCode"]), (None, ["cmdCode"])])
def test_reports_agree(spark, rows, seed, keys):
    totals = spark.createDataFrame(lines(seed) if seed is not None else [], TOTALS)
    partners = spark.createDataFrame([(c, f"P{c}", None, None, c == 12) for c in (1, 2, 10, 11, 12)], PARTNER_DIM)
    reporters = spark.createDataFrame([(c, f"R{c}") for c in (1, 2, 3)], REPORTER_DIM)
    cells = lattice.lattice(totals, keys)
    detail = totals.filter("partnerCode != 0")
    named = enrich.enrich(detail, partners, reporters)
    flows = densify.zero_fill(named, keys)
    members = zone.zone_of(flows)
    pairs = [
        (lattice.world_recon(cells, keys), quality.world_recon(totals, keys)),
        (lattice.world_recon_monthly(cells, keys), quality.world_recon_monthly(totals, keys)),
        (lattice.special_share(cells, partners, keys), enrich.special_share(flows, keys)),
        (lattice.zero_fill_summary(cells, keys), densify.zero_fill_summary(detail, keys)),
        (lattice.lane_summary(cells, keys), densify.lane_summary(flows, keys)),
        (lattice.hub_ratio(cells, reporters, members, keys), zone.hub_ratio(flows, members, keys)),
        (lattice.reporters_per_month(cells, keys), quality.reporters_per_month(flows, keys)),
    ]
    for ours, theirs in pairs:
        assert ours.columns == theirs.columns and ours.dtypes == theirs.dtypes
        assert rows(ours) == rows(theirs)
    assert cells.filter(F.col("n_lines") < F.col("n_weights")).count() == 0
