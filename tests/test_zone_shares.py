import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from tradeflow.functions import checked_broadcast
from tradeflow.operators import distance, prices, shares, zone


def test_unknown_partner_is_neither_in_nor_out(flows, rows):
    df = flows(
        (2020, 1, 1, 10, 5.0), (2020, 1, 1, 2, 1.0), (2020, 1, 2, 10, 4.0),
        (2020, 1, 2, 1, None), (2020, 1, 1, None, 9.0),
    )
    flagged = zone.zone_flag(df)
    assert rows(flagged, "reporterCode", "partnerCode", "isExtraZone") == [
        (1, 10, True), (1, 2, False), (1, None, None), (2, 1, False), (2, 10, True),
    ]
    assert rows(zone.extra_zone(df), "reporterCode", "partnerCode") == [(1, 10), (2, 10)]


def test_zone_is_what_reported_unless_declared(spark, flows, rows):
    df = flows((2020, 1, 1, 10, 5.0), (2020, 1, 1, 3, 5.0))
    declared = spark.createDataFrame([(1,), (3,), (3,)], "reporterCode int")
    assert rows(zone.extra_zone(df), "partnerCode") == [(10,), (3,)]
    assert rows(zone.extra_zone(df, declared), "partnerCode") == [(10,)]
    assert rows(zone.zone_flag(df, declared), "partnerCode", "isExtraZone") == [(10, True), (3, False)]


def test_zone_is_read_before_filtering(flows, rows):
    """Reporter 2 has special partners only, yet belongs to the zone."""
    df = flows((2020, 1, 1, 2, 5.0), (2020, 1, 1, 9, 5.0), (2020, 1, 2, 8, 1.0, True))
    assert rows(zone.extra_zone_countries(df), "partnerCode") == [(9,)]


def test_null_special_flag_is_dropped(flows, rows):
    df = flows((2020, 1, 1, 9, 5.0, None), (2020, 1, 1, 8, 5.0), (2020, 1, 1, 7, 5.0, True))
    assert rows(zone.countries(df), "partnerCode") == [(8,)]


def test_broadcast_is_bounded(spark):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    codes = spark.range(10).withColumnRenamed("id", "code")
    assert "strategy=broadcast" in plan(codes.join(checked_broadcast(codes, 10), "code"))
    assert "strategy=broadcast" not in plan(codes.join(checked_broadcast(codes, 9), "code"))


def test_hub_ratio(flows, rows):
    df = flows(
        (2020, 1, 1, 2, 3000.0), (2020, 1, 1, 9, 1000.0), (2020, 1, 2, 9, 5.0),
        (2020, 1, 3, 9, 0.0), (2020, 1, 1, None, 1000.0),
    )
    assert rows(zone.hub_ratio(df), "reporterCode", "tonnes", "intra_zone_pct") == [
        (1, 5.0, 60.0), (2, 0.005, 0.0), (3, 0.0, None),
    ]


def test_top_ties_go_by_name(flows, rows):
    df = flows((2020, 1, 1, 8, 9.0), (2020, 1, 1, 7, 9.0), (2020, 1, 1, 6, 1.0), (2020, 2, 1, 6, 9.0))
    assert rows(shares.top_origins(df, 2), "rank", "partnerName", "total_t") == [(1, "P6", 0.01), (2, "P7", 0.009)]


def test_shares_and_other(flows, rows):
    df = flows(
        (2020, 1, 1, 7, 60.0), (2020, 1, 1, 8, 30.0), (2020, 1, 2, 9, 10.0),
        (2020, 2, 1, 7, 0.0), (2020, 2, 1, 9, 0.0),
    )
    got = shares.market_share(df, 2)
    assert rows(got, "refMonth", "origin", "share_pct") == [
        (1, "Other", 10.0), (1, "P7", 60.0), (1, "P8", 30.0),
        (2, "Other", None), (2, "P7", None),  # nothing shipped that month
    ]
    assert rows(shares.origin_pivot(df, 2), "date", "top1", "top2", "other") == [
        (date(2020, 1, 1), 0.06, 0.03, 0.01), (date(2020, 2, 1), 0.0, 0.0, 0.0),
    ]


def test_cut_comes_after_ranking(flows, rows):
    df = flows((2020, 1, 1, 7, 1.0), (2020, 1, 1, 8, 2.0), (2020, 2, 1, 7, 9.0))
    got = shares.market_share(df, 1, end_date="2020-01-01")
    assert rows(got, "refMonth", "origin", "tonnes") == [(1, "Other", 0.002), (1, "P7", 0.001)]


def test_apostrophe_in_a_name(flows, rows):
    df = flows((2020, 1, 1, 7, 1.0), (2020, 1, 1, 8, 2.0)).withColumn(
        "partnerName", F.when(F.col("partnerCode") == 8, "Côte d'Ivoire").otherwise("x")
    )
    assert rows(shares.origin_monthly(df, 1), "origin", "tonnes") == [("Côte d'Ivoire", 0.002), ("Other", 0.001)]


def test_coverage_ties_share_a_value(flows, rows):
    df = flows((2020, 1, 1, 7, 9.0), (2020, 1, 1, 8, 9.0), (2020, 1, 1, 9, 1.0))
    got = {r.partnerName: r.cumulative_pct for r in shares.coverage(df).collect()}
    assert got["P7"] == got["P8"] == pytest.approx(18 / 19 * 100)
    assert got["P9"] == pytest.approx(100.0)


def test_coverage_reached(spark, flows, rows):
    report = shares.coverage(flows((2020, 1, 1, 7, 6.0), (2020, 1, 1, 8, 3.0), (2020, 1, 1, 9, 1.0)))
    known = spark.createDataFrame([("P7",), ("P8",), ("elsewhere",)], "partnerName string")
    assert rows(shares.coverage_covered(report, known)) == [(2, pytest.approx(90.0))]


def test_transition(spark, rows):
    months = [(2022, 11, 50.0), (2022, 12, 40.0), (2023, 2, 6.0), (2023, 3, 1.0), (2023, 4, 0.5)]
    table = [(y, m, "A", s) for y, m, s in months] + [(y, m, "B", 10.0) for y, m, _ in months]
    df = spark.createDataFrame(table, "refYear int, refMonth int, origin string, share_pct double")
    got = {r.origin: r.asDict() for r in shares.transition_speed(df).collect()}
    assert got["A"]["baseline_share_pct"] == 45.0
    assert got["A"]["first_low"] == date(2023, 3, 1)
    assert (got["A"]["months_elapsed"], got["A"]["ever_low"]) == (1, True)
    assert (got["B"]["months_elapsed"], got["B"]["ever_low"], got["B"]["first_low"]) == (None, False, None)
    late = {r.origin: r.months_elapsed for r in shares.transition_speed(df, "2022-12-01").collect()}
    assert late["A"] == 3
    window = shares.share_window(df, "A", "2022-12-01", "2023-02-01")
    assert rows(window, "refYear", "refMonth") == [(2022, 12), (2023, 2)]


def test_keys_keep_commodities_apart(flows, rows):
    df = flows((2020, 1, 1, 7, 1.0), (2020, 1, 1, 8, 3.0), (2020, 1, 1, 9, 5.0)).withColumn(
        "cmdCode", F.when(F.col("partnerCode") == 9, "b").otherwise("a")
    )
    keys = ["cmdCode"]
    assert rows(shares.top_origins(df, 1, keys), "cmdCode", "partnerName") == [("a", "P8"), ("b", "P9")]
    assert rows(shares.market_share(df, 1, keys), "cmdCode", "origin", "share_pct") == [
        ("a", "Other", 25.0), ("a", "P8", 75.0), ("b", "P9", 100.0),
    ]
    assert rows(shares.coverage(df, keys), "cmdCode", "partnerName", "cumulative_pct") == [
        ("a", "P7", 100.0), ("a", "P8", 75.0), ("b", "P9", 100.0),
    ]


def test_a_rollup_stands_in_for_flows(spark, flows, rows):
    df = flows(*[(2020, m, r, p, float(m * r * p % 7)) for m in (1, 2, 3) for r in (1, 2) for p in (7, 8, 9)])
    rollup = shares.origin_month(df)
    known = spark.createDataFrame([("P7", 10, "a"), ("P8", 30, "b")], "partnerName string, nm_to_rotterdam int, confidence string")
    for analysis in (
        lambda d: shares.market_share(d, 2),
        lambda d: shares.origin_pivot(d, 2),
        shares.coverage,
        lambda d: distance.tonne_miles(d, known),
        lambda d: distance.confidence_coverage(d, known),
        prices.monthly_volume,
    ):
        assert rows(analysis(rollup)) == rows(analysis(df))


@pytest.mark.parametrize("seed", range(3))
def test_shares_against_brute_force_with_a_hot_origin(flows, seed):
    """A third of all rows come from one origin."""
    rng = random.Random(seed)
    facts = [
        (2020, rng.randrange(1, 5), rng.choice([1, 2, 3]), rng.choice([10] * 4 + list(range(11, 19))),
         float(rng.randrange(0, 50)))
        for _ in range(150)
    ]
    volume, month_total = Counter(), Counter()
    for _, m, _, p, w in facts:
        volume[f"P{p}"] += w
        month_total[m] += w
    ranked = sorted(volume, key=lambda name: (-volume[name], name))
    pooled = Counter()
    for _, m, _, p, w in facts:
        pooled[m, f"P{p}" if f"P{p}" in ranked[:4] else "Other"] += w

    df = flows(*facts)
    got = {(r.refMonth, r.origin): r for r in shares.market_share(df, 4).collect()}
    assert set(got) == set(pooled)
    for cell, row in got.items():
        assert row.tonnes == pytest.approx(pooled[cell] / 1000)
        assert row.share_pct == pytest.approx(pooled[cell] / month_total[cell[0]] * 100)

    total = sum(volume.values())
    for row in shares.coverage(df).collect():
        reached = sum(v for v in volume.values() if v >= volume[row.partnerName])
        assert row.cumulative_pct == pytest.approx(reached / total * 100)


@pytest.mark.parametrize("keys", [[], ["cmdCode"]])
def test_running_coverage_in_ranges(spark, flows, rows, keys):
    """As coverage(), ties and all, over several ranges."""
    facts = [(2020, m, 1, p, float(p % 5 * 10) if p != 33 else None) for p in range(10, 60) for m in (1, 2)]
    df = flows(*facts).withColumn("cmdCode", F.when(F.col("partnerCode") % 3 == 0, "a").otherwise("b"))
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        found = rows(shares.coverage_ranges(df, keys))
    finally:
        spark.conf.set(name, "true")
    assert found == rows(shares.coverage(df, keys))
    assert rows(shares.coverage_ranges(df.filter("false"), keys)) == []
