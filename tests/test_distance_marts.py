from datetime import date

import pytest

from tradeflow.operators import dims, distance, quality, shares
from tradeflow.plans import marts
from tradeflow.schemas import DISTANCE_DIM, MARKET_SHARES
from tradeflow.sources import tables


@pytest.fixture
def distances(spark):
    return spark.createDataFrame([("P9", "port", 1000, "verified"), ("P8", "port", 4000, "estimated")], DISTANCE_DIM)


@pytest.fixture
def cargo(flows):
    return flows(
        (2023, 1, 1, 9, 3000.0), (2023, 1, 1, 8, 1000.0), (2023, 1, 1, 7, 5000.0),
        (2023, 2, 1, 9, 1000.0), (2023, 2, 1, 8, 3000.0),
        (2026, 1, 1, 9, 0.0),
    )


def test_tonne_miles(cargo, distances, rows):
    monthly = distance.tonne_miles(cargo, distances)
    assert rows(monthly) == [
        (2023, 1, 4.0, 7000.0, 1750.0, date(2023, 1, 1)),
        (2023, 2, 4.0, 13000.0, 3250.0, date(2023, 2, 1)),
        (2026, 1, 0.0, 0.0, None, date(2026, 1, 1)),
    ]
    assert distance.tonne_miles(cargo, distances, end_date="2025-12-01").count() == 2


def test_before_after(cargo, distances):
    got = distance.before_after(distance.tonne_miles(cargo, distances)).first().asDict()
    assert (got["months_before"], got["months_after"]) == (1, 2)
    assert (got["tonne_nm_before"], got["tonne_nm_after"]) == (7000.0, 6500.0)
    assert got["increase_pct"] == pytest.approx(-100 / 14)
    assert (got["avg_distance_before"], got["avg_distance_after"]) == (1750.0, 3250.0)
    assert (got["pooled_distance_before"], got["pooled_distance_after"]) == (1750.0, 3250.0)
    cut = distance.tonne_miles(cargo, distances, end_date="2025-12-01")
    assert distance.before_after(cut).first().increase_pct == pytest.approx(600 / 7)


def test_mean_of_months_differs_from_pooled(flows, distances):
    df = flows((2023, 1, 1, 9, 9000.0), (2022, 12, 1, 8, 1000.0))
    got = distance.before_after(distance.tonne_miles(df, distances)).first()
    assert got.avg_distance_before == 2500.0
    assert got.pooled_distance_before == 1300.0
    assert (got.months_after, got.tonne_nm_after, got.increase_pct) == (0, None, None)


def test_confidence(cargo, distances, rows):
    assert rows(distance.confidence_coverage(cargo, distances)) == [
        ("estimated", 4.0, pytest.approx(400 / 13)),
        ("none", 5.0, pytest.approx(500 / 13)),
        ("verified", 4.0, pytest.approx(400 / 13)),
    ]


def test_flows_mart(cargo, rows):
    mart = marts.flows_mart(cargo)
    assert mart.columns == [*marts.FLOW_COLUMNS, "Date"]
    assert mart.count() == 5
    assert {r.isExtraZone for r in mart.collect()} == {True}
    calendar = dims.date_dim(cargo.sparkSession, "2019-01-01", "2025-12-01")
    assert quality.orphan_dates(mart, calendar).count() == 0
    assert rows(quality.orphan_dates(marts.flows_mart(cargo, end_date=None), calendar)) == [(date(2026, 1, 1),)]


def test_zone_of_a_cut_mart_is_that_of_all_flows(flows, rows):
    df = flows((2025, 1, 1, 2, 1.0), (2026, 1, 2, 9, 1.0))
    assert rows(marts.flows_mart(df), "partnerCode", "isExtraZone") == [(2, False)]


def test_csv_round_trip(cargo, distances, tmp_path, rows):
    share = shares.market_share(cargo, 1)
    monthly = distance.tonne_miles(cargo, distances)
    tables.write_csv(share, str(tmp_path / "shares"))
    again = tables.read_csv(cargo.sparkSession, str(tmp_path / "shares"), MARKET_SHARES)
    assert rows(again) == rows(share)
    marts.export(
        {"market_shares": marts.market_shares_mart(again), "tonne_miles": marts.tonne_miles_mart(monthly)},
        str(tmp_path / "marts"),
    )
    header = next((tmp_path / "marts" / "tonne_miles").glob("*.csv")).read_text().splitlines()[0]
    assert header == "refYear,refMonth,extra_zone_tonnes,tonne_nm,avg_distance_nm,Date"
    assert "Date" in marts.market_shares_mart(again).columns
