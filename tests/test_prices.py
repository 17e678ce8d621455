import math

import pytest

from tradeflow.operators import prices, quality


def monthly(spark, *points):
    """(year, month, volume, price)"""
    return spark.createDataFrame(
        list(points),
        "refYear int, refMonth int, extra_zone_tonnes double, crack_spread_usd_bbl double",
    )


def pandas_like(pairs):
    """Plain Pearson over complete pairs."""
    pairs = [(a, b) for a, b in pairs if a is not None and b is not None]
    if len(pairs) < 2:
        return None
    n = len(pairs)
    ma, mb = sum(a for a, _ in pairs) / n, sum(b for _, b in pairs) / n
    cov = sum((a - ma) * (b - mb) for a, b in pairs)
    va, vb = sum((a - ma) ** 2 for a, _ in pairs), sum((b - mb) ** 2 for _, b in pairs)
    return cov / math.sqrt(va * vb) if va and vb else None


def test_tidy_prices_keep_unmatched_months(spark, rows):
    points = spark.createDataFrame(
        [
            ("brent_usd_bbl", "2019-01", 60.0), ("brent_usd_bbl", "2019-02", 61.0),
            ("diesel_usd_gal", "2019-02", 2.0), ("diesel_usd_gal", "2019-03", 3.0),
            ("brent_usd_bbl", "2018-12", 1.0), ("diesel_usd_gal", "2026-01", 1.0),  # outside the bounds
            ("other", "2019-04", 9.0),
        ],
        "series string, period string, value double",
    )
    tidy = prices.tidy_prices(points)
    assert rows(tidy, "refYear", "refMonth", "brent_usd_bbl", "diesel_usd_gal") == [
        (2019, 1, 60.0, None), (2019, 2, 61.0, 2.0), (2019, 3, None, 3.0),
    ]
    assert rows(quality.missing_prices(tidy, prices.PRICE_SERIES)) == [
        (2019, 1, "diesel_usd_gal"), (2019, 3, "brent_usd_bbl"),
    ]
    spread = prices.crack_spread(tidy)
    assert rows(spread, "refMonth", "diesel_usd_bbl", "crack_spread_usd_bbl") == [
        (1, None, None), (2, 84.0, 23.0), (3, 126.0, None),
    ]
    assert rows(prices.crack_spread_window(spread, "2019-02-01", "2019-02-01")) == [(2019, 2, 23.0)]
    prices.crack_spread_view(tidy)
    assert spark.table("crack_spread").count() == 3


def test_price_flow_keeps_months_in_both(spark, flows, rows):
    spread = spark.createDataFrame([(2020, 1, 10.0), (2020, 3, 30.0)], "refYear int, refMonth int, crack_spread_usd_bbl double")
    df = flows((2020, 1, 1, 9, 1000.0), (2020, 1, 2, 9, 500.0), (2020, 2, 1, 9, 1.0))
    assert rows(prices.price_flow(df, spread), "refMonth", "extra_zone_tonnes", "crack_spread_usd_bbl") == [(1, 1.5, 10.0)]


def test_constant_side_gives_null(spark, rows):
    flat = monthly(spark, (2020, 1, 1.0, 0.1), (2020, 2, 2.0, 0.1), (2020, 3, 3.0, 0.1))
    assert {r.r for r in prices.lag_correlation(flat).collect()} == {None}
    single = monthly(spark, (2020, 1, 1.0, 0.1))
    assert rows(prices.lag_correlation(single, max_lag=0)) == [(0, None, 1)]
    assert rows(prices.best_lag(prices.lag_correlation(flat))) == [(None, None, None, None)]


@pytest.fixture
def gappy(spark):
    volume = [5.0, 7.0, None, 2.0, 9.0, 4.0, 6.0, 1.0]
    price = [1.0, 4.0, 2.0, 8.0, None, 3.0, 7.0, 5.0]
    months = [1, 2, 4, 5, 6, 8, 9, 10]
    return monthly(spark, *[(2020, m, v, p) for m, v, p in zip(months, volume, price)]), months, volume, price


@pytest.mark.parametrize("changes", [False, True])
def test_lag_counts_rows(gappy, changes):
    df, _, x, y = gappy
    if changes:
        x = [None] + [None if a is None or b is None else b - a for a, b in zip(x, x[1:])]
        y = [None] + [None if a is None or b is None else b - a for a, b in zip(y, y[1:])]
    for row in prices.lag_correlation(df, max_lag=3, changes=changes).collect():
        pairs = list(zip(x[row.lag:], y[: len(y) - row.lag]))
        assert row.r == pytest.approx(pandas_like(pairs))
        assert row.n == sum(a is not None and b is not None for a, b in pairs)


@pytest.mark.parametrize("changes", [False, True])
def test_lag_counts_months(gappy, changes):
    df, months, x, y = gappy

    def at(values, m):
        return values[months.index(m)] if m in months else None

    def step(values, m):
        if not changes:
            return at(values, m)
        a, b = at(values, m - 1), at(values, m)
        return None if a is None or b is None or m not in months else b - a

    for row in prices.lag_correlation(df, max_lag=3, changes=changes, calendar=True).collect():
        pairs = [(step(x, m), step(y, m - row.lag)) for m in months]
        assert row.r == pytest.approx(pandas_like(pairs))


def test_best_lag_signed_and_absolute(spark, rows):
    fits = spark.createDataFrame(
        [(0, 0.1, 9), (1, 0.3, 9), (2, 0.3, 9), (3, -0.5, 9), (4, None, 1)], "lag int, r double, n long"
    )
    assert rows(prices.best_lag(fits)) == [(1, 0.3, 3, 0.5)]


def test_lags_per_key(spark):
    points = [("a", 2020, m, float(m), float(m)) for m in range(1, 6)]
    points += [("b", 2020, m, float(m), float(-m)) for m in range(1, 6)]
    df = spark.createDataFrame(
        points, "k string, refYear int, refMonth int, extra_zone_tonnes double, crack_spread_usd_bbl double"
    )
    got = {(r.k, r.lag): r.r for r in prices.lag_correlation(df, max_lag=1, keys=["k"]).collect()}
    assert got == {("a", 0): pytest.approx(1), ("a", 1): pytest.approx(1), ("b", 0): pytest.approx(-1), ("b", 1): pytest.approx(-1)}
