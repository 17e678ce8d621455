import pytest
from pyspark.sql import types as T

from tradeflow.operators import clean, completeness, quality
from tradeflow.schemas import RAW_RECORD
from tradeflow.sources import landing

ENVELOPES = T.StructType(
    [
        T.StructField("iso3", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("data", T.ArrayType(RAW_RECORD)),
        T.StructField("unreadable", T.BooleanType()),
    ]
)


def raw(spark, *lines):
    """(year, month, reporter, partner, weight) plus optional overrides as a dict."""
    out = []
    for y, m, r, p, w, *rest in lines:
        line = {
            "refYear": y, "refMonth": m, "reporterCode": r, "partnerCode": p, "partner2Code": 0,
            "netWgt": w, "primaryValue": 1.0, "isNetWgtEstimated": False, "motCode": 0,
            "customsCode": "C00", "flowCode": "M", "cmdCode": "271019", **(rest[0] if rest else {}),
        }
        out.append(tuple(line[c] for c in RAW_RECORD.fieldNames()))
    return spark.createDataFrame(out, RAW_RECORD)


def test_breakdowns_are_dropped_and_counted(spark, rows):
    df = raw(
        spark,
        (2020, 1, 1, 9, 5.0),
        (2020, 1, 1, 9, 3.0, {"motCode": 2000}),
        (2020, 1, 1, 9, 2.0, {"customsCode": "C01"}),
        (2020, 1, 1, 9, 1.0, {"partner2Code": 7}),
        (2020, 1, 1, 0, 5.0),
    )
    kept = clean.totals_only(df)
    assert kept.columns == [
        "refYear", "refMonth", "reporterCode", "partnerCode",
        "netWgt", "primaryValue", "isNetWgtEstimated",
    ]
    assert rows(kept, "partnerCode", "netWgt") == [(0, 5.0), (9, 5.0)]
    assert rows(clean.totals_summary(df)) == [(5, 2, 3)]
    assert "cmdCode" in clean.totals_only(df, ["cmdCode"]).columns
    assert rows(clean.split_detail(kept), "partnerCode") == [(9,)]
    assert rows(clean.split_world(kept), "partnerCode") == [(0,)]


def test_constant_columns(spark, rows):
    good = raw(spark, (2020, 1, 1, 9, 5.0))
    assert rows(quality.constant_violations(good)) == []
    bad = raw(spark, (2020, 1, 1, 9, 5.0, {"flowCode": "X"}), (2020, 1, 1, 8, 5.0, {"cmdCode": None}))
    assert rows(quality.constant_violations(bad)) == [("cmdCode", None, 1), ("flowCode", "X", 1)]
    assert rows(quality.constant_violations(good, {"flowCode": ["M", "X"]})) == [("flowCode", "X", 0)]


def test_enforce_raises_with_the_rows(spark):
    with pytest.raises(quality.DataQualityError, match="codes: .*'a': 7"):
        quality.enforce(spark.createDataFrame([(7,)], "a int"), "codes")
    quality.enforce(spark.createDataFrame([], "a int"), "codes")


def test_world_reconciliation(spark, rows):
    totals = clean.totals_only(
        raw(
            spark,
            (2020, 1, 1, 8, 6.0), (2020, 1, 1, 9, 3.0), (2020, 1, 1, 0, 10.0),  # gap of 1
            (2020, 2, 1, 8, 6.0), (2020, 2, 1, 0, 0.0),  # zero-weight World: not comparable
            (2020, 3, 1, 8, None), (2020, 3, 1, 0, 30.0),  # all-NULL detail sums to 0
            (2020, 4, 1, 0, 7.0),  # no detail
            (2020, 5, 1, 8, 7.0),  # no World
        )
    )
    monthly = quality.world_recon_monthly(totals)
    assert rows(monthly, "refMonth", "detail", "world", "gap") == [(1, 9.0, 10.0, 1.0), (3, 0.0, 30.0, 30.0)]
    assert rows(quality.world_recon(totals)) == [(2, 31.0 / 40.0 * 100, 1)]


def test_world_reconciliation_without_comparable_months(spark, rows):
    totals = clean.totals_only(raw(spark, (2020, 1, 1, 0, 0.0)))
    assert rows(quality.world_recon(totals)) == [(0, None, 1)]


def test_completeness(spark, rows):
    lines = raw(
        spark,
        (2019, 10, 56, 0, 10.0), (2019, 10, 56, 9, 9.0, {"isNetWgtEstimated": True}),
        (2019, 2, 56, 9, None, {"motCode": 10, "customsCode": "C01"}),
    ).collect()
    envelopes = spark.createDataFrame(
        [
            ("BEL", 2019, [tuple(r) for r in lines], False), ("AUT", 2019, [], False),
            ("ZZZ", 2019, [], False), ("AUT", 2020, None, True),
        ],
        ENVELOPES,
    )
    reporters = spark.createDataFrame([(40, "AUT"), (56, "BEL")], "reporterCode int, reporterName string")
    report = completeness.completeness(envelopes, landing.expected_grid(reporters, [2019, 2020]))
    assert rows(report) == [
        ("AUT", 2019, True, False, 0, 0, "", 0, False, None, 0, 0, "", ""),
        ("AUT", 2020, True, True, 0, 0, "", 0, False, None, 0, 0, "", ""),
        ("BEL", 2019, True, False, 3, 2, "2,10", 2, True, 10.0, 1, 1, "0,10", "C00,C01"),
        ("BEL", 2020, False) + (None,) * 11,
    ]
    assert rows(completeness.unreadable_files(report)) == [("AUT", 2020)]
    assert rows(completeness.empty_files(report)) == [("AUT", 2019)]
    assert rows(completeness.partial_years(report)) == [("BEL", 2019, 2, "2,10")]
    assert rows(completeness.gap_files(report)) == [("BEL", 2019, 10.0)]
    assert rows(completeness.gap_files(report, 10.0)) == []
    assert rows(completeness.code_lists(report)) == [
        ("customs_codes", ""), ("customs_codes", "C00,C01"), ("mot_codes", ""), ("mot_codes", "0,10"),
    ]
    assert rows(completeness.file_counts(report)) == [(4, 3)]


def test_reporters_per_month(flows, rows):
    df = flows((2020, 1, 1, 9, 1.0), (2020, 1, 1, 8, 1.0), (2020, 1, 2, 9, 0.0), (2020, 2, 2, 9, 1.0))
    assert rows(quality.reporters_per_month(df), "refMonth", "n_reporters") == [(1, 2), (2, 1)]


def test_a_year_may_land_in_several_envelopes(spark, rows):
    lines = [tuple(r) for r in raw(spark, (2019, 1, 56, 9, 4.0), (2019, 2, 56, 9, 4.0), (2019, 2, 56, 0, 10.0)).collect()]
    grid = landing.expected_grid(
        spark.createDataFrame([(56, "BEL")], "reporterCode int, reporterName string"), [2019]
    )
    whole = spark.createDataFrame([("BEL", 2019, lines, False)], ENVELOPES)
    split = spark.createDataFrame([("BEL", 2019, lines[:1], False), ("BEL", 2019, [], False), ("BEL", 2019, lines[1:], False)], ENVELOPES)
    report = rows(completeness.completeness(split, grid))
    assert report == rows(completeness.completeness(whole, grid))
    assert report[0][4:6] == (3, 2)
    assert rows(landing.stack_raw(split)) == rows(landing.stack_raw(whole))
