from datetime import date

import pytest

from tradeflow.operators import dims, enrich, quality
from tradeflow.schemas import PARTNER_AREA, PARTNER_DIM, REPORTER_DIM
from tradeflow.sources import tables
from tradeflow.sources.fixed_values import DISTANCES, REPORTERS


def test_special_partners(spark, rows):
    areas = spark.createDataFrame(
        [
            (568, "Other Europe, nes", "X1", "X1"),
            (472, "Africa, NES, not specified", None, None),  # contains, any case
            (837, "Bunkers", "X2", "XX2"),
            (838, "Free Zones", None, None),
            (839, "Special Categories", None, None),
            (412, "Kosovo", None, None),
            (999, None, None, None),  # unnamed: not special
            (10, "Japanesia", None, None),
        ],
        PARTNER_AREA,
    )
    dim = dims.partner_dim(areas)
    assert dim.columns == PARTNER_DIM.fieldNames()
    special = {r.partnerCode for r in dim.collect() if r.is_special_partner}
    assert special == {568, 472, 837, 838, 839}
    assert dim.filter("is_special_partner IS NULL").count() == 0


def test_fixed_dimensions(spark):
    assert tables.reporters(spark).count() == len(REPORTERS) == 30
    assert tables.distances(spark).count() == len(DISTANCES) == 18
    confidences = {r.confidence for r in tables.distances(spark).collect()}
    assert confidences == {"verified", "verified_proxy_port", "estimated"}


def test_date_dim(spark, flows, rows):
    whole = dims.date_dim(spark, "2019-01-01", "2025-12-01")
    assert whole.count() == 84
    first = whole.orderBy("Date").first()
    assert tuple(first) == (date(2019, 1, 1), 2019, 1, "Jan")
    gappy = flows((2020, 11, 1, 2, 1.0), (2021, 2, 1, 2, 1.0))
    assert rows(dims.date_dim_of(gappy), "Year", "Month") == [(2020, 11), (2020, 12), (2021, 1), (2021, 2)]


@pytest.fixture
def dimensions(spark):
    partners = spark.createDataFrame([(9, "P9", "P9", "PP9", False), (8, "P8", None, None, True)], PARTNER_DIM)
    reporters = spark.createDataFrame([(1, "ONE")], REPORTER_DIM)
    return partners, reporters


DETAIL = "refYear int, refMonth int, reporterCode int, partnerCode int, netWgt double"


def test_enrich_keeps_every_row(spark, rows, dimensions):
    detail = spark.createDataFrame([(2020, 1, 1, 9, 3000.0), (2020, 1, 1, 8, 1000.0), (2020, 1, 2, 7, 6.0)], DETAIL)
    named = enrich.enrich(detail, *dimensions)
    assert rows(named, "partnerCode", "partnerName", "reporterName") == [
        (7, None, None), (8, "P8", "ONE"), (9, "P9", "ONE"),
    ]
    assert rows(quality.unmatched_codes(detail, dimensions[0], "partnerCode")) == [(7,)]
    with pytest.raises(quality.DataQualityError, match="unmatched codes.*partnerCode"):
        enrich.check_dimensions(detail, *dimensions)


def test_duplicate_partner_code_is_refused(spark, dimensions):
    partners, reporters = dimensions
    detail = spark.createDataFrame([(2020, 1, 1, 9, 3.0)], DETAIL)
    enrich.check_dimensions(detail, partners, reporters)
    with pytest.raises(quality.DataQualityError, match="duplicate partner codes"):
        enrich.check_dimensions(detail, partners.union(partners), reporters)


def test_special_share(flows, rows):
    df = flows((2020, 1, 1, 9, 3000.0), (2020, 1, 1, 8, 1000.0, True), (2020, 1, 1, 7, None))
    assert rows(enrich.special_share(df)) == [(4.0, 1.0, 25.0)]
    assert rows(enrich.special_share(flows((2020, 1, 1, 9, 0.0)))) == [(0.0, 0.0, None)]
