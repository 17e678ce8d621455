"""The whole job over a small landing folder."""

import json
import re

import pytest

from tradeflow import study
from tradeflow.operators.quality import DataQualityError
from tradeflow.plans import upkeep
from tradeflow.plans.store import Store
from tradeflow.sources.envelopes import QUARANTINE

RUSSIA, INDIA, BUNKERS, BELGIUM = 643, 699, 837, 56


def line(year, month, reporter, partner, weight, **changes):
    return {
        "refYear": year, "refMonth": month, "reporterCode": reporter, "partnerCode": partner,
        "partner2Code": 0, "netWgt": weight, "primaryValue": 1.0, "isNetWgtEstimated": False,
        "motCode": 0, "customsCode": "C00", "flowCode": "M", "cmdCode": "271019", **changes,
    }


@pytest.fixture(autouse=True, scope="module")
def interpreted(spark):
    """A build is dozens of plans over a few rows: compiling them would take most of the time."""
    names = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def inputs(tmp_path):
    landing, prices = tmp_path / "landing", tmp_path / "prices"
    landing.mkdir(), prices.mkdir()
    areas = {RUSSIA: "Russian Federation", INDIA: "India", BUNKERS: "Bunkers", BELGIUM: "Belgium"}
    listed = [{"PartnerCode": c, "PartnerDesc": n} for c, n in areas.items()]
    (tmp_path / "partners.json").write_text(json.dumps({"results": listed}))
    months = [f"{y}-{m:02d}" for y in range(2019, 2026) for m in range(1, 13)]
    for name, base in (("brent_usd_bbl", 60.0), ("diesel_usd_gal", 2.0)):
        points = [{"period": p, "value": base + i % 5} for i, p in enumerate(months)]
        (prices / f"eia_{name}.json").write_text(json.dumps({"response": {"data": points}}))

    def land(iso3, year, *lines):
        (landing / f"comtrade_{iso3}_{year}.json").write_text(json.dumps({"count": len(lines), "data": lines}))

    land(
        "NLD", 2022,
        line(2022, 12, 528, 0, 10_000.0), line(2022, 12, 528, RUSSIA, 9_000.0),
        line(2022, 12, 528, RUSSIA, 4_000.0, motCode=2100), line(2022, 12, 528, BUNKERS, 1_000.0),
    )
    land("NLD", 2023, line(2023, 2, 528, INDIA, 5_000.0), line(2023, 2, 528, BELGIUM, 5_000.0))
    land("BEL", 2023, line(2023, 2, 56, RUSSIA, 0.0), line(2023, 2, 56, INDIA, 15_000.0))
    return tmp_path, land


def build(spark, root):
    store = Store(spark, str(root / "store"))
    study.build_tables(spark, str(root / "landing"), str(root / "partners.json"), str(root / "prices"), store)
    return store


def test_from_landed_files_to_marts(spark, inputs, rows):
    root, land = inputs
    store = build(spark, root)
    found = study.results(spark, store)
    assert rows(found["market_shares"], "refYear", "origin", "share_pct") == [
        (2022, "India", 0.0), (2022, "Russian Federation", 100.0),
        (2023, "India", 100.0), (2023, "Russian Federation", 0.0),
    ]
    speed = {r.origin: r for r in found["transition_speed"].collect()}["Russian Federation"]
    assert (speed.baseline_share_pct, speed.months_elapsed) == (100.0, 0)
    change = found["before_after"].first()
    assert (change.tonne_nm_before, change.tonne_nm_after) == (9.0 * 1532, 20.0 * 7173)
    assert rows(found["hub_ratio"], "reporterName", "intra_zone_pct") == [("BEL", 0.0), ("NLD", 25.0)]
    for df in found.values():
        df.collect()

    study.register_views(spark, store)
    written = spark.sql("""
        WITH monthly AS (
          SELECT refYear, refMonth, partnerName AS origin, sum(netWgt) / 1000 AS tonnes FROM flows
          WHERE is_special_partner = false AND partnerCode NOT IN (SELECT reporterCode FROM zone)
          GROUP BY 1, 2, 3)
        SELECT *, try_divide(tonnes, sum(tonnes) OVER (PARTITION BY refYear, refMonth)) * 100 AS share_pct
        FROM monthly""")
    assert rows(written) == rows(found["market_shares"], *written.columns)
    assert spark.table("crack_spread").count() == spark.table("eia_prices").count() == 84
    assert spark.table("distances").count() == 18

    study.main(["export", "--store", store.root, "--out", str(root / "out")])
    names = {p.name for p in (root / "out" / "marts").iterdir()}
    assert names == {"flows", "date_dim", "price_flow_monthly", "distances", "market_shares", "tonne_miles"}
    assert {p.name for p in (root / "out" / "results").iterdir()} == set(found)

    land("BEL", 2024, line(2024, 1, 56, INDIA, 1_000.0))
    again = build(spark, root)
    assert rows(study.results(spark, again)["reporters_per_month"], "refYear", "n_reporters") == [
        (2022, 1), (2023, 2), (2024, 1),
    ]
    gaps = study.missing_files(spark, str(root / "landing"), range(2022, 2025))
    assert gaps.count() == 30 * 3 - 4


def read_csv(folder):
    return [row.split(",") for part in sorted(folder.glob("*.csv")) for row in part.read_text().splitlines()[1:]]


def test_checks_and_order_of_exports(spark, inputs):
    root, land = inputs
    land("AUT", 2022)
    store = build(spark, root)
    study.main(["check", "--landing", str(root / "landing"), "--store", store.root, "--out", str(root / "out")])
    folder = root / "out" / "checks"
    assert read_csv(folder / "empty_files") == [["AUT", "2022"]]
    report = read_csv(folder / "completeness")
    assert len(report) == 240 and [r[:2] for r in report] == sorted(r[:2] for r in report)
    assert len(read_csv(folder / "missing_files")) == 240 - 4
    assert read_csv(folder / "unreadable_files") == []
    assert read_csv(folder / "world_reconciliation") == [["1", "0.0", "0"]]
    assert read_csv(folder / "zero_fill")[0][:1] == ["6"]
    study.main(["export", "--store", store.root, "--out", str(root / "out")])
    months = [tuple(map(int, r[:2])) for r in read_csv(root / "out" / "marts" / "flows")]
    assert months == sorted(months) and len(months) > 6


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda p: [], "months without prices"),
        (lambda p: [q for q in p if q["period"] != "2020-05"], "missing prices"),
        (lambda p: [*p, {"period": "2020-05", "value": 70.0}], "repeated prices"),
    ],
)
def test_build_refuses_odd_prices(spark, inputs, change, message):
    root, _ = inputs
    for name in ("brent_usd_bbl", "diesel_usd_gal")[: 2 if message.startswith("months") else 1]:
        path = root / "prices" / f"eia_{name}.json"
        points = change(json.loads(path.read_text())["response"]["data"])
        path.write_text(json.dumps({"response": {"data": points}}))
    with pytest.raises(DataQualityError, match=message):
        build(spark, root)


def test_partitioned_layout_in_the_job(spark, inputs, rows):
    root, _ = inputs
    other = root / "other" / "iso3=NLD" / "year=2023"
    other.mkdir(parents=True)
    lines = [line(2023, 2, 528, INDIA, 5.0), line(2023, 3, 528, RUSSIA, 7.0)]
    (other / "part.json").write_text("\n".join(json.dumps({"count": 1, "data": [x]}) for x in lines))
    store = Store(spark, str(root / "store"))
    paths = ["--landing", str(root / "other"), "--partners", str(root / "partners.json"), "--prices", str(root / "prices")]
    study.main(["build", *paths, "--store", store.root, "--layout", "partitioned", "--lines"])
    flows = store.get("flows", study.flows_schema())
    assert rows(flows.filter("netWgt > 0"), "refMonth", "netWgt") == [(2, 5.0), (3, 7.0)]


def test_build_refuses_an_unknown_partner(spark, inputs):
    root, land = inputs
    land("FRA", 2023, line(2023, 1, 251, 999, 1.0))
    with pytest.raises(DataQualityError, match="unmatched codes.*partnerCode.*999"):
        build(spark, root)


def test_build_refuses_another_commodity(spark, inputs):
    root, land = inputs
    land("FRA", 2023, line(2023, 1, 251, RUSSIA, 1.0, cmdCode="270900"))
    with pytest.raises(DataQualityError, match="constant columns.*270900"):
        build(spark, root)


def test_two_commodities_at_once(spark, inputs, rows):
    root, land = inputs
    land(
        "FRA", 2023,
        line(2023, 2, 251, RUSSIA, 3_000.0, cmdCode="270900"), line(2023, 2, 251, INDIA, 1_000.0, cmdCode="270900"),
    )
    store = Store(spark, str(root / "store"))
    paths = ["--landing", str(root / "landing"), "--partners", str(root / "partners.json"), "--prices", str(root / "prices")]
    study.main(["build", *paths, "--store", store.root, "--keys", "cmdCode"])
    shares = study.results(spark, store, ["cmdCode"])["market_shares"]
    assert rows(shares.filter("refYear = 2023"), "cmdCode", "origin", "share_pct") == [
        ("270900", "India", 25.0), ("270900", "Russian Federation", 75.0),
        ("271019", "India", 100.0), ("271019", "Russian Federation", 0.0),
    ]
    study.main(["export", "--store", store.root, "--out", str(root / "out"), "--keys", "cmdCode"])
    header = next((root / "out" / "marts" / "flows").glob("*.csv")).read_text().splitlines()[0]
    assert header.startswith("cmdCode,refYear,") and header.endswith(",Date")


TABLES = {
    "flows": study.flows_schema(), "zone": study.ZONE, "extra_zone_monthly": study.rollup_schema(),
    "origin_cells": upkeep.cells_schema(),
}


def same_as_a_full_build(spark, root, rows):
    """The tables of the store that was kept up to date, against those of a new one."""
    kept = Store(spark, str(root / "store"))
    fresh = Store(spark, str(root / f"fresh-{len(list(root.iterdir()))}"))
    study.build_tables(spark, str(root / "landing"), str(root / "partners.json"), str(root / "prices"), fresh)
    for name, schema in TABLES.items():
        assert rows(kept.get(name, schema)) == rows(fresh.get(name, schema)), name


def land_many(land):
    """Enough reporters that one of them is a small part."""
    for code, iso3 in ((40, "AUT"), (251, "FRA"), (276, "DEU"), (724, "ESP")):
        land(iso3, 2022, line(2022, 11, code, RUSSIA, 3_000.1), line(2022, 12, code, INDIA, None))


def test_one_relanded_file_rewrites_one_reporter(spark, inputs, rows):
    root, land = inputs
    land_many(land)
    store = build(spark, root)
    whole = store.pieces("flows")
    assert len(whole) == 1
    land("FRA", 2023, line(2023, 1, 251, BELGIUM, 7.7), line(2023, 2, 251, INDIA, 0.1))
    store = build(spark, root)
    pieces = store.pieces("flows")
    assert pieces[0]["folder"] == whole[0]["folder"] and pieces[0]["lost"] == [251] and len(pieces) == 2
    piece = spark.read.parquet(f"{store.path('flows')}/{pieces[1]['folder']}")
    assert {r[0] for r in piece.select("reporterCode").collect()} == {251}
    same_as_a_full_build(spark, root, rows)

    version = store.log.last()[0]
    build(spark, root)  # nothing new: no table but prices is written
    assert store.pieces("flows") == pieces and store.pieces("origin_cells") == store.pieces("origin_cells", version)

    # A reporter leaves the zone, so its country counts as an origin of the others from now on.
    (root / "landing" / "comtrade_BEL_2023.json").unlink()
    store = build(spark, root)
    assert 56 not in [r[0] for r in store.get("zone", study.ZONE).collect()]
    assert ("Belgium", 7.7) in rows(store.get("extra_zone_monthly", study.rollup_schema()), "partnerName", "netWgt")
    same_as_a_full_build(spark, root, rows)

    before = {name: rows(store.get(name, schema)) for name, schema in TABLES.items()}
    study.main(["compact", "--store", store.root])
    assert len(store.pieces("flows")) == 1
    assert {name: rows(store.get(name, schema)) for name, schema in TABLES.items()} == before
    land("ESP", 2022)
    build(spark, root)
    same_as_a_full_build(spark, root, rows)


def test_another_partner_list_builds_anew(spark, inputs, rows):
    root, land = inputs
    land_many(land)
    build(spark, root)
    listed = json.loads((root / "partners.json").read_text())
    listed["results"][0]["PartnerDesc"] = "Russia"
    (root / "partners.json").write_text(json.dumps(listed))
    store = build(spark, root)
    assert len(store.pieces("flows")) == 1
    same_as_a_full_build(spark, root, rows)


@pytest.mark.parametrize("step", ["origin_month_of", "origin_cells"])
def test_a_build_that_dies_leaves_all_tables(spark, inputs, rows, monkeypatch, step):
    root, land = inputs
    land_many(land)
    store = build(spark, root)
    before = {name: rows(store.get(name, schema)) for name, schema in TABLES.items()}
    land("FRA", 2023, line(2023, 1, 251, BELGIUM, 7.7))
    with monkeypatch.context() as m:
        m.setattr(upkeep, step, None)
        with pytest.raises(TypeError):
            build(spark, root)
    assert {name: rows(store.get(name, schema)) for name, schema in TABLES.items()} == before
    build(spark, root)
    same_as_a_full_build(spark, root, rows)


def test_a_refused_line_leaves_all_tables(spark, inputs, rows):
    root, land = inputs
    land_many(land)
    store = build(spark, root)
    before = rows(store.get("flows", study.flows_schema()))
    land("FRA", 2023, line(2023, 1, 251, 999, 1.0))
    with pytest.raises(DataQualityError, match="unmatched codes.*partnerCode.*999"):
        build(spark, root)
    land("FRA", 2023, line(2023, 1, 251, RUSSIA, 1.0, flowCode="X"))
    with pytest.raises(DataQualityError, match="constant columns.*flowCode.*X"):
        build(spark, root)
    assert rows(store.get("flows", study.flows_schema())) == before
    land("FRA", 2023)
    build(spark, root)
    same_as_a_full_build(spark, root, rows)


@pytest.mark.parametrize(
    ("file", "text"),
    [
        ("prices/eia_brent_usd_bbl.json", '{"response": {"data": [{"period": "2020-05", "value": "70.5"}]}}'),
        ("partners.json", '{"results": [{"Partner'),  # cut short
    ],
)
def test_unreadable_prices_and_partners_are_named(spark, inputs, file, text):
    root, _ = inputs
    (root / file).write_text(text)
    with pytest.raises(DataQualityError, match=f"unreadable (price files|partner list).*{file.split('/')[-1]}"):
        build(spark, root)
    found = Store(spark, str(root / "store")).get("quarantine", QUARANTINE).collect()
    assert [(r.path.split("/")[-1], r.record) for r in found] == [(file.split("/")[-1], text)]


def test_a_build_reads_raw_twice(spark, inputs):
    root, land = inputs
    land_many(land)
    runs = spark._jsparkSession.sharedState().statusStore()
    before = runs.executionsCount()
    build(spark, root)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    found = runs.executionsList()
    n = 0
    for i in range(before, found.size()):
        plan = found.apply(i).physicalPlanDescription()
        ran = plan.split("+- == Initial Plan ==")[0]
        for step in re.findall(r"^\((\d+)\) Scan parquet.*\nOutput.*motCode#", plan, re.M):
            n += f"({step})" in ran
    assert n == 2
