import json
import os
from types import SimpleNamespace

import pytest

from tradeflow.operators import completeness, dims
from tradeflow.operators.quality import DataQualityError
from tradeflow.plans.store import Store, shared_folder
from tradeflow.schemas import RAW_RECORD
from tradeflow.sources import landing, reference, tables
from tradeflow.streaming import ingest

RECORD = {
    "refYear": 2020, "refMonth": 1, "reporterCode": 56, "partnerCode": 9, "partner2Code": 0,
    "netWgt": 2.5, "primaryValue": 1, "isNetWgtEstimated": False, "motCode": 0,
    "customsCode": "C00", "flowCode": "M", "cmdCode": "271019",
    "aggrLevel": 6, "legacyEstimationFlag": "not kept",
}


def land(folder, iso3, year, *records, indent=None):
    payload = {"count": len(records), "data": [{**RECORD, "refYear": year, **r} for r in records]}
    (folder / f"comtrade_{iso3}_{year}.json").write_text(json.dumps(payload, indent=indent))


@pytest.fixture
def folder(tmp_path):
    where = tmp_path / "landing"
    where.mkdir()
    land(where, "BEL", 2020, {}, {"netWgt": None, "refMonth": 2}, indent=2)
    land(where, "AUT", 2020)
    (where / "notes.json").write_text('{"data": [{"refYear": 1}]}')
    (where / "eia_x.json").write_text("{}")
    return where


def test_stack_skips_empty_and_foreign_files(spark, folder, rows):
    envelopes = landing.read_envelopes(spark, str(folder))
    assert rows(envelopes, "iso3", "year") == [("AUT", 2020), ("BEL", 2020)]
    raw = landing.stack_raw(envelopes)
    assert raw.schema.fieldNames() == RAW_RECORD.fieldNames()
    assert rows(raw, "refMonth", "netWgt") == [(1, 2.5), (2, None)]


def test_missing_data_member(spark, tmp_path):
    (tmp_path / "comtrade_BEL_2020.json").write_text('{"count": 0}')
    envelopes = landing.read_envelopes(spark, str(tmp_path))
    assert envelopes.count() == 1 and landing.stack_raw(envelopes).count() == 0


def test_landing_gaps(spark, folder, rows):
    reporters = tables.reporters(spark).filter("reporterName IN ('AUT', 'BEL')")
    grid = landing.expected_grid(reporters, [2020, 2021])
    present = landing.landed(spark, str(folder))
    assert rows(landing.landing_gaps(grid, present)) == [(40, "AUT", 2021), (56, "BEL", 2021)]


@pytest.fixture
def ingested(spark, folder, tmp_path, rows):
    table, manifest = str(tmp_path / "raw"), str(tmp_path / "manifest")

    def run(layout="named", multi_line=True):
        ingest.ingest_new_files(spark, str(folder), table, manifest, layout, multi_line)
        return rows(ingest.read_raw(spark, table, manifest), "refYear", "refMonth", "netWgt")

    return run


FIRST = [(2020, 1, 2.5), (2020, 2, None)]


def test_ingest_takes_each_file_once(ingested, folder):
    assert ingested() == FIRST
    assert ingested() == FIRST
    land(folder, "BEL", 2021, {"refMonth": 7})
    assert ingested() == [*FIRST, (2021, 7, 2.5)]


def test_ingest_sees_replaced_emptied_and_deleted_files(ingested, folder):
    ingested()
    land(folder, "AUT", 2020, {"refMonth": 9})  # was empty, landed again under its name
    assert ingested() == [*FIRST, (2020, 9, 2.5)]
    land(folder, "BEL", 2020, {"netWgt": 4.25})  # corrected
    assert ingested() == [(2020, 1, 4.25), (2020, 9, 2.5)]
    land(folder, "AUT", 2020)
    assert ingested() == [(2020, 1, 4.25)]
    (folder / "comtrade_BEL_2020.json").unlink()
    assert ingested() == []


def test_ingest_sees_that_the_last_file_is_gone(ingested, folder):
    ingested()
    for file in folder.glob("comtrade_*.json"):
        file.unlink()
    assert ingested() == [] and ingested() == []
    land(folder, "BEL", 2020, {"netWgt": 1.0})
    assert ingested() == [(2020, 1, 1.0)]


def test_ingest_of_nothing(ingested, folder):
    for file in folder.glob("comtrade_*.json"):
        file.unlink()
    assert ingested() == []


def test_manifest_grows_by_what_changed(spark, ingested, folder, tmp_path):
    for year in range(2010, 2030):
        land(folder, "FRA", year, {"refMonth": 3})
    ingested()
    manifest = str(tmp_path / "manifest")
    log = ingest._log(spark, manifest)
    assert ingest.position(spark, manifest) == 1
    land(folder, "FRA", 2015, {"refMonth": 4})
    ingested()
    ingested()  # nothing new: no entry
    assert ingest.position(spark, manifest) == 2
    change = ingest._rows(spark, manifest, [log.last()[1]["change"]]).collect()
    assert [(r.iso3, r.year, r.gone) for r in change] == [("FRA", 2015, False)]
    since = ingest.changed_since(spark, manifest, 1).collect()
    assert [tuple(r) for r in since] == [("FRA", 2015)]
    assert ingest.changed_since(spark, manifest, 2).count() == 0


def test_base_compaction_and_vacuum(spark, ingested, folder, rows, tmp_path, monkeypatch):
    """Many runs: the manifest is based anew, raw is compacted, and what is read stays the same."""
    monkeypatch.setattr(ingest, "CHECKPOINT_EVERY", 3)
    monkeypatch.setattr(ingest, "MOST_RUNS", 4)
    table, manifest = str(tmp_path / "raw"), str(tmp_path / "manifest")
    expected = {(2020, 1, 2.5), (2020, 2, None)}
    for year in range(2001, 2009):
        land(folder, "FRA", year, {"refMonth": 3})
        if year == 2006:
            (folder / "comtrade_FRA_2002.json").unlink()
            expected.discard((2002, 3, 2.5))
        expected.add((year, 3, 2.5))
        assert ingested() == sorted(expected, key=repr)
    entry = ingest._log(spark, manifest).last()[1]
    assert len(entry["changes"]) < 3 and len(entry["runs"]) <= 4
    land(folder, "FRA", 2003, {"refMonth": 5})
    ingested()
    before = rows(ingest.read_raw(spark, table, manifest))
    ingest.compact(spark, table, manifest)
    assert rows(ingest.read_raw(spark, table, manifest)) == before
    gone = ingest.vacuum(spark, table, manifest, keep=1)
    assert gone and not any(os.path.exists(p) for p in gone)
    assert rows(ingest.read_raw(spark, table, manifest)) == before
    assert len([f for f in os.listdir(table) if f.startswith("run=")]) == 1
    assert ingested() == sorted(map(lambda r: (r[0], r[1], r[5]), before), key=repr)
    assert ingest.changed_since(spark, manifest, 1) is None


def test_many_files_are_read_from_their_folder(spark, ingested, folder, monkeypatch):
    monkeypatch.setattr(ingest, "MOST_PATHS", 1)
    assert ingested() == FIRST
    land(folder, "FRA", 2021, {"refMonth": 3})
    land(folder, "DEU", 2021, {"refMonth": 4})
    assert ingested() == [*FIRST, (2021, 3, 2.5), (2021, 4, 2.5)]


def test_nested_files_are_found_alike(spark, ingested, folder, rows):
    (folder / "more").mkdir()
    land(folder / "more", "FRA", 2021, {"refMonth": 3})
    assert ingested() == [*FIRST, (2021, 3, 2.5)]
    envelopes = landing.read_envelopes(spark, str(folder))
    assert ("FRA", 2021) in rows(envelopes, "iso3", "year")


def test_ingest_takes_late_files_with_old_times(ingested, folder):
    ingested()
    land(folder, "FRA", 2021, {"refMonth": 3})
    old = os.stat(folder / "comtrade_FRA_2021.json").st_mtime - 30 * 86_400
    os.utime(folder / "comtrade_FRA_2021.json", (old, old))
    assert ingested() == [*FIRST, (2021, 3, 2.5)]


def test_killed_ingest_is_repeated_as_a_whole(spark, ingested, folder, monkeypatch):
    ingested()
    land(folder, "FRA", 2021, {"refMonth": 3})
    with monkeypatch.context() as m:
        m.setattr(ingest, "CHECKPOINT_EVERY", None)  # lines are written, the log entry is not
        with pytest.raises(Exception):  # noqa: B017, PT011
            ingested()
    assert ingested() == [*FIRST, (2021, 3, 2.5)]


@pytest.mark.parametrize(
    "text",
    ['{"count": 1, "data": [{"refYear": 2021, "ref', '{"data": [{"refYear": 2021, "netWgt": "7.0"}]}',
     '{"data": [{"refYear": 2021, "refMonth": 2.5}]}'],
)
def test_unreadable_files_are_refused(spark, ingested, folder, rows, text):
    ingested()
    (folder / "comtrade_NLD_2021.json").write_text(text)
    with pytest.raises(DataQualityError, match="unreadable files.*NLD"):
        ingested()
    reporters = tables.reporters(spark).filter("reporterName IN ('AUT', 'NLD')")
    envelopes = landing.read_envelopes(spark, str(folder))
    report = completeness.completeness(envelopes, landing.expected_grid(reporters, [2020, 2021]))
    assert rows(completeness.unreadable_files(report)) == [("NLD", 2021)]
    assert rows(completeness.empty_files(report)) == [("AUT", 2020)]
    land(folder, "NLD", 2021, {"refMonth": 5})
    assert ingested() == [*FIRST, (2021, 5, 2.5)]


def test_odd_file_names_are_reported(spark, ingested, folder, rows):
    (folder / "comtrade_deu_2020.json").write_text('{"data": []}')
    found = landing.odd_files(landing.landed_files(spark, str(folder)))
    assert [name.rsplit("/", 1)[1] for name, _ in rows(found)] == ["comtrade_deu_2020.json"]
    assert ("BEL", 2020) in rows(landing.landed(spark, str(folder)))
    with pytest.raises(DataQualityError, match="odd files"):
        ingested()


def test_partner_list(spark, tmp_path, rows):
    areas = [
        {"id": 1, "PartnerCode": 4, "PartnerDesc": "Afghanistan", "PartnerCodeIsoAlpha2": "AF", "PartnerCodeIsoAlpha3": "AFG"},
        {"id": 2, "PartnerCode": 837, "PartnerDesc": "Bunkers"},
    ]
    path = tmp_path / "partners.json"
    path.write_text(json.dumps({"more": False, "results": areas}))
    dim = dims.partner_dim(reference.read_partner_areas(spark, str(path)))
    assert rows(dim) == [(4, "Afghanistan", "AF", "AFG", False), (837, "Bunkers", None, None, True)]


def test_price_series(spark, tmp_path, rows):
    for name, value in (("brent_usd_bbl", 60.5), ("diesel_usd_gal", 2)):
        payload = {"response": {"total": 1, "data": [{"period": "2019-01", "value": value, "units": "$"}]}}
        (tmp_path / f"eia_{name}.json").write_text(json.dumps(payload))
    assert rows(reference.read_price_series(spark, str(tmp_path))) == [
        ("brent_usd_bbl", "2019-01", 60.5), ("diesel_usd_gal", "2019-01", 2.0),
    ]


def test_replace_table(spark, flows, rows):
    first = flows((2020, 1, 1, 9, 1.0), (2021, 1, 1, 9, 2.0))
    stored = tables.replace_table(first, "flows_t", ["refYear"])
    assert stored.columns == first.columns and rows(stored) == rows(first)
    second = flows((2022, 1, 1, 9, 3.0))
    assert rows(tables.replace_table(second, "flows_t", ["refYear"])) == rows(second)
    spark.sql("DROP VIEW flows_t")


def test_store_keeps_columns_and_prunes(spark, flows, tmp_path, rows):
    df = flows((2020, 1, 1, 9, 1.0), (2021, 1, 1, 9, 2.0))
    stored = Store(spark, str(tmp_path)).put("flows", df, ["refYear"])
    assert stored.schema == df.schema and rows(stored) == rows(df)
    cut = stored.filter("refYear <= 2020")
    cut.collect()
    assert "PartitionFilters: [isnotnull(refYear" in cut._jdf.queryExecution().toString()


def session_with(master, **settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key.replace(".", "_"), default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_is_the_sessions():
    named = {"spark_checkpoint_dir": "hdfs://shared/checkpoints/"}
    assert shared_folder(session_with("yarn", **named)) == "hdfs://shared/checkpoints"
    assert shared_folder(session_with("local[4]", **named)) == "hdfs://shared/checkpoints"


def test_no_machine_local_folder_on_a_cluster():
    assert "tradeflow-" in shared_folder(session_with("local[4]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session_with("spark://host:7077"))
