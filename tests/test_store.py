"""Tables that are replaced while others read them."""

import json
import os

import pytest

from tradeflow.plans.log import ConflictError, Log
from tradeflow.plans.store import Store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def numbers(spark, *ns):
    return spark.createDataFrame([(n, n % 2) for n in ns], "n int, odd int")


def test_versions(spark, store, rows):
    first = store.put("t", numbers(spark, 1, 2), ["odd"])
    schema = first.schema
    second = store.put("t", numbers(spark, 3))
    assert rows(second, "n") == [(3,)] and rows(first, "n") == [(1,), (2,)]  # a reader keeps its version
    assert rows(store.get("t", schema), "n") == [(3,)]
    assert rows(store.get("t", schema, version=1), "n") == [(1,), (2,)]
    assert store.has("t") and not store.has("u")
    with pytest.raises(KeyError, match="no table u"):
        store.get("u", schema)


def test_two_names_switch_together(spark, store, rows):
    schema = numbers(spark).schema
    store.put("t", numbers(spark, 1))
    store.put("u", numbers(spark, 1))
    other = Store(spark, store.root)
    with store.change():
        store.put("t", numbers(spark, 2))
        assert rows(other.get("t", schema), "n") == [(1,)] and rows(store.get("t", schema), "n") == [(2,)]
        store.put("u", numbers(spark, 2))
        store.note("built_from", 7)
        assert rows(other.get("u", schema), "n") == [(1,)]
    assert rows(other.get("t", schema), "n") == rows(other.get("u", schema), "n") == [(2,)]
    assert other.state()["notes"] == {"built_from": 7}


def test_a_change_that_dies_changes_nothing(spark, store, rows):
    schema = numbers(spark).schema
    store.put("t", numbers(spark, 1))
    with pytest.raises(ZeroDivisionError), store.change():
        store.put("t", numbers(spark, 2))
        store.put("u", numbers(spark, 2))
        raise ZeroDivisionError
    for reader in (store, Store(spark, store.root)):
        assert rows(reader.get("t", schema), "n") == [(1,)] and not reader.has("u")


def test_a_write_that_dies_leaves_the_table(spark, store, rows):
    schema = numbers(spark).schema
    store.put("t", numbers(spark, 1))
    broken = spark.range(3).selectExpr("CAST(raise_error('stop') AS int) AS n", "0 AS odd")
    with pytest.raises(Exception, match="stop"):
        store.put("t", broken)
    assert rows(store.get("t", schema), "n") == [(1,)]


def test_the_second_of_two_writers_fails(spark, store, rows):
    schema = numbers(spark).schema
    other = Store(spark, store.root)
    with pytest.raises(ConflictError), store.change():
        store.put("t", numbers(spark, 1))
        other.put("t", numbers(spark, 2))
    assert rows(store.get("t", schema), "n") == [(2,)]


def test_log_is_exclusive_and_ignores_drafts(spark, tmp_path):
    log = Log(spark, str(tmp_path / "log"))
    assert log.last() == (0, {})
    log.commit(1, {"é": [1]})
    assert log.last() == (1, {"é": [1]})
    (tmp_path / "log" / ".x.draft").write_text('{"half')
    assert log.last()[0] == 1
    with pytest.raises(ConflictError):
        log.commit(1, {})
    # Another writer between the look and the rename.
    log.numbers = list
    with pytest.raises(ConflictError):
        log.commit(1, {})
    assert json.loads((tmp_path / "log" / "0000000001.json").read_text()) == {"é": [1]}


def test_vacuum(spark, store, rows):
    schema = numbers(spark).schema
    for n in range(4):
        store.put("t", numbers(spark, n))
    store.put("u", numbers(spark, 9))
    gone = store.vacuum(keep=2)
    assert len(gone) == 3 and not any(os.path.exists(p) for p in gone)
    assert rows(store.get("t", schema), "n") == [(3,)] and rows(store.get("u", schema), "n") == [(9,)]
    assert store.log.numbers() == [4, 5]


def test_units_are_replaced_in_pieces(spark, store, rows, monkeypatch):
    """New rows of some units; others, and rows without one, stay where they are."""
    table = lambda *found: spark.createDataFrame(list(found), "unit int, v int")
    schema = table().schema
    store.put("t", table((1, 1), (2, 1), (None, 1), (3, 1)))
    folder = store.pieces("t")[0]["folder"]
    written = store.replace_units("t", table((1, 2), (1, 3)), "unit", [1, 9])
    assert rows(written) == [(1, 2), (1, 3)]
    assert rows(store.get("t", schema)) == [(1, 2), (1, 3), (2, 1), (3, 1), (None, 1)]
    assert [p["folder"] for p in store.pieces("t")][0] == folder and len(store.pieces("t")) == 2
    store.replace_units("t", table(), "unit", [2])  # a unit that has no rows any more
    store.replace_units("t", table((1, 4)), "unit", [1])
    assert rows(store.get("t", schema)) == [(1, 4), (3, 1), (None, 1)]
    monkeypatch.setattr("tradeflow.plans.store.MOST_PIECES", 2)
    store.replace_units("t", table((3, 5)), "unit", [3])
    assert len(store.pieces("t")) == 1 and rows(store.get("t", schema)) == [(1, 4), (3, 5), (None, 1)]
    store.vacuum(keep=1)
    assert rows(store.get("t", schema)) == [(1, 4), (3, 5), (None, 1)]
