"""The driver's entry: complete where everything is installed, and whole without the rest."""

import builtins
import sys

import __spark_entry__
from workload.queries import QUERIES


def test_all_queries_of_the_library_are_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_a_missing_library_costs_its_own_queries_alone(monkeypatch):
    real = builtins.__import__

    def missing(name, *args, **kwargs):
        if name.split(".")[0] in ("xxhash", "sentencepiece", "tokenizers"):
            raise ImportError(name)
        return real(name, *args, **kwargs)

    for name in list(sys.modules):
        if name.startswith(("tradeflow.llm", "corpus_pipeline", "xxhash", "sentencepiece", "tokenizers")):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", missing)
    assert set(__spark_entry__.queries()) == set(QUERIES)
    assert set(__spark_entry__.oracle_sql()) <= set(QUERIES)
