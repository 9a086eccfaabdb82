"""The driver's contract, with and without the training-data operators."""

import importlib
import sys

import __spark_entry__


def test_entry_gives_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_the_optional_part(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    bare = importlib.import_module("__spark_entry__")
    assert "plan_chunks" in bare.queries() and "pipeline" not in bare.queries()
    assert not any(name.startswith("op") and name[2:3].isdigit() for name in bare.queries())
    assert set(bare.queries()) == set(bare.oracle_sql())
