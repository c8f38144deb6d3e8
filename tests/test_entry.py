"""The entry module works with and without the text operators."""

from __future__ import annotations

import importlib
import sys

import pytest


def entry_without(monkeypatch, name):
    monkeypatch.setitem(sys.modules, name, None)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    try:
        return importlib.import_module("__spark_entry__")
    finally:
        sys.modules.pop("__spark_entry__", None)


def test_without_the_text_operators(monkeypatch):
    found = entry_without(monkeypatch, "corpus_pipeline")
    names = found.queries()
    assert len(names) > 200 and "pipeline" not in names and not [n for n in names if n.startswith("op")]
    assert set(found.oracle_sql()) <= set(names)


def test_other_missing_modules_are_errors(monkeypatch):
    with pytest.raises(ImportError):
        entry_without(monkeypatch, "tidewright.plans.registry")


def test_queries_have_sql_of_the_same_name():
    found = importlib.import_module("__spark_entry__")
    assert set(found.oracle_sql()) <= set(found.queries())
