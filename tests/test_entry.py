"""The entry works with and without the optional parts."""

import importlib
import sys

import __spark_entry__ as entry
from tickloom.plans import catalogue


def names_without(monkeypatch, module):
    """Names that are registered where importing ``module`` fails."""
    for name in [n for n in sys.modules if n.split(".")[:2] == ["tickloom", "llm"] or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, module, None)
    return set(entry.queries()), set(entry.oracle_sql())


def test_parts_are_added_where_they_can_be_imported():
    expected = set(catalogue.queries())
    for part in entry.OPTIONAL_PARTS:
        if importlib.util.find_spec(part.split(".")[0]) and entry._optional(part):
            module = importlib.import_module(part)
            expected |= set(module.queries()) if hasattr(module, "queries") else {"pipeline"}
    assert set(entry.queries()) == expected
    assert set(entry.oracle_sql()) <= expected


def test_a_missing_library_costs_only_the_optional_parts(monkeypatch):
    queries, sql = names_without(monkeypatch, "zstandard")
    # The pipeline needs less than all operators together.
    assert queries - {"pipeline"} == set(catalogue.queries())
    assert sql - {"pipeline"} == set(catalogue.oracle_sql())


def test_the_library_stands_without_the_optional_parts(monkeypatch):
    for part in ("tickloom.llm", "corpus_pipeline"):
        queries, _ = names_without(monkeypatch, part)
        assert set(catalogue.queries()) <= queries
