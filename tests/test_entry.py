"""The driver's entry points, also where the llm subpackage can't be imported."""

import sys

import __spark_entry__ as entry
from tidewheel.queries import REGISTRY


def test_core_queries_without_the_subpackage(monkeypatch):
    for name in ("corpus_pipeline", "tidewheel.llm.queries", "tidewheel.llm"):
        monkeypatch.setitem(sys.modules, name, None)  # importing it raises ImportError
    assert entry.queries().keys() == REGISTRY.queries.keys() and entry.oracle_sql().keys() == REGISTRY.sql.keys()


def test_every_statement_has_its_query():
    assert entry.oracle_sql().keys() <= entry.queries().keys()
