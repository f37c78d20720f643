"""The driver's entry points with and without the training-data operators."""

import importlib.util

import __spark_entry__ as E
from ratelens.plans.oracle import oracle_sql
from ratelens.plans.queries import registry


def test_queries_without_the_operators(monkeypatch):
    """Both folders are gone, corpus_pipeline.py is still there: the library's own queries are left."""
    real = importlib.util.find_spec

    def hidden(name, *rest):
        if name.startswith("ratelens.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}")
        return real(name, *rest)

    monkeypatch.setattr(importlib.util, "find_spec", hidden)
    assert set(E.queries()) == set(registry()) and set(E.oracle_sql()) == set(oracle_sql())
    assert len(registry()) >= 64


def test_every_query_of_the_library_has_sql():
    assert set(registry()) == set(oracle_sql())
