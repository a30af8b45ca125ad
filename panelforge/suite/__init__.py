"""Registered queries over the test tables, each beside its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from panelforge.suite.common import Tables

MODULES = (
    "spell_queries", "load_check_queries", "panel_queries", "bar_queries", "filing_queries", "catalog_queries",
    "snapshot_queries", "load_queries",
)


def _suites():
    return [import_module(f"panelforge.suite.{name}").suite for name in MODULES]


def _bound(query) -> Callable:
    def run(spark, folder):
        return query(Tables(spark, folder))

    run.__name__ = query.__name__
    return run


def all_queries() -> dict[str, Callable]:
    return {name: _bound(query) for suite in _suites() for name, query in suite.queries.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for suite in _suites() for name, sql in suite.sql.items()}
