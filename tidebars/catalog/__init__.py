"""Registered queries and their SQL counterparts, by subject.

Every module has ``QUERIES`` (name -> function of session and table folder) and
``ORACLES`` (name -> SQL over the same tables).
"""

from __future__ import annotations

from tidebars.catalog import (
    features, incremental, indicators_recursive, indicators_window, models, profiling, relational, tables,
)

_MODULES = [
    tables, relational, profiling, indicators_window, indicators_recursive, features, models, incremental,
]


def queries() -> dict:
    return {name: run for module in _MODULES for name, run in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
