"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from importlib import import_module

MODULES = ("layers", "ranking", "aggregates", "values", "checks", "ingest")


def load():
    """(queries, oracle SQL) of all registry modules."""
    from . import core
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return core.QUERIES, core.ORACLES
