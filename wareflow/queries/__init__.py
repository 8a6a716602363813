"""Registered queries with their oracle SQL, one module for each operator family."""

from __future__ import annotations

import importlib
import pkgutil


def registry() -> tuple[dict, dict]:
    """All queries and all oracle statements of the modules in this package."""
    found: dict = {}
    sql: dict = {}
    for info in sorted(pkgutil.iter_modules(__path__), key=lambda x: x.name):
        module = importlib.import_module(f"{__name__}.{info.name}")
        found.update(getattr(module, "QUERIES", {}))
        sql.update(getattr(module, "SQL", {}))
    return found, sql
