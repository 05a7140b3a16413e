"""Registry of the core queries."""

from __future__ import annotations

import importlib

#: Modules that hold QUERIES and SQL.
MODULES = ("parsing", "textual", "structured", "operating")


def core_queries() -> dict:
    found: dict = {}
    for name in MODULES:
        found |= importlib.import_module(f"lectern.plans.{name}").QUERIES
    return found


def core_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for name in MODULES:
        found |= importlib.import_module(f"lectern.plans.{name}").SQL
    return found
