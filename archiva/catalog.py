"""All queries of the core and their SQL."""

from __future__ import annotations

import importlib

MODULES = ("packed", "text", "records", "panel", "graph", "layout", "pipeline")

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in MODULES:
    _m = importlib.import_module(f"archiva.plans.{_name}")
    QUERIES.update(_m.QUERIES)
    SQL.update(_m.SQL)
