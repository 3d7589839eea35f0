"""All queries of the subpackage and their SQL."""

from __future__ import annotations

import importlib

MODULES = ("canon", "cooccur", "leaks", "mix", "quality", "scans", "variants")

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in MODULES:
    _m = importlib.import_module(f"archiva.llm.queries_{_name}")
    QUERIES.update(_m.QUERIES)
    SQL.update(_m.SQL)
