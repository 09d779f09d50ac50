"""Registered queries: one library operator each, with the SQL that states the same result."""
from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
MODULES = ["sources", "scalars", "series", "detection", "rootcause", "states", "decisions", "evaluation", "audits", "streams", "verdicts"]


def query(name: str, sql: str | None = None):
    def register(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    from importlib import import_module

    for name in MODULES:
        import_module(f"checks.{name}")
