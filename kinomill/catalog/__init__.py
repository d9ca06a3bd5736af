"""Registered queries and their DuckDB counterparts."""

from __future__ import annotations

from importlib import import_module

GROUPS = ("analysis", "cleaning", "rules", "quality", "graph", "storage", "streams", "vectors", "chain")


def _collect(attribute: str) -> dict:
    found: dict = {}
    for group in GROUPS:
        entries = getattr(import_module(f"{__name__}.{group}"), attribute)
        clash = found.keys() & entries.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        found.update(entries)
    return found


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("ORACLE")
