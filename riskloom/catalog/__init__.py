"""Registered queries: every operator bound to the given tables."""

from __future__ import annotations

from importlib import import_module

from riskloom.catalog.registry import ORACLES, QUERIES

MODULES = (
    "sources",
    "intake",
    "profiling",
    "features",
    "evaluation",
    "actions",
    "modeling",
    "streams",
    "reports",
)

for _m in MODULES:
    import_module(f"riskloom.catalog.{_m}")

__all__ = ["ORACLES", "QUERIES"]
