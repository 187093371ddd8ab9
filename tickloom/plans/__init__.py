"""Registered queries, grouped like the operator inventory."""

import importlib

from tickloom.plans.registry import ORACLES, QUERIES

for _name in ("sources", "tables", "projection", "joins", "aggregates", "windows", "indicators", "features", "text", "patterns", "sets", "models", "streams"):
    importlib.import_module(f"tickloom.plans.{_name}")

__all__ = ["ORACLES", "QUERIES"]
