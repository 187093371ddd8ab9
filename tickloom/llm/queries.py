"""The registered queries of the corpus operators; importing the modules registers them."""

import importlib
import pkgutil

import tickloom.llm
from tickloom.llm.common import ORACLES, QUERIES

for _module in sorted(m.name for m in pkgutil.iter_modules(tickloom.llm.__path__) if m.name not in ("common", "queries")):
    importlib.import_module(f"tickloom.llm.{_module}")

__all__ = ["ORACLES", "QUERIES"]
