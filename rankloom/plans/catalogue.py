"""All registered queries; importing the modules registers them."""

import importlib

from rankloom.plans.registry import QUERIES, SQL

for _module in ("retrieval", "vectors", "upkeep", "analytics", "streams"):
    importlib.import_module(f"rankloom.plans.{_module}")

__all__ = ["QUERIES", "SQL"]
