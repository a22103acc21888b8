"""Every operator as a query over the test tables, with the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

from suite.registry import ORACLES, QUERIES

for _module in ("reports", "merges", "versions", "joins", "columns", "lines", "nested", "storage", "buckets", "streams"):
    import_module(f"suite.{_module}")

__all__ = ["ORACLES", "QUERIES"]
