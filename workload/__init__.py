"""The given tables seen as panels, the registered queries and their SQL counterparts."""

from __future__ import annotations

from importlib import import_module

MODULES = ("gold_queries", "silver_queries", "report_queries", "check_queries", "audit_queries")


def load_queries():
    """(queries, oracles) by name."""
    for name in MODULES:
        import_module(f"workload.{name}")
    registry = import_module("workload.registry")
    return registry.QUERIES, registry.ORACLES
