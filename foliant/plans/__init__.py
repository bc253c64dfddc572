"""Registered queries over the given tables."""

from __future__ import annotations

import importlib

MODULES = ["catalogue_queries", "archive_queries", "permission_queries"]


def load_queries():
    """(queries, comparison SQL) of all query modules."""
    for name in MODULES:
        importlib.import_module(f"foliant.plans.{name}")
    registry = importlib.import_module("foliant.plans.registry")
    return registry.QUERIES, registry.ORACLE
