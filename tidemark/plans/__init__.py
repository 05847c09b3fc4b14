"""Registered queries over the given tables."""

from __future__ import annotations

import importlib

MODULES = ("q_tables", "q_events", "q_quality", "q_metrics", "q_stream")


def all_queries():
    """(queries by name, SQL by name)."""
    from tidemark.plans import catalog

    for m in MODULES:
        importlib.import_module(f"tidemark.plans.{m}")
    return catalog.QUERIES, catalog.ORACLE
