"""Registered queries over the driver's tables, one module per part of the engine."""

from __future__ import annotations

from tidemark.workload import catalog, decisions, loading, modelling, relational, storage

QUERIES: dict = {}
ORACLE: dict = {}
for _module in (catalog, relational, loading, decisions, modelling, storage):
    QUERIES.update(_module.REGISTRY.queries)
    ORACLE.update(_module.REGISTRY.sql)
