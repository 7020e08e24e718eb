"""Every registered query by name, and the SQL that gives the same rows."""

from __future__ import annotations

from corundum.plans import assembly_queries, audit_queries, state_queries, text_queries

_PARTS = (assembly_queries, audit_queries, state_queries, text_queries)
QUERIES: dict = {k: v for p in _PARTS for k, v in p.QUERIES.items()}
ORACLES: dict[str, str] = {k: v for p in _PARTS for k, v in p.ORACLES.items()}
