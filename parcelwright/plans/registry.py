"""Every property query by name, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from . import document_queries, entity_queries, lead_queries, lookup_queries, record_queries, state_queries, text_queries

_PARTS = (lead_queries, entity_queries, state_queries, text_queries, lookup_queries, record_queries, document_queries)
QUERIES: dict = {k: v for m in _PARTS for k, v in m.QUERIES.items()}
ORACLES: dict = {k: v for m in _PARTS for k, v in m.ORACLES.items()}
