"""All registered queries and their SQL answers."""

from __future__ import annotations

from checks import html_queries, source_queries, text_queries, tier1_queries

_MODULES = (tier1_queries, html_queries, text_queries, source_queries)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
