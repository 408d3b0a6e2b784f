"""Registry of the engine's queries and of their DuckDB statements."""

from __future__ import annotations

from tintloom.plans import color_queries, page_queries, run_queries, snapshot_queries, text_queries, url_queries

_REGISTRIES = [m.R for m in (color_queries, page_queries, run_queries, snapshot_queries, text_queries, url_queries)]
QUERIES = {name: f for r in _REGISTRIES for name, f in r.queries.items()}
ORACLES = {name: sql for r in _REGISTRIES for name, sql in r.oracles.items()}
