"""All registered queries and their DuckDB oracle SQL."""

from __future__ import annotations

from folio.plans import catalog_queries, change_queries, stored_queries

QUERIES = {}
ORACLE_SQL = {}
for module in (catalog_queries, change_queries, stored_queries):
    QUERIES.update(module.QUERIES)
    ORACLE_SQL.update(module.ORACLE_SQL)
