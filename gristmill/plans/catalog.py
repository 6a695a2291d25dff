"""All queries over the test tables, by the ids of the operators they show, with their DuckDB oracles."""

from __future__ import annotations

from . import curation, evaluation, records, relational, retrieval

FLAGSHIP = "p0_ranked_search"
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _module in (retrieval, relational, curation, evaluation, records):
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.ORACLE_SQL
