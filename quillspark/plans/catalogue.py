"""All catalogue queries on the driver's tables, with their SQL."""

from __future__ import annotations

from quillspark.plans import corpus_queries, entity_queries, generated, search_queries, stage_queries, text_queries
from quillspark.plans.base import Query

_PARTS = [m.query for m in (corpus_queries, entity_queries, generated, search_queries, stage_queries, text_queries)]


def queries() -> dict[str, Query]:
    return {k: v for part in _PARTS for k, v in part.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for part in _PARTS for k, v in part.sql.items()}
