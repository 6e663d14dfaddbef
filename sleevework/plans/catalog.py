"""The complete registry: importing this module registers every query."""

from __future__ import annotations

from sleevework.plans import (  # noqa: F401
    check_queries,
    crawl_queries,
    entity_queries,
    notes_queries,
    page_queries,
    quality_queries,
    reply_queries,
    value_queries,
    views,
)
from sleevework.plans.registry import QUERIES, Run, checking_sql


def all_queries() -> dict[str, Run]:
    return {name: q.run for name, q in QUERIES.items()}


def all_checks() -> dict[str, str]:
    return {name: checking_sql(q.check_sql) for name, q in QUERIES.items() if q.check_sql is not None}
