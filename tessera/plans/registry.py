"""Named queries: each is ``(spark, sf_dir) -> DataFrame`` plus, when the
operator is expressible in SQL, an independent DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
CHECK: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its oracle (omit for rows-only checks)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        CHECK[name] = "S" if sql else "R"
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


def load_all():
    """Import every query module so that the registry is filled."""
    from tessera.plans import (  # noqa: F401
        q_online,
        q_sources,
        q_features,
        q_aggregates,
        q_latency,
        q_windows,
        q_metrics,
        q_text,
        q_quality,
        q_models,
        q_streams,
        q_similar,
    )
    return QUERIES, ORACLE
