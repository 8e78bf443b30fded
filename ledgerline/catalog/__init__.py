"""Registered queries over the driver tables, each with its SQL oracle.

A query is a function ``(spark, sf_dir) -> DataFrame`` built from library
operators; its oracle is plain SQL over the same tables.  Column names match
on both sides.  Queries without an oracle are checked rows-only and are
tested against a brute-force computation in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # import for side effect: each module registers its queries
    from ledgerline.catalog import (  # noqa: F401
        q_sources, q_columns, q_joins, q_aggregates, q_nested, q_staging,
        q_staging_run, q_coverage, q_merge, q_match, q_billing, q_streaming, q_sql, q_loads,
    )
