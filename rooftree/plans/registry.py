"""Registry of runnable queries and of the SQL that must give the same rows."""
from __future__ import annotations

from rooftree.plans.bindings import Tables

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with an oracle where SQL can express it."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add
