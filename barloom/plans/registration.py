"""What each module of queries has: its queries, their SQL, and the decorator that registers both."""

from __future__ import annotations

from collections.abc import Callable


def new_registry() -> tuple[dict, dict, Callable]:
    queries: dict = {}
    oracle_sql: dict = {}

    def query(sql: str | None = None):
        def add(f):
            queries[f.__name__] = f
            if sql is not None:
                oracle_sql[f.__name__] = sql
            return f

        return add

    return queries, oracle_sql, query
