"""Registers of queries with their check SQL."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict[str, Callable], dict[str, str], Callable]:
    """Queries by name, their SQL by name, and a decorator that adds to both."""
    queries: dict[str, Callable] = {}
    checks: dict[str, str] = {}

    def register(name: str, sql: str | None = None):
        def add(fn):
            queries[name] = fn
            if sql is not None:
                checks[name] = sql
            return fn

        return add

    return queries, checks, register
