"""Collects the queries of a plan module with their SQL."""

from __future__ import annotations

from collections.abc import Callable


class Registry:
    """Names to queries, and names to the SQL that says the same."""

    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.oracles: dict[str, str] = {}

    def add(self, sql: str | None = None):
        """Registers f(spark, sf_dir) under its name."""

        def mark(f):
            self.queries[f.__name__] = f
            if sql:
                self.oracles[f.__name__] = sql
            return f

        return mark
