"""A small registry: each query module records (name → function, name → SQL)."""

from __future__ import annotations


class Registry:
    def __init__(self) -> None:
        self.queries: dict = {}
        self.oracle: dict = {}

    def __call__(self, name: str, sql: str | None = None):
        """Decorator: register a (spark, sf_dir) → DataFrame function and its SQL."""
        def deco(fn):
            self.queries[name] = fn
            if sql is not None:
                self.oracle[name] = sql
            return fn
        return deco
