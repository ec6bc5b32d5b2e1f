"""Registered queries: the operators applied to the given tables, each with SQL of its own where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def registered() -> tuple[dict, dict]:
    from . import annotation, comparison, encoding, sources, streams, windows, work  # noqa: F401

    return dict(QUERIES), dict(ORACLES)
