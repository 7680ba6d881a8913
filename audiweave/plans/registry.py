"""Queries by name, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) under its name."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


from audiweave.plans import audience, behaviour, cleaning, loads, matching, models, payloads, stores  # noqa: E402, F401
