"""Registered queries and the SQL each is compared with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.fixtures_sql import CTES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _needed(sql: str) -> list[str]:
    """Fixture tables the text mentions, with what they rest on, in order."""
    seen: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name, body in CTES.items():
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                todo.append(body)
    return [n for n in CTES if n in seen]


def with_fixtures(sql: str) -> str:
    names = _needed(sql)
    if not names:
        return sql.strip()
    defs = ",\n".join(f"{n} AS (\n{CTES[n].strip()}\n)" for n in names)
    body = sql.strip()
    return f"WITH {defs},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {defs}\n{body}"


def check(name: str, sql: str | None = None):
    """Register a query; ``sql`` may use the fixture tables by name."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_fixtures(sql)
        return fn

    return add
