"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `oracle` may name any registered SQL view."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_views(oracle)
        return fn

    return register


def sql_view(name: str, text: str) -> None:
    VIEWS[name] = text.strip()


def with_views(body: str) -> str:
    """Put the definitions of all views a statement needs in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\bv_\w+", text):
            if word in VIEWS and word not in needed:
                visit(VIEWS[word])
                needed.append(word)

    visit(body)
    body = body.strip()
    if not needed:
        return body
    head = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in needed)
    if body.startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + head + "," + body.removeprefix("WITH RECURSIVE")
    return f"WITH {head}\n{body}"
