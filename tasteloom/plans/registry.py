"""Registry of named queries, each with its SQL counterpart where one exists."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tasteloom.sources.warehouse import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(warehouse) -> DataFrame`` under ``name``; ``sql`` may use VIEWS."""

    def register(fn: Callable[[Warehouse], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: fn(Warehouse(spark, folder))
        if sql:
            ORACLES[name] = expand(sql)
        return fn

    return register


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql.strip()


def expand(sql: str) -> str:
    """Prefix ``sql`` with the views it needs, in dependency order."""
    body = sql.strip()
    recursive = ""
    if body.upper().startswith("WITH RECURSIVE"):
        recursive, body = "RECURSIVE ", body[len("WITH RECURSIVE"):].strip()
    elif body.upper().startswith("WITH "):
        body = body[len("WITH "):].strip()
    else:
        body = "\x00" + body
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_][a-z_0-9]*", re.sub(r"'[^']*'", "", text)):
            if word in VIEWS and word not in needed and word not in visiting:
                visiting.add(word)
                visit(VIEWS[word])
                needed.append(word)

    visiting: set[str] = set()
    visit(body)
    prefix = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    if body.startswith("\x00"):
        body = body[1:]
        return f"WITH {prefix}\n{body}" if prefix else body
    return f"WITH {recursive}{prefix},\n{body}" if prefix else f"WITH {recursive}{body}"
