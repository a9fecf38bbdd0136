"""Named queries, each with its SQL counterpart where SQL can express it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from venuelens.plans.bridge import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain_names(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text)


def with_views(sql: str) -> str:
    """The SQL with the views it mentions in front of it."""
    used = [name for name in VIEWS if re.search(rf"\b{name}\b", sql)]
    views = [f"{name} AS ({plain_names(VIEWS[name]).strip()})" for name in used]
    sql = sql.strip()
    if sql.upper().startswith("WITH "):
        views, sql = [*views, sql[5:].strip()], ""
    if not views:
        return sql
    return "WITH " + ",\n".join(views) + ("\n" + sql if sql else "")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = with_views(sql)
        return run

    return register
