"""Registry of queries with their check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from maskloom.plans.tables import VIEW_SQL, Tables


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of :class:`Tables`; the function's name is the query's name."""

    def add(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = Query(key, fn, sql)
        return fn

    return add


def _views_used(text: str, seen: dict[str, None]) -> None:
    for view, body in VIEW_SQL.items():
        if view not in seen and re.search(rf"\b{view}\b", text):
            _views_used(body, seen)
            seen[view] = None


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the stand-in relations it names."""
    seen: dict[str, None] = {}
    _views_used(sql, seen)
    if not seen:
        return sql.strip()
    ctes = ",\n".join(f"{v} AS MATERIALIZED ({VIEW_SQL[v].strip()})" for v in seen)
    body = sql.strip()
    if re.match(r"(?i)with\s+recursive\b", body):
        return f"WITH RECURSIVE {ctes},\n{re.sub(r'(?i)^with\s+recursive\s+', '', body)}"
    if re.match(r"(?i)with\b", body):
        return f"WITH {ctes},\n{re.sub(r'(?i)^with\s+', '', body)}"
    return f"WITH {ctes}\n{body}"


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query):
        return lambda spark, sf_dir: q.run(Tables(spark, sf_dir))

    return {name: bind(q) for name, q in QUERIES.items()}


def check_sql() -> dict[str, str]:
    return {name: with_views(q.sql) for name, q in QUERIES.items() if q.sql}
