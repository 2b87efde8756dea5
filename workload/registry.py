"""Query registration: one Spark callable per key and, where SQL can say it, its check text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.inputs import INPUT_SQL, TABLES, Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def _plain(text: str) -> str:
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


for _name, _text in INPUT_SQL.items():
    VIEWS[_name] = _plain(_text)


def view(name: str, text: str) -> None:
    """A named subquery for the check texts."""
    VIEWS[name] = text


STORED: set[str] = set()


def stored_view(name: str, text: str) -> None:
    """A named subquery that is computed once, however often others read it."""
    VIEWS[name] = text
    STORED.add(name)


def with_views(text: str) -> str:
    """Prefix the named subqueries the text uses, inner ones first."""
    ordered: list[str] = []

    def visit_view(name: str) -> None:
        for other in VIEWS:
            if other != name and other not in ordered and re.search(rf"(?:from|join)\s+{other}\b", VIEWS[name]):
                visit_view(other)
        if name not in ordered:
            ordered.append(name)

    for name in VIEWS:
        if re.search(rf"(?:from|join)\s+{name}\b", text) and name not in ordered:
            visit_view(name)
    if not ordered:
        return text
    heads = ",\n".join(f"{n} as {'materialized ' if n in STORED else ''}({VIEWS[n]})" for n in ordered)
    if text.lstrip().lower().startswith("with "):
        return f"with {heads},\n{text.lstrip()[5:]}"
    return f"with {heads}\n{text}"


def comparable(df: DataFrame) -> DataFrame:
    """Zoned times as plain UTC times, the type the checking database has."""
    return df.select(
        *(F.col(f"`{n}`").cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(f"`{n}`") for n, t in df.dtypes)
    )


def query(key: str, sql: str | None = None):
    def register(fn: Callable[[Lake], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: comparable(fn(Lake(spark, sf_dir)))
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
