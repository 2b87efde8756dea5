"""Pages of an ordered result together with its total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PAGE = 100


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    """Rows ``offset .. offset + limit`` and a ``total`` column.

    The order must end in a unique key. Spark keeps ``offset + limit`` rows per task for this;
    for deep pages use :func:`page_after`, which costs the same at any depth.
    """
    _check(limit, offset)
    total = df.select(F.count(F.lit(1))).scalar()
    return df.orderBy(*order).offset(offset).limit(limit).withColumn("total", total)


def page_after(
    df: DataFrame, columns: Sequence[tuple[str, bool]], last_row: dict | None, limit: int
) -> DataFrame:
    """The page that follows ``last_row`` in an order given as ``(column, descending)`` pairs.

    Nulls come last in either direction; :func:`key_order` gives the same order to :func:`page`.
    """
    _check(limit, 0)
    if last_row is not None:
        beyond = F.lit(False)
        same = F.lit(True)
        for name, descending in columns:
            here, there = F.col(name), F.lit(last_row[name])
            if last_row[name] is not None:  # nothing follows a null but ties
                follows = (here < there) if descending else (here > there)
                beyond = beyond | (same & (here.isNull() | follows))
            same = same & here.eqNullSafe(there)
        df = df.filter(beyond)
    return df.orderBy(*key_order(columns)).limit(limit)


def key_order(columns: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(n).desc_nulls_last() if d else F.col(n).asc_nulls_last() for n, d in columns]


def _check(limit: int, offset: int) -> None:
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE}")
    if offset < 0:
        raise ValueError("offset must not be negative")
