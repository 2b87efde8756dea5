"""Small relational pieces shared by the plans: predicates, relabelling, unions, lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def equal_filters(df: DataFrame, **wanted: str | None) -> DataFrame:
    """AND of ``column = value`` for the values given; empty or missing values do not filter."""
    for name, value in wanted.items():
        if value:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def relabel(value: Column, labels: Mapping[str, str]) -> Column:
    """Replace known values; others stay."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)


def outside(value: Column, low: float, high: float) -> Column:
    """True for values below low or above high; null values pass."""
    return (value < low) | (value > high)


def coverage_band(score: Column) -> Column:
    return (
        F.when(score >= 90, "high_coverage").when(score >= 50, "medium_coverage").otherwise("low_coverage")
    )


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate; a column absent in one input is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def count_distinct_or_zero(
    left: DataFrame, right: DataFrame, key: str, counted: str, name: str
) -> DataFrame:
    """Left rows with the number of distinct ``counted`` per key on the right, 0 without a match.

    The right side is aggregated before the join, so a key with a third of its rows reaches the
    join as one row.
    """
    counts = right.groupBy(key).agg(F.countDistinct(counted).alias(name))
    return left.join(counts, key, "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("bigint"))


BROADCAST_KEYS = 1_000_000


def orphans(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """Child keys that are absent in the parent, each once with its row count; nulls pass.

    With at most ``broadcast_keys`` rows in the parent, its keys go to every task and the child is not
    shuffled but for its orphans. Beyond that, the child is counted by key first, so that each task
    sends a key once and a hot key is one row of the join.
    """
    known = parent.select(F.col(parent_column).alias("_parent")).filter("_parent is not null")
    absent = F.col(column) == F.col("_parent")
    if known.limit(broadcast_keys + 1).count() <= broadcast_keys:
        missing = child.filter(F.col(column).isNotNull()).join(F.broadcast(known), absent, "left_anti")
        return missing.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return keys.join(known, absent, "left_anti")
