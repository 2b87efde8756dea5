"""Keep the last or first row per key.

``row_number() = 1`` is planned with a group limit below the shuffle: each task sends at most one
row per key, so a key that holds a third of the input costs one row per task, not one huge group.
Null keys form one group. ``ties`` make the choice repeatable when a job is retried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RARE = 1_000_000  # repeated keys that are sent to every task


def _first_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(w)).filter("_row = 1").drop("_row")


def keep_last_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in an order of any columns. Put the keys with the most values in front: tasks sort by
    them, and an order that is told by its first column is found fast."""
    return _first_of(df, keys, order)


def keep_last_sound(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], unsound: str) -> DataFrame:
    """Latest row per key of those without the flag ``unsound``; a key with flagged rows only has none.

    Flagged rows lose the order of their key and are dropped above the window, where the filter is not
    pushed down: what the flag is computed from is computed once.
    """
    order = [F.col(unsound).asc(), F.col(ts).desc_nulls_first(), *(F.col(t).desc_nulls_last() for t in ties)]
    return _first_of(df, keys, order).filter(~F.col(unsound)).drop(unsound)


def keep_last(
    df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Latest row per key. A null time sorts after every time, so it wins."""
    order = [F.col(ts).desc_nulls_first(), *(F.col(t).desc_nulls_last() for t in ties)]
    return _first_of(df, keys, order)


def keep_first_of_rare(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """As :func:`keep_first`, for a table where keys seldom repeat: rows of a key that comes once stay in place.

    Repeated keys are found by their hash first, so only the rows of those (and of a key that shares their
    hash) are sorted and sent. With more than ``RARE`` repeated keys all rows are. Give it a stored frame: it is
    read twice.
    """
    tag = F.xxhash64(*keys).alias("_tag")
    repeated = df.groupBy(tag).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_tag")
    found = repeated.count()
    if found > RARE:
        return keep_first(df, keys, ts, ties)
    if not found:
        return df
    tagged, marked = df.select("*", tag), F.broadcast(repeated)
    once = tagged.join(marked, "_tag", "left_anti").drop("_tag")
    return once.unionByName(keep_first(tagged.join(marked, "_tag", "left_semi").drop("_tag"), keys, ts, ties))


def keep_first(
    df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Earliest row per key; rows without a time come last."""
    order = [F.col(ts).asc_nulls_last(), *(F.col(t).asc_nulls_last() for t in ties)]
    return _first_of(df, keys, order)
