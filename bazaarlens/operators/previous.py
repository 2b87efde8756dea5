"""Value of the previous row per key, safe for a key with very many rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_KEY_ROWS = 1_000_000
QUANTILES = [i / 200 for i in range(1, 200)]  # a key of more than 200 million rows has slices above the limit


def with_previous(
    df: DataFrame,
    key: str,
    order: str,
    columns: Mapping[str, str],
    position: Column | None = None,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Add ``{new: lag(old)}`` per ``key`` in ``order``.

    A window sends every row of a key to one task. Keys above ``hot_rows`` rows are therefore cut
    into slices of about that many rows, at quantiles of ``position`` (a number rising with
    ``order``; the microseconds of a timestamp by default), however its values cluster. Lag runs per
    (key, slice); the first row of a slice takes its values from the last row of the slice before
    it. ``order`` must not repeat in a key, save for nulls, which sort last.

    The list of hot keys has at most ``rows / hot_rows`` entries of 200 numbers and goes to every task. Of the
    slice tails, about as many, Spark's size check decides how they travel.
    """
    position = F.unix_micros(F.col(order)) if position is None else position
    placed = df.withColumn("_pos", position.cast("double"))
    counts = placed.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    # only rows of hot keys are cut, and no row is sent to learn that its key is not hot
    hot = (
        placed.join(F.broadcast(counts.filter(F.col("_n") > hot_rows)), F.col(key) == F.col("_hot"))
        .groupBy("_hot", "_n")
        .agg(F.percentile_approx("_pos", QUANTILES, 10 * len(QUANTILES)).alias("_cuts"))
    )
    # every so many quantiles a cut, for slices of about hot_rows rows
    step = F.greatest(F.lit(1), F.floor(F.lit(len(QUANTILES) + 1) * hot_rows / F.col("_n")).cast("int"))
    chosen = F.filter(F.coalesce("_cuts", F.array().cast("array<double>")), lambda _, i: (i + 1) % step == 0)
    hot = F.broadcast(hot.select("_hot", F.array_distinct(chosen).alias("_cuts")))
    # rows without a position form the last slice of their key, as nulls sort last
    hot_slice = F.when(F.col("_pos").isNull(), F.size("_cuts") + 1).otherwise(
        F.size(F.filter("_cuts", lambda c: c < F.col("_pos")))
    )
    # rows without a key have no previous row, so any spread will do
    slice_no = (
        F.when(F.col(key).isNull(), -2 - F.pmod(F.xxhash64(order), F.lit(4096)))
        .when(F.col("_hot").isNull(), F.lit(-1))
        .otherwise(hot_slice)
    )
    is_hot = F.col(key) == F.col("_hot")
    sliced = (
        placed.join(hot, is_hot, "left")
        .withColumn("_slice", slice_no.cast("bigint"))
        .drop("_cuts", "_pos", "_hot")
    )
    inside = Window.partitionBy(key, "_slice").orderBy(F.col(order).asc_nulls_last())
    body = sliced.withColumn("_nth", F.row_number().over(inside))
    for new, old in columns.items():
        body = body.withColumn(new, F.when(F.col(key).isNotNull(), F.lag(old).over(inside)))

    tail_values = F.struct(*(F.col(old).alias(new) for new, old in columns.items()))
    across = Window.partitionBy(key).orderBy("_slice")
    # an inner join: with no hot key the second scan is dropped at run time
    entries = (
        placed.join(hot, is_hot)
        .groupBy(key, hot_slice.cast("bigint").alias("_slice"))
        .agg(F.max_by(tail_values, F.struct(F.col(order).isNull(), F.col(order))).alias("_tail"))
        .withColumn("_before", F.lag("_tail").over(across))
        .select(F.col(key).alias("_ekey"), F.col("_slice").alias("_eslice"), "_before")
    )
    out = body.join(
        entries,
        (F.col(key) == F.col("_ekey")) & (F.col("_slice") == F.col("_eslice")),
        "left",
    )
    opens_slice = (F.col("_nth") == 1) & F.col("_before").isNotNull()
    filled = [
        F.when(opens_slice, F.col(f"_before.{new}")).otherwise(F.col(new)).alias(new) for new in columns
    ]
    return out.select(*df.columns, *filled)
