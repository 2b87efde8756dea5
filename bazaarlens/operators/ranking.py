"""Dense rank over a whole table, and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


RANGES = 256


def dense_rank_desc(df: DataFrame, score: str, rank: str, ranges: int = RANGES) -> DataFrame:
    """Rank 1 for the highest score, no gaps. ``score`` is a number; rows without one get no rank.

    The distinct scores are cut into ranges at their quantiles. Each range is ranked by itself, and the
    number of scores in the ranges above is added: a running sum over one row a range. No task sees
    more than one range, however many distinct scores there are. Equal scores share a range, and the
    result does not depend on where the cuts fall.
    """
    levels = df.select(F.col(score).alias("_level")).filter("_level is not null").distinct()
    place = F.col("_level").cast("double")
    steps = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = levels.select(F.percentile_approx(place, steps, 20 * ranges).alias("c")).scalar()
    cut = levels.withColumn("_cuts", F.array_distinct(cuts))
    ranged = cut.select("_level", F.size(F.filter("_cuts", lambda c: c < place)).alias("_range"))
    above = Window.orderBy(F.col("_of").desc()).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy(F.col("_range").alias("_of"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_of", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_range").orderBy(F.col("_level").desc())
    ranked = (
        ranged.withColumn("_nth", F.row_number().over(inside))
        .join(F.broadcast(before), F.col("_range") == F.col("_of"))  # one row a range
        .select("_level", (F.col("_nth") + F.col("_before")).cast("bigint").alias(rank))
    )
    return df.join(ranked, F.col(score) == F.col("_level"), "left").drop("_level")


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows; planned as a per-task top-k and one merge of k rows per task."""
    return df.orderBy(*order).limit(k)


def row_with_max(metric: Column, tie: Column, *values: Column) -> Column:
    """Aggregate: struct of ``values`` from the row with the largest metric; smallest tie first.

    Rows without a metric count only where no row has one.
    """
    return F.min_by(F.struct(*values), F.struct(metric.isNull().alias("none"), (-metric).alias("m"), tie.alias("t")))
