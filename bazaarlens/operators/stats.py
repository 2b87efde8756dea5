"""Whole-table statistics applied to every row.

The statistic is a one-row aggregate read through a scalar subquery: partial aggregates, one
value, no join and no unpartitioned window over the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.numbers import ratio_or_zero


def whole_table(df: DataFrame, **aggregates: Column) -> Column:
    """Struct with the named aggregates over the whole table."""
    return df.select(F.struct(*(agg.alias(name) for name, agg in aggregates.items())).alias("s")).scalar()


def share_of_total(df: DataFrame, value: Column) -> Column:
    """``value / sum(value)``; 0 when the total is not positive."""
    stats = whole_table(df, total=F.coalesce(F.sum(value), F.lit(0)))
    return ratio_or_zero(value, stats.getField("total"))


def relative_to_max(df: DataFrame, value: Column) -> Column:
    """``value / max(value) * 100``; 0 when the maximum is not positive."""
    peak = whole_table(df, peak=F.max(value)).getField("peak")
    return ratio_or_zero(value, peak) * 100


def min_max_score(df: DataFrame, value: Column) -> Column:
    """0 to 100 between the smallest and largest value; 50 when all are equal."""
    value = F.coalesce(value.cast("double"), F.lit(0.0))
    stats = whole_table(df, low=F.min(value), high=F.max(value))
    low, high = stats.getField("low"), stats.getField("high")
    return F.when(high == low, F.lit(50.0)).otherwise(F.try_divide(value - low, high - low) * 100)


def moments(df: DataFrame, value: Column, digits: int = 2) -> Column:
    """Exact count, sum and sum of squares of values on a decimal grid, as a struct.

    Coverage scores carry two decimals, so whole hundredths lose nothing, and the sums do not
    depend on how the rows were partitioned.
    """
    grid = grid_units(value, digits)
    return whole_table(
        df,
        n=F.count(grid).cast("decimal(20,0)"),
        total=F.sum(grid).cast("decimal(20,0)"),
        squares=F.sum((grid * grid).cast("decimal(18,0)")).cast("decimal(28,0)"),
    )


def grid_units(value: Column, digits: int = 2) -> Column:
    return F.rint(value * F.lit(float(10**digits))).cast("bigint")


def spread_units(stats: Column) -> Column:
    """``n * std`` in grid units: the square root of ``n * sum(x^2) - sum(x)^2``."""
    n, total, squares = (stats.getField(f) for f in ("n", "total", "squares"))
    square = (n.cast("decimal(11,0)") * squares.cast("decimal(26,0)")) - total * total.cast("decimal(17,0)")
    return F.sqrt(square.cast("double"))


def population_std(stats: Column, digits: int = 2) -> Column:
    return spread_units(stats) / (stats.getField("n").cast("double") * F.lit(float(10**digits)))


def mean_of(stats: Column, digits: int = 2) -> Column:
    return stats.getField("total").cast("double") / (
        stats.getField("n").cast("double") * F.lit(float(10**digits))
    )


def z_score(df: DataFrame, value: Column, digits: int = 2) -> Column:
    """``(x - mean) / population std`` with exact sums; 0 for a constant column."""
    stats = moments(df, value, digits)
    spread = spread_units(stats)
    offset = grid_units(value, digits) * stats.getField("n") - stats.getField("total")
    return F.when(spread > 0, offset.cast("double") / F.nullif(spread, F.lit(0.0))).otherwise(F.lit(0.0))


GRID = 200  # quantiles asked of each sketch
COUNTED = 10_000  # values counted one by one


def quartiles(df: DataFrame, value: Column) -> Column:
    """Interpolated 25th and 75th percentile as an array; null without values."""
    found = exact_quantiles(df, value, (0.25, 0.75))
    return F.lit(None).cast("array<double>") if found is None else F.array(*(F.lit(x) for x in found))


def exact_quantiles(
    df: DataFrame, value: Column, at: Sequence[float], counted: int = COUNTED, grid: int = GRID
) -> list[float] | None:
    """Interpolated percentiles of the non-null values, exact for any values; None without values.

    Each pass asks a quantile sketch for ``grid`` steps of the values still in question and keeps the
    few steps around each wanted rank, so some ``6 / grid`` of them go on; what lies below is counted.
    Ends of a bracket are counted apart, so a value with a third of the rows ends the search or drops
    out. Brackets of at most ``counted`` rows are counted value by value. A billion values take six
    scans; buffers and results are bounded by ``grid`` and ``counted``.
    """
    x = F.col("x")
    values = df.select(value.cast("double").alias("x")).filter("x is not null")
    total = values.count()
    if not total:
        return None
    places = [q * (total - 1) for q in at]
    open_brackets = {rank: (None, None) for p in places for rank in (math.floor(p), math.ceil(p))}
    found: dict[int, float] = {}
    small: dict[int, tuple[Column, int]] = {}  # values in the bracket, rows up to its low end
    if total <= counted:
        small = {rank: (F.lit(True), 0) for rank in open_brackets}
        open_brackets = {}
    steps = F.array(*(F.lit(i / grid) for i in range(grid + 1)))
    while open_brackets:
        counts = []
        for i, (low, high) in enumerate(open_brackets.values()):
            inside = _between(x, low, high)
            counts += [
                F.count_if(_under(x, low)).alias(f"below{i}"),
                F.count_if(_under(x, low) | (x == F.lit(low)) if low is not None else F.lit(False)).alias(f"start{i}"),
                F.count_if(inside).alias(f"inside{i}"),
                F.count_if(x == F.lit(high) if high is not None else F.lit(False)).alias(f"top{i}"),
                F.percentile_approx(F.when(inside, x), steps, 20 * grid).alias(f"cuts{i}"),
            ]
        row = values.agg(*counts).first()
        narrower = {}
        for i, (rank, (low, high)) in enumerate(open_brackets.items()):
            start, inside, cuts = row[f"start{i}"], row[f"inside{i}"], row[f"cuts{i}"]
            if not row[f"below{i}"] <= rank < start + inside + row[f"top{i}"]:
                raise RuntimeError(f"rank {rank} is not in its bracket")
            if rank < start:
                found[rank] = low
            elif rank >= start + inside:
                found[rank] = high
            elif inside <= counted:
                small[rank] = (_between(x, low, high), start)
            else:
                step = (rank - start) / inside * grid
                first, last = math.floor(step) - 2, math.ceil(step) + 3
                narrower[rank] = (cuts[first] if first > 0 else low, cuts[last] if last < grid else high)
        open_brackets = narrower
    if small:
        marks = [inside.alias(f"m{i}") for i, (inside, _) in enumerate(small.values())]
        needed = reduce(Column.__or__, (inside for inside, _ in small.values()))
        by_value = values.filter(needed).groupBy("x").agg(F.count(F.lit(1)).alias("n")).select("x", "n", *marks)
        ordered = by_value.orderBy("x").collect()  # at most ``counted`` rows a rank
        for i, (rank, (_, start)) in enumerate(small.items()):
            for r in ordered:
                if r[f"m{i}"]:
                    start += r["n"]
                    if rank < start:
                        found[rank] = r["x"]
                        break
    return [_interpolated(p, found[math.floor(p)], found[math.ceil(p)]) for p in places]


def _under(x: Column, bound: float | None) -> Column:
    return F.lit(False) if bound is None else x < F.lit(bound)


def _between(x: Column, low: float | None, high: float | None) -> Column:
    """Strictly between the bounds given."""
    above = F.lit(True) if low is None else x > F.lit(low)
    return above & (F.lit(True) if high is None else x < F.lit(high))


def _interpolated(place: float, low: float, high: float) -> float:
    at = math.floor(place)
    return low if low == high or place == at else (at + 1 - place) * low + (place - at) * high
