"""Category clusters: k-means with restarts, k chosen by silhouette.

Lloyd's iterations of every (k, restart) run side by side: one pass over the points finds the nearest
centre in each fit and adds up the points of each (fit, cluster). Points lie on a decimal grid and are
summed as whole numbers, starts follow a hash of the key, so results do not depend on how the rows are
partitioned. What reaches the driver is a few hundred centres, whatever the size of the table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens import fixed_values as fixed
from bazaarlens.functions.numbers import np_round
from bazaarlens.operators.stats import whole_table
from bazaarlens.plans.isolation import KEYS, sample_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors may lack this package

GRID = 100_000  # points carry five decimals; squares of deviations up to 30,000 fit in 64 bits
PASSES = 300
STARTS = 4 * fixed.MAX_CLUSTERS  # rows drawn for a restart; its first distinct ones are the centres
FINE = 10**9  # parts of 1 in which silhouettes are added up


def standardised(df: DataFrame, columns: Sequence[str] = fixed.FEATURE_COLUMNS) -> list[Column]:
    """``(x - mean) / population std`` per column; 0 for a constant column. Nulls count as 0.

    MLlib's StandardScaler divides by the sample deviation, which gives other values.
    """
    values = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    stats = whole_table(
        df,
        **{f"m_{c}": F.avg(v) for c, v in values.items()},
        **{f"s_{c}": F.stddev_pop(v) for c, v in values.items()},
    )
    out = []
    for c, v in values.items():
        mean, std = stats.getField(f"m_{c}"), stats.getField(f"s_{c}")
        out.append(F.when(std > 0, (v - mean) / F.nullif(std, F.lit(0.0))).otherwise(F.lit(0.0)).alias(c))
    return out


class Centres:
    """The centres of all fits, one after another; ``fits`` holds each fit's first centre and the end of the last."""

    def __init__(self, centres: list[np.ndarray]):
        self.at, self.fits = np.concatenate(centres), np.concatenate(([0], np.cumsum([len(c) for c in centres])))

    def of(self, fit: int) -> np.ndarray:
        return self.at[self.fits[fit] : self.fits[fit + 1]]

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distance of every point to every centre, feature by feature in their order."""
        total = np.zeros((len(x), len(self.at)))
        for d in range(x.shape[1]):
            total += (x[:, d, None] - self.at[None, :, d]) ** 2
        return total


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1).astype(np.int64)


def _add_up(centres: Centres):
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each batch and (fit, cluster): points, their sum, and the sum of their squares in two parts."""
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch)
            distances, squares = centres.distances(x.astype(float)), x * x
            high, low = (squares >> 32).sum(1), (squares & 0xFFFFFFFF).sum(1)
            parts = []
            for lo, hi in zip(centres.fits[:-1], centres.fits[1:]):
                own = distances[:, lo:hi].argmin(1)
                count = lambda w, own=own, k=int(hi - lo): np.bincount(own, w, k).astype(np.int64)
                parts.append([count(None), *(count(x[:, d]) for d in range(x.shape[1])), count(high), count(low)])
            n, *sums, high, low = (np.concatenate(c) for c in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(n))), pa.array(n), pa.array(np.stack(sums, 1).tolist()), pa.array(high), pa.array(low)],
                ["centre", "n", "sums", "high", "low"],
            )

    return add_up


def advance(points: DataFrame, centres: Centres) -> tuple[np.ndarray, list[list[int]], list[int]]:
    """One pass: the number of points of each cluster of each fit, their exact sums, and those of their squares."""
    width = centres.at.shape[1]
    told = points.mapInArrow(_add_up(centres), "centre long, n long, sums array<long>, high long, low long")
    exact = lambda c: F.sum(c.cast("decimal(20,0)"))
    totals = told.groupBy("centre").agg(
        F.sum("n").alias("n"), F.array(*(exact(F.col("sums")[d]) for d in range(width))).alias("sums"), exact(F.col("high")).alias("high"), exact(F.col("low")).alias("low")
    )
    n, sums, squares = np.zeros(len(centres.at), np.int64), [[0] * width for _ in centres.at], [0] * len(centres.at)
    for r in totals.collect():
        n[r.centre], sums[r.centre], squares[r.centre] = r.n, [int(s) for s in r.sums], (int(r.high) << 32) + int(r.low)
    return n, sums, squares


def starts(points: DataFrame, keys: Sequence[str], max_k: int, restarts: int, count: int) -> list[np.ndarray]:
    """For each restart the first ``max_k`` distinct points in its order of the hash."""
    drawn = sample_rows(points, keys, restarts, STARTS, count).collect()
    out = []
    for restart in range(restarts):
        rows = list(dict.fromkeys(tuple(r.x) for r in sorted((r for r in drawn if r.tree == restart), key=lambda r: r.nth)))
        out.append(np.array(rows[:max_k], float))
    return out


def lloyd(points: DataFrame, centres: Centres) -> tuple[Centres, np.ndarray, list[list[int]], list[int]]:
    """Centres moved to the mean of their points until none moves; a centre without points stays."""
    for _ in range(PASSES):
        n, sums, squares = advance(points, centres)
        means = np.array([[s / int(m) for s in row] if m else at for m, row, at in zip(n, sums, centres.at.tolist())])
        if (means == centres.at).all():
            break
        centres.at = means
    return centres, n, sums, squares


def _cost(n: np.ndarray, sums: list[list[int]], squares: list[int]) -> float:
    """Sum of squared distances to the means, in squared units, to six decimals, so that equal partitions tie."""
    inner = sum(Fraction(sum(s * s for s in row), int(m)) for m, row in zip(n, sums) if m)
    return round(float((sum(squares) - inner) / GRID**2), 6)


def _silhouettes(centres: Centres, n: np.ndarray, sums: list[list[int]], squares: list[int]):
    """Sums of silhouettes by squared distance; the mean squared distance to a cluster follows from its sums."""
    weight = np.maximum(n, 1).astype(float)
    means = np.array(sums, float) / weight[:, None]
    spread = np.array([float(q) for q in squares]) / weight

    def silhouettes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch).astype(float)
            distances, rows = centres.distances(x), np.arange(len(x))
            norm, cross = np.zeros(len(x)), np.zeros((len(x), len(means)))
            for d in range(x.shape[1]):
                norm += x[:, d] ** 2
                cross += x[:, d, None] * means[None, :, d]
            mean = norm[:, None] - 2 * cross + spread[None, :]
            found = []
            for lo, hi in zip(centres.fits[:-1], centres.fits[1:]):
                own, size = distances[:, lo:hi].argmin(1), n[lo:hi]
                inside = mean[rows, lo + own] * size[own] / np.maximum(size[own] - 1, 1)
                others = np.where(size[None, :] > 0, mean[:, lo:hi], np.inf)
                others[rows, own] = np.inf
                outside = others.min(1)
                largest = np.maximum(inside, outside)
                s = np.where((size[own] > 1) & np.isfinite(outside) & (largest > 0), (outside - inside) / np.where(largest > 0, largest, 1), 0.0)
                found.append(int(np.rint(s * FINE).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found))), pa.array(found, pa.int64())], ["fit", "parts"])

    return silhouettes


def fit_clusters(scores: DataFrame, keys: Sequence[str] = KEYS, restarts: int = fixed.CLUSTER_RESTARTS) -> tuple[DataFrame, DataFrame]:
    """Rows with ``cluster_id, cluster_distance, cluster_label``, and one row per candidate k.

    Of equal silhouettes the smaller k wins, of equal fits of one k the earlier restart. A k beyond the
    number of distinct points among a restart's draws gets as many clusters as there are points. Needs at
    least three rows.
    """
    spark = scores.sparkSession
    x = F.array(*(F.rint(v * GRID).cast("bigint") for v in standardised(scores)))
    points = scores.select(*keys, x.alias("x")).persist()
    try:
        count = points.count()
        max_k = min(fixed.MAX_CLUSTERS, count - 1)
        if max_k < 2:
            raise ValueError("clustering needs at least three rows")
        first = starts(points, keys, max_k, restarts, count)
        tried = [(k, r) for k in range(2, max_k + 1) for r in range(restarts)]
        centres, n, sums, squares = lloyd(points.select("x"), Centres([first[r][:k] for k, r in tried]))
        of = lambda values, fit: values[centres.fits[fit] : centres.fits[fit + 1]]
        best = {}
        for fit, (k, _) in enumerate(tried):
            cost = _cost(of(n, fit), of(sums, fit), of(squares, fit))
            if k not in best or cost < best[k][0]:
                best[k] = (cost, fit)
        chosen = [best[k][1] for k in sorted(best)]
        kept = Centres([centres.of(fit) for fit in chosen])
        part = [i for fit in chosen for i in range(centres.fits[fit], centres.fits[fit + 1])]
        told = points.select("x").mapInArrow(_silhouettes(kept, n[part], [sums[i] for i in part], [squares[i] for i in part]), "fit long, parts long")
        parts = {r.fit: int(r.parts) for r in told.groupBy("fit").agg(F.sum(F.col("parts").cast("decimal(20,0)")).alias("parts")).collect()}
    finally:
        points.unpersist()
    candidates = [(k, parts[i] / FINE / count) for i, k in enumerate(sorted(best))]
    winner = max(range(len(candidates)), key=lambda i: (candidates[i][1], -i))
    table = spark.createDataFrame(candidates, "k int, silhouette_score double")
    return assign(scores.withColumn("_x", x), kept.of(winner)).drop("_x"), table


def assign(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """Cluster, label and distance to the nearest centre of ``_x``; centres are k small literal vectors."""
    distances = []
    for centre in centres:
        gaps = [F.pow(F.col("_x")[d].cast("double") - F.lit(float(v)), F.lit(2.0)) for d, v in enumerate(centre)]
        distances.append(sum(gaps[1:], gaps[0]))
    placed = points.withColumn("_d", F.array(*distances)).withColumn("_near", F.array_min("_d"))
    nearest = (F.array_position("_d", F.col("_near")) - 1).cast("int")
    return placed.select(
        *points.columns,
        nearest.alias("cluster_id"),
        np_round(F.sqrt("_near") / float(GRID), 4).alias("cluster_distance"),
        F.concat(F.lit("cluster_"), nearest.cast("string")).alias("cluster_label"),
    )
