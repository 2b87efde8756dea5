"""Isolation forest (Liu, Ting & Zhou, 2008) as a node table that column expressions walk.

Every draw is a hash: which rows a tree samples, which feature a node cuts, and where. A tree grows from
its sample in one bounded task. The forest is a table with a row for each tree, its nodes in heap order:
the children of node ``i`` are ``2 i`` and ``2 i + 1``. Scoring walks those arrays with higher-order
functions in as many steps as a tree is deep, without Python and without a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.fixed_values import FEATURE_COLUMNS, RANDOM_STATE

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors may lack this package

TREES = 100
SAMPLE = 256
EULER_GAMMA = 0.5772156649015329
DIGITS = 13  # hexadecimal digits of a draw: 52 bits, exact as a double
PRIME = (1 << 31) - 1
FOREST = "tree int, rows bigint, levels int, feature array<int>, cut array<double>, path array<double>"
KEYS = ("category_id", "snapshot_date_key")


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n rows: what a leaf of n rows still hides."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def _drawn(text: Column) -> Column:
    """A whole number of 52 bits that follows from ``text``."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("bigint")


def sample_rows(points: DataFrame, keys: Sequence[str], trees: int, sample: int, count: int) -> DataFrame:
    """(tree, x, nth): ``sample`` rows of ``points`` for every tree, drawn from the whole table in one scan.

    A row's hash, turned by each tree's own line modulo a prime, orders the rows of that tree. Only rows
    below a bound that leaves about twice ``sample`` to a tree are offered to it.
    """
    bound = math.ceil(min(1.0, 2 * sample / max(count, 1)) * PRIME)
    text = F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    lines = [{"tree": t, "a": 1 + _number(f"a:{RANDOM_STATE}:{t}") % (PRIME - 1), "b": _number(f"b:{RANDOM_STATE}:{t}") % PRIME} for t in range(trees)]
    turns = F.from_json(F.lit(json.dumps(lines)), "array<struct<tree:int,a:bigint,b:bigint>>")
    hashed = points.select("x", text.alias("_key"), (_drawn(text) % PRIME).alias("_h"))
    place = lambda t: (t["a"] * F.col("_h") + t["b"]) % PRIME
    offered = hashed.select("x", "_key", "_h", F.explode(F.filter(turns, lambda t: place(t) < bound)).alias("t"))
    offered = offered.select("x", "_key", F.col("t.tree").alias("tree"), place(F.col("t")).alias("_place"))
    first = Window.partitionBy("tree").orderBy("_place", "_key")
    return offered.select("tree", "x", F.row_number().over(first).alias("nth")).filter(F.col("nth") <= sample)


def grow_tree(x: np.ndarray, tree: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Levels, and ``feature`` (from 0; -1 for leaves), ``cut`` and ``path`` of every place of the heap.

    A node is a leaf at the mean depth, with a single row, or where no feature varies; its path is its
    depth and what its rows still hide.
    """
    levels = math.ceil(math.log2(max(len(x), 2)))
    places = 2 ** (levels + 1) - 1
    feature, cut, path = np.full(places, -1), np.full(places, np.nan), np.full(places, np.nan)
    waiting = [(1, x)]
    while waiting:
        node, rows = waiting.pop()
        depth = node.bit_length() - 1
        varied = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0))
        if depth == levels or not len(varied):
            path[node - 1] = depth + average_path(len(rows))
            continue
        axis, at = (_number(f"{what}:{RANDOM_STATE}:{tree}:{node}") / 16.0**DIGITS for what in ("feature", "cut"))
        axis = varied[int(axis * len(varied))]
        low, high = rows[:, axis].min(), rows[:, axis].max()
        feature[node - 1], cut[node - 1] = axis, low + at * (high - low)
        above = rows[:, axis] > cut[node - 1]
        waiting += [(2 * node, rows[~above]), (2 * node + 1, rows[above])]
    return levels, feature, cut, path


def _grow(sample: pd.DataFrame) -> pd.DataFrame:
    tree = int(sample["tree"].iloc[0])
    x = np.array(sample["x"].tolist(), float)
    levels, *nodes = grow_tree(x, tree)
    return pd.DataFrame([(tree, len(x), levels, *nodes)], columns=["tree", "rows", "levels", "feature", "cut", "path"])


def grow_forest(points: DataFrame, keys: Sequence[str] = KEYS, trees: int = TREES, sample: int = SAMPLE) -> DataFrame:
    """One row per tree (``FOREST``) from ``points`` with the ``keys`` and an array ``x`` of numbers."""
    return sample_rows(points, keys, trees, sample, points.count()).groupBy("tree").applyInPandas(_grow, FOREST)


def _path(x: Column, tree: Column) -> Column:
    """The path length at which the walk of ``x`` through a tree ends."""

    def step(node: Column, _: Column) -> Column:
        feature = F.element_at(tree["feature"], node)
        above = F.get(x, feature) > F.element_at(tree["cut"], node)
        return F.when(feature < 0, node).otherwise(2 * node + above.cast("int"))

    return F.element_at(tree["path"], F.aggregate(F.sequence(F.lit(1), tree["levels"]), F.lit(1), step))


def points_of(features: DataFrame, keys: Sequence[str] = KEYS, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    return features.select(*keys, F.array(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns)).alias("x"))


def isolation_scores(
    features: DataFrame,
    keys: Sequence[str] = KEYS,
    columns: Sequence[str] = FEATURE_COLUMNS,
    trees: int = TREES,
    sample: int = SAMPLE,
    forest: DataFrame | None = None,
) -> DataFrame:
    """``features`` with ``isolation_score`` in (0, 1]; higher is more isolated.

    The forest, grown here or given, is read as a scalar subquery: ``trees`` rows of at most ``4 * sample``
    nodes, a size that does not depend on the table.
    """
    if forest is None:
        forest = grow_forest(points_of(features, keys, columns), keys, trees, sample)
    whole = forest.agg(F.sort_array(F.collect_list(F.struct("tree", "rows", "levels", "feature", "cut", "path"))).alias("trees")).scalar()
    x = F.array(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns))
    with_trees = features.select("*", x.alias("_x"), whole.alias("_trees"))
    total = F.aggregate("_trees", F.lit(0.0), lambda sum_, tree: sum_ + _path(F.col("_x"), tree))
    usual = F.greatest(_average_path(F.element_at("_trees", 1)["rows"]), F.lit(1e-12))
    score = F.pow(F.lit(2.0), -total / F.size("_trees") / usual)
    return with_trees.withColumn("isolation_score", score).drop("_x", "_trees")


def _average_path(n: Column) -> Column:
    m = (n - 1).cast("double")
    return F.when(n <= 1, 0.0).when(n == 2, 1.0).otherwise(2.0 * (F.log(m) + EULER_GAMMA) - 2.0 * m / n)
