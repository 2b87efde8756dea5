"""Exact inner-product search by norm buckets.

Vectors are grouped by length, longest first, into groups of bounded size; queries into blocks. The
longest group gives each query a first bound on its k-th score. A query meets a later group only if
the product of its length and the group's largest can reach that bound. There, the bound divided by
both lengths is a local cosine threshold: a high one prunes by coordinates (the angle to a query
bounds each coordinate of a unit vector), a low one by length alone. What is left is multiplied out,
so results are exact.

Edge cases: vectors that are null, without id, or hold a null or non-finite component take no
part; of finite ones all do, as whole numbers held exactly by doubles. A result whose score a long does
not hold raises an error, as does a component of 2**400 or more, which no float reaches; shorter vectors count as padded with zeros, an empty one as all zeros; rows with a
query's own id are not its candidates; repeated rows are candidates each, but one query, that of the
least vector; ties go to the smaller id; an empty table gives an empty result. Columns of the input beside id and vector are dropped.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bazaarlens.llm.registry import query, table
from bazaarlens.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 64
LARGEST = 2.0**400  # components stay below, so that squared lengths and their products stay finite
LIMIT = (1 << 63) - 1  # stands for every score from here on, its negative for every one down from there
GROUP = 8192  # vectors of one length group
BLOCK = 1024  # queries of one block
FOCUS = 3  # coordinates checked by coordinate pruning
STEEP = 0.6  # local cosine threshold from which coordinates prune better than lengths
FOUND = "query_id long, vec_id long, score long"


def scaled(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Valid vectors as whole numbers in doubles, with their squared length, rounded."""
    v = F.col(f"`{vector}`")
    fine = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x.cast("double")))
    df = df.select(F.col(f"`{key}`").alias("id"), v.alias("v")).filter(v.isNotNull() & F.col("id").isNotNull()).filter(fine)

    def whole(x: Column) -> Column:
        x = x.cast("double")
        far = F.when(F.abs(x) < LARGEST, x * SCALE).otherwise(F.raise_error(F.lit("a component of 2**400 or more")).cast("double"))
        return F.when(F.abs(x) < 2.0**46, F.floor(x * SCALE).cast("double")).otherwise(far)  # beyond, doubles are whole after scaling

    return df.select("id", F.transform("v", whole).alias("v")).withColumn(
        "norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    )


def _matrix(rows: pa.Table, width: int) -> np.ndarray:
    column = rows["v"].combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(rows), width)
    out = np.zeros((len(rows), width))
    out[np.repeat(np.arange(len(rows)), sizes), np.concatenate([np.arange(n) for n in sizes])] = flat
    return out


def _products(q: np.ndarray, x: np.ndarray, q_lengths: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Exact inner products, cut to ``LIMIT`` and its negative.

    In floating point while every sum stays a whole number there. Beyond, integers modulo 2**64 are
    right where the rounded product says that a long holds it; the few it leaves open are Python's.
    """
    rounded = q @ x.T
    if not rounded.size or q_lengths.max() * lengths.max() < 2.0**52:
        return rounded.astype(np.int64)
    error = np.outer(q_lengths, lengths) * (q.shape[1] + 2) * 2.0**-52
    # a component beyond a long leaves its products to the rounded ones and to Python
    q_fits, x_fits = (np.abs(m).max(axis=1) < 2.0**63 for m in (q, x))
    sure = (np.abs(rounded) + error < 2.0**63) & q_fits[:, None] & x_fits
    scores = np.where(q_fits[:, None], q, 0).astype(np.int64) @ np.where(x_fits[:, None], x, 0).astype(np.int64).T
    scores = np.maximum(scores, -LIMIT)
    high, low = rounded - error >= 2.0**63, rounded + error <= -(2.0**63)
    scores[high], scores[low] = LIMIT, -LIMIT
    for i, j in np.argwhere(~(sure | high | low)):
        scores[i, j] = max(-LIMIT, min(LIMIT, sum(int(a) * int(b) for a, b in zip(q[i], x[j]))))
    return scores


def _by_coordinates(q: np.ndarray, x: np.ndarray, cosine: float) -> np.ndarray:
    """Unit vectors ``x`` whose strongest coordinates of ``q`` allow an angle within the threshold's."""
    spread = np.arccos(min(1.0, cosine))
    alive = np.arange(len(x))
    for f in np.argsort(-np.abs(q))[:FOCUS]:
        angle = np.arccos(np.clip(q[f], -1, 1))
        low, high = np.cos(min(np.pi, angle + spread)), np.cos(max(0.0, angle - spread))
        value = x[alive, f]
        alive = alive[(value >= low - 1e-9) & (value <= high + 1e-9)]
    return alive


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best by score, then by smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def _search(k: int, width: int):
    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        """The best ``k`` of one group for each query of a block that can still be among its best."""
        found = ([], [], [])
        if len(vectors) and len(queries):
            vectors = vectors.sort_by([("norm2", "descending"), ("id", "ascending")])
            ids, x = vectors["id"].to_numpy(), _matrix(vectors, width)
            lengths = np.sqrt(vectors["norm2"].to_numpy().astype(float))
            q_ids, q = queries["id"].to_numpy(), _matrix(queries, width)
            q_lengths = np.sqrt(queries["norm2"].to_numpy().astype(float))
            bounds = queries["bound"].to_numpy(zero_copy_only=False).astype(float)
            bounds = np.where(np.isnan(bounds), -np.inf, bounds)
            reach = np.maximum(q_lengths * lengths[0], 1e-300)
            cosine = bounds / reach
            steep = (cosine > STEEP) & (cosine <= 1 + 1e-9)
            flat = cosine <= STEEP
            # a length that can reach the bound; vectors are in order of length
            prefix = np.searchsorted(-lengths, -(bounds * (1 - 1e-9) - 1e-6) / np.maximum(q_lengths, 1e-300), "right")
            prefix = np.where(bounds > 0, prefix, len(x))
            if flat.any():
                at = np.flatnonzero(flat)
                top = prefix[at].max()
                scores = _products(q[at], x[:top], q_lengths[at], lengths[:top])
                for i, row in zip(at, scores):
                    own = np.flatnonzero(ids[: prefix[i]] != q_ids[i])
                    best = own[_best(row[own], ids[own], k)]
                    for out, part in zip(found, (np.full(len(best), q_ids[i]), ids[best], row[best])):
                        out.append(part)
            if steep.any():
                unit = x / np.maximum(lengths, 1e-300)[:, None]
                for i in np.flatnonzero(steep):
                    alive = _by_coordinates(q[i] / max(q_lengths[i], 1e-300), unit[: prefix[i]], float(cosine[i]) - 1e-9)
                    alive = alive[ids[alive] != q_ids[i]]
                    row = _products(q[i : i + 1], x[alive], q_lengths[i : i + 1], lengths[alive])[0]
                    best = _best(row, ids[alive], k)
                    for out, part in zip(found, (np.full(len(best), q_ids[i]), ids[alive][best], row[best])):
                        out.append(part)
        return pa.table([pa.array(np.concatenate([np.zeros(0, np.int64), *p]), pa.int64()) for p in found], ["query_id", "vec_id", "score"])

    return search


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    beyond = F.raise_error(F.concat(F.lit("a score beyond a long for query "), F.col("query_id").cast("string"))).cast("long")
    return ranked.withColumn("score", F.when(F.col("score").between(-LIMIT + 1, LIMIT - 1), F.col("score")).otherwise(beyond))


def search_top_k(df: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """For each row where ``is_query`` holds, the ``k`` other rows of the largest inner products.

    ``is_query`` is a condition on the column ``key``. Scaled vectors and first-round results are
    written to the shared folder, so that both rounds read the same rows.
    """
    spark = df.sparkSession
    folder = scratch_path(spark, "vectors")
    scaled(df, key, vector).write.parquet(folder + "/all")
    schema = "id long, v array<double>, norm2 double"
    vectors = spark.read.schema(schema).parquet(folder + "/all")
    queries = vectors.withColumnRenamed("id", key).filter(is_query).withColumnRenamed(key, "id")
    queries = queries.groupBy("id").agg(F.min(F.struct("v", "norm2")).alias("q")).select("id", "q.*")
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    n_queries = queries.count()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    # length groups by quantiles, the longest first; groups of one length are split by id
    parts = max(1, math.ceil(size["n"] / group))
    cuts = vectors.select(F.percentile_approx("norm2", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()[0]
    cuts = sorted(set(cuts), reverse=True) if parts > 1 else []
    level = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c > F.col("norm2"))) if cuts else F.lit(0)
    vectors = vectors.withColumn("level", level)
    counts = {r["level"]: (r["n"], r["longest"]) for r in vectors.groupBy("level").agg(F.count("*").alias("n"), F.max("norm2").alias("longest")).collect()}
    splits = [max(1, math.ceil(counts.get(i, (0, 0))[0] / group)) for i in range(len(cuts) + 1)]
    firsts = [sum(splits[:i]) for i in range(len(splits))]
    longest = [math.sqrt(counts[i][1]) if i in counts else 0.0 for i, s in enumerate(splits) for _ in range(s)]
    pick = lambda values: F.get(F.array(*map(F.lit, values)), F.col("level"))
    vectors = vectors.withColumn("group", (pick(firsts) + F.pmod(F.xxhash64("id"), pick(splits))).cast("int")).drop("level")
    blocks = max(1, math.ceil(n_queries / block))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
    search = _search(k, size["width"])

    def meet(asked: DataFrame, groups: range, wanted: Column) -> DataFrame:
        """Each query block meets the groups that one of its queries wants; ``wanted`` filters (query, group) pairs before they travel."""
        right = asked.withColumn("group", F.explode(F.sequence(F.lit(groups.start), F.lit(groups.stop - 1)))).filter(wanted)
        right = right.select(*[F.col(c).alias(c) for c in right.columns])  # names of its own: both sides come from one table
        pairs = right.select(F.col("group").alias("group"), F.col("block").alias("block")).distinct()
        left = vectors.filter(F.col("group").between(groups.start, groups.stop - 1)).join(pairs, "group")
        return left.groupBy("group", "block").cogroup(right.groupBy("group", "block")).applyInArrow(search, FOUND)

    first = meet(queries.withColumn("bound", F.lit(None).cast("long")), range(0, 1), F.lit(True))
    first.write.parquet(folder + "/first")
    first = spark.read.schema(FOUND).parquet(folder + "/first")
    found = first
    if len(longest) > 1:
        # a query without k candidates yet has no bound
        bounds = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count("*") >= k, F.min("score")).alias("bound"))
        reach = F.sqrt("norm2") * F.get(F.array(*map(F.lit, longest)), F.col("group"))
        wanted = F.col("bound").isNull() | (reach >= F.col("bound") - 1e-6 * F.abs("bound") - 1e-6)
        found = first.unionByName(meet(queries.join(bounds, "id", "left"), range(1, len(longest)), wanted))
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


CHECK_SQL = f"""with v as (select vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) v from embeddings
    where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
padded as (select vec_id, list_resize(v, (select max(len(v)) from v), 0) v from v),
s as (select q.vec_id query_id, c.vec_id, cast(list_dot_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) score
    from padded q join padded c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) "rank" from s)
select query_id, "rank", vec_id, score from r where "rank" <= 20"""


@query("op7_exact_top_k", CHECK_SQL)
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best partners of every vector whose id is divisible by 20."""
    return search_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
