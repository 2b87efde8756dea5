"""Connected components of an edge table by alternating stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import scratch_path


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(
        F.col("e.v").alias("u"), F.col("e.m").alias("v")
    )


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) for every node of the edges (u, v); a component's name is its least node."""
    spark = edges.sparkSession
    folder = scratch_path(spark, "components")
    clean = lambda e: e.filter("u <> v").distinct()
    clean(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))).write.parquet(f"{folder}/0")
    state = None
    for i in range(rounds):
        edges = spark.read.schema("u long, v long").parquet(f"{folder}/{i}")
        clean(_small_star(clean(_large_star(edges)))).write.parquet(f"{folder}/{i + 1}")
        edges = spark.read.schema("u long, v long").parquet(f"{folder}/{i + 1}")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components are not stable after {rounds} rounds")
    named = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return named.unionByName(named.select(F.col("component").alias("node"), "component").distinct())
