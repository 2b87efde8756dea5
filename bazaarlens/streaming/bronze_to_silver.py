"""The Silver transforms over Bronze as it lands.

Each micro-batch is parsed and collapsed to its latest rows with the batch transform and appended
under its batch number; a replayed batch overwrites its own folder, so every landed record counts
once. The latest row per key is chosen on reading, with the same keep-last operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from bazaarlens.operators.dedup import keep_last
from bazaarlens.plans.silver import TRANSFORMS
from bazaarlens.schemas import BRONZE, SILVER

KEYS = {
    "domain_discovery": ["query_domain_category_id"],
    "categories": ["category_id"],
    "item_details": ["item_id"],
    "item_price_snapshots": ["item_id", "snapshot_date"],
    "item_descriptions": ["item_id"],
}


def follow(spark: SparkSession, bronze_path: str, entity: str, table_path: str, progress_path: str) -> StreamingQuery:
    """Process everything that has landed since the last call, then stop."""

    def append(batch: DataFrame, number: int) -> None:
        TRANSFORMS[entity](batch).write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    landed = spark.readStream.schema(BRONZE).parquet(bronze_path)
    return (
        landed.writeStream.foreachBatch(append)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )


def current(spark: SparkSession, table_path: str, entity: str, ties: Sequence[str] = ("batch",)) -> DataFrame:
    """The latest row per key over all batches."""
    rows = spark.read.schema(SILVER[entity] + ", batch bigint").parquet(table_path)
    return keep_last(rows, KEYS[entity], "ingested_at", ties).drop("batch")
