"""Landing: response files as they arrive, unpacked into Bronze records.

Each kind of response is a folder of JSON-lines files (``RESPONSE``). A run takes the files that are new
since the last one, batch by batch, and unpacks a batch into the Bronze twins of its entities, in a folder
of the batch. A batch that is repeated after a failure overwrites its own folders, and files seen before are
not read again, so every response counts once. Bodies that are not JSON are set aside under ``quarantine``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.functions.payload import json_kind
from bazaarlens.sources import responses
from bazaarlens.sources.bronze import PARTITIONS, envelope, partitioned, scan_bronze, write_twins
from bazaarlens.sources.tables import by_date

RESPONSE = "endpoint string, requested string, received_at string, body string"


@dataclass(frozen=True)
class Kind:
    """How responses of a kind become payloads of entities, and where they come from."""

    source: str
    entities: dict[str, Callable[[DataFrame], DataFrame]]
    endpoint: Column | None = None  # the response's own, unless given


def _objects(rows: DataFrame) -> DataFrame:
    return responses.explode_objects(rows, "body")


def _categories(rows: DataFrame) -> DataFrame:
    """A category by itself, a list of them, or a list under ``categories``."""
    alone = (json_kind(F.col("body")) == "object") & F.get_json_object("body", "$.categories").isNull()
    one = F.when(alone, F.concat(F.lit("["), "body", F.lit("]"))).otherwise(F.col("body"))
    return responses.explode_categories(rows.withColumn("body", one), "body")


def _listings(rows: DataFrame) -> DataFrame:
    ids = responses.explode_listing_ids(rows, "body", "requested", kept=["endpoint", "received_at"])
    return ids.withColumn("payload", F.to_json(F.struct("id", "seller_id")))


def _items(rows: DataFrame) -> DataFrame:
    return responses.unwrap_multiget(rows, "body")


def _prices(rows: DataFrame) -> DataFrame:
    kept = ["endpoint", "received_at"]
    return responses.price_snapshot_payloads(_items(rows), kept=kept).select(
        *kept, F.to_json(F.struct(*responses.PRICE_FIELDS), {"ignoreNullFields": "false"}).alias("payload")
    )


def _descriptions(rows: DataFrame) -> DataFrame:
    found = rows.filter(json_kind(F.col("body")) == "object").withColumn("payload", F.col("body"))
    return responses.merge_id(found, "payload", "requested")


PUBLIC, SELLER = "public_api", "seller_api"
KINDS = {
    "domain_discovery": Kind(PUBLIC, {"domain_discovery": _objects}),
    "categories": Kind(PUBLIC, {"categories": _categories}),
    "search": Kind(PUBLIC, {"search_items": lambda rows: responses.explode_search_results(rows, "body")}),
    "seller_user": Kind(SELLER, {"authenticated_user": lambda rows: rows.filter(json_kind(F.col("body")) == "object").withColumn("payload", F.col("body"))}),
    "seller_items": Kind(SELLER, {"seller_items": _listings}),
    "items": Kind(SELLER, {"item_details": _items, "item_price_snapshots": _prices}),
    "descriptions": Kind(SELLER, {"item_descriptions": _descriptions}),
}


def unpack(rows: DataFrame, kind: str, entity: str) -> DataFrame:
    """Responses of a kind as Bronze records of an entity, with their date parts."""
    payloads = KINDS[kind].entities[entity](rows)
    return partitioned(envelope(payloads, "payload", KINDS[kind].source, F.col("endpoint"), F.col("received_at")))


def land_batch(rows: DataFrame, kind: str, number: int, root: str) -> dict[str, int]:
    """Write one batch under its number, in place of an earlier attempt at it; rows by entity."""
    counts = {}
    for entity in KINDS[kind].entities:
        # as a rule one day; a backlog of many is shuffled, so that not every task opens a file for every day
        records = by_date(unpack(rows, kind, entity), PARTITIONS, F.xxhash64("payload"), "payload")
        folder = f"{entity}/batch={kind}-{number}"  # all of it is replaced
        counts[entity] = write_twins(records, f"{root}/parquet/{folder}", f"{root}/jsonl/{folder}", "overwrite", partitionOverwriteMode="static")
    broken = rows.filter(json_kind(F.col("body")).isin("invalid", "missing"))
    broken.write.mode("overwrite").json(f"{root}/quarantine/{kind}/batch={number}")
    return counts


def land_responses(spark: SparkSession, inbox: str, root: str, progress: str, kinds: list[str] | None = None) -> dict[str, int]:
    """Land every response file that is new since the last call; rows written by entity."""
    total = {entity: 0 for kind in kinds or KINDS for entity in KINDS[kind].entities}

    def take(kind: str) -> Callable[[DataFrame, int], None]:
        def batch(rows: DataFrame, number: int) -> None:
            for entity, n in land_batch(rows, kind, number, root).items():
                total[entity] += n

        return batch

    for kind in kinds or KINDS:
        arriving = spark.readStream.schema(RESPONSE).json(f"{inbox}/{kind}/*")
        running = arriving.writeStream.foreachBatch(take(kind)).option("checkpointLocation", f"{progress}/{kind}").trigger(availableNow=True).start()
        running.awaitTermination()
    return total


def still_to_fetch(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Ids that landed responses name and that have no record of their own yet, by the kind that fetches them."""
    landed = {e: scan_bronze(spark, root, e) for e in ("domain_discovery", "categories", "seller_items", "item_details", "item_descriptions")}
    have = {e: df.select(F.col("record_id").alias("id")) for e, df in landed.items()}
    named = {
        "categories": (responses.discovered_category_ids(landed["domain_discovery"]).withColumnRenamed("category_id", "id"), "categories"),
        "items": (responses.distinct_ids(have["seller_items"], "id"), "item_details"),
        "descriptions": (responses.distinct_ids(have["item_details"], "id"), "item_descriptions"),
    }
    return {kind: ids.join(have[entity], "id", "left_anti") for kind, (ids, entity) in named.items()}
