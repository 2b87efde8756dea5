"""Bronze: landed payloads in their envelope, as date-partitioned Parquet and JSON-lines twins."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bazaarlens.functions.dates import day_parts, parse_utc
from bazaarlens.schemas import BRONZE, ENVELOPE
from bazaarlens.session import FREED, settings
from bazaarlens.sources.tables import PAYLOAD_GROUP, by_date

PARTITIONS = ["year", "month", "day"]
JSONL = {"compression": "gzip", "maxRecordsPerFile": "200000"}  # such a file is read by one task
LINES_SPLIT = {"spark.sql.files.maxPartitionBytes": "64m"}  # packed records that a task sorts by day as lines


def envelope(payloads: DataFrame, payload: str, source: str, endpoint: Column | str, ingested_at: Column) -> DataFrame:
    """Wrap JSON payload texts. ``record_id`` is the first non-empty of id, domain_id, category_id."""
    endpoint = F.lit(endpoint) if isinstance(endpoint, str) else endpoint
    ids = F.from_json(F.col(payload), "id string, domain_id string, category_id string")
    record_id = F.coalesce(*(F.nullif(ids.getField(f), F.lit("")) for f in ("id", "domain_id", "category_id")))
    return payloads.select(
        ingested_at.cast("string").alias("ingested_at"),
        F.lit(source).alias("source"),
        endpoint.alias("endpoint"),
        record_id.alias("record_id"),
        F.col(payload).alias("payload"),
    )


def partitioned(records: DataFrame) -> DataFrame:
    """Records with zero-padded ``year``, ``month``, ``day`` of their ingestion time."""
    ts = parse_utc(F.col("ingested_at"))
    return records.select(*ENVELOPE, *day_parts(ts))


def json_lines(dated: DataFrame) -> DataFrame:
    """One JSON text per record, with its date parts."""
    # in valid JSON, line feeds only stand between tokens; a broken payload stays as a JSON string
    quoted = F.to_json(F.array("payload"))
    value = F.when(F.try_parse_json("payload").isNotNull(), F.translate("payload", "\r\n", "  ")).otherwise(
        F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    )
    head = F.to_json(F.struct(*ENVELOPE[:-1]), {"ignoreNullFields": "false"})
    line = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(', "payload": '), F.coalesce(value, F.lit("null")), F.lit("}"))
    return dated.select(line.alias("value"), *PARTITIONS)


def write_twins(dated: DataFrame, parquet: str, jsonl: str, mode: str, **options: str) -> int:
    """Write both twins of dated records; returns the row count, observed during the Parquet write.

    The JSON lines are made of the Parquet files just written, known by their names, each of which holds one
    day: however the records were dealt, they are dealt once, and those files go before the lines are written.
    """
    spark, seen, name = dated.sparkSession, Observation(), f"part-{uuid.uuid4().hex}"
    counted = dated.observe(seen, F.count(F.lit(1)).alias("rows"))
    named = {**PAYLOAD_GROUP, **options, "mapreduce.output.basename": name}
    with settings(spark, FREED):
        counted.write.mode(mode).options(**named).partitionBy(*PARTITIONS).parquet(parquet)
    rows = int(seen.get["rows"])
    written = spark.read.schema(BRONZE).option("pathGlobFilter", f"{name}-*").parquet(parquet)
    with settings(spark, LINES_SPLIT):
        json_lines(written).write.mode(mode).options(**JSONL, **options).partitionBy(*PARTITIONS).text(jsonl)
    return rows


def write_bronze(records: DataFrame, root: str, entity: str, many_days: bool = False) -> int:
    """Append both twins under ``root``; returns the row count.

    The Parquet payload is JSON text; the JSON-lines payload is the object itself, written as compressed
    text so that no schema has to be inferred.

    One landing has one day, so its tasks write side by side without a shuffle. A backfill over
    ``many_days`` is range-shuffled by day and payload first; otherwise every task would open a
    file for every day.
    """
    dated = partitioned(records)
    if many_days:
        dated = by_date(dated, PARTITIONS, F.xxhash64("payload"), "payload")
    return write_twins(dated, f"{root}/parquet/{entity}", f"{root}/jsonl/{entity}", "append")


def scan_bronze(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """All Parquet records of an entity; empty when nothing has landed.

    The schema is given: columns absent in older files read as null, and ``month`` stays ``"09"``.
    """
    try:
        return spark.read.schema(BRONZE).parquet(f"{root}/parquet/{entity}").drop("batch")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], BRONZE)


def scan_jsonl(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """The JSON-lines twin, with the payload back as JSON text."""
    return spark.read.schema(BRONZE).json(f"{root}/jsonl/{entity}")
