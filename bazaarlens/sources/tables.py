"""Table reads and writes: Parquet, optional inputs, star-schema publishing, fact history, JDBC."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bazaarlens.session import FREED, settings

ROWS_PER_FILE = 2_000_000
BYTES_PER_TASK = 100_000_000  # text that a task of a dated write sorts and writes
# A row group is the least a scan task can take. Parsing a payload costs far more than reading it, so
# payload tables have small groups: about 15 MB of text and a second of parsing each.
# Their files are small as well: a split counts 4 MB for each file it opens, so that it holds no more well packed
# rows than a task can sort.
PAYLOAD_GROUP = {
    "parquet.block.row.count.limit": "50000", "maxRecordsPerFile": "100000",
    "compression": "zstd", "parquet.compression.codec.zstd.level": "6",
}
COMPACT = {"compression": "zstd"}


def write_table(
    df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, options: Mapping[str, str] | None = None
) -> int:
    """Overwrite a Parquet table; returns the row count taken during the write.

    Files are capped in rows, so that one large write task does not leave a file that only a few
    readers can share. ``options`` go to the Parquet writer.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    with settings(df.sparkSession, FREED):
        writer.options(**{**COMPACT, **(options or {})}).parquet(path)
    return int(seen.get["rows"])


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or an empty frame with the same columns when there is none."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def table_or(spark: SparkSession, name: str, fallback: DataFrame) -> DataFrame:
    """The catalogued table, or the frame rebuilt from a lower layer."""
    return spark.table(name) if spark.catalog.tableExists(name) else fallback


def query(df_by_name: Mapping[str, DataFrame], sql: str, **params: Any) -> DataFrame:
    """SQL over frames named ``{name}`` in the text, with ``:param`` markers bound by Spark."""
    spark = next(iter(df_by_name.values())).sparkSession
    return spark.sql(sql, args=params or None, **df_by_name)


def publish(tables: Mapping[str, DataFrame], root: str) -> dict[str, int]:
    """Replace every table under ``root`` in the given (dependency) order; row counts by name."""
    return {name: write_table(df, f"{root}/{name}") for name, df in tables.items()}


POINTER = "version string, published_at timestamp, tables map<string,bigint>"


def publish_together(tables: Mapping[str, DataFrame], root: str) -> dict[str, int]:
    """Publish all tables at once: each is written below a new version, and a pointer to it is appended last.

    Readers follow the latest pointer, so until then, and after a failure on the way, they see the tables
    of the version before, all of one run. Row counts by name.
    """
    spark, version = next(iter(tables.values())).sparkSession, uuid.uuid4().hex
    counts = publish(tables, f"{root}/versions/{version}")
    pointer = spark.range(1).select(
        F.lit(version).alias("version"), F.current_timestamp().alias("published_at"), F.from_json(F.lit(json.dumps(counts)), "map<string,bigint>").alias("tables")
    )
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/published")
    return counts


def published_root(spark: SparkSession, root: str) -> str:
    """The folder of the version published last."""
    latest = read_optional(spark, f"{root}/published", POINTER).orderBy(F.desc("published_at"), "version").head(1)
    if not latest:
        raise ValueError(f"nothing has been published under {root}")
    return f"{root}/versions/{latest[0]['version']}"


def by_date(df: DataFrame, dates: Sequence[str], spread: Column, text: str | None = None) -> DataFrame:
    """Range-shuffle rows by date and ``spread`` for a write partitioned by date.

    A small date lands in one or two files, and a date with a third of all rows is cut over as many
    tasks as it fills. One pass over the date columns sizes the shuffle: at most ``ROWS_PER_FILE``
    rows a task, and enough tasks to write many small dates side by side. Rows with a long ``text``
    are counted by its bytes as well, ``BYTES_PER_TASK`` a task: a few long texts fill a task long before
    so many rows do. Give it a stored frame.
    """
    length = F.octet_length(text) if text else F.lit(0)
    with settings(df.sparkSession, FREED):
        size = df.agg(
            F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.struct(*dates)).alias("dates"),
            F.coalesce(F.sum(length.cast("bigint")), F.lit(0)).alias("bytes"),
        ).first()
    parallel = df.sparkSession.sparkContext.defaultParallelism
    filled = max(math.ceil(size["rows"] / ROWS_PER_FILE), math.ceil(size["bytes"] / BYTES_PER_TASK))
    return df.repartitionByRange(max(1, filled, min(size["dates"], parallel)), *dates, spread)


def append_snapshots(fact: DataFrame, path: str, spread: str, key: str = "snapshot_date_key") -> None:
    """Replace only the snapshot dates present in ``fact``; earlier dates stay.

    ``spread`` is the entity id by which a large date is cut into files.
    """
    writer = by_date(fact, [key], F.col(spread)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with settings(fact.sparkSession, FREED):
        writer.options(**COMPACT).partitionBy(key).parquet(path)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None) -> dict[str, str]:
    """Options of a truncate-and-append load, in batches and with a bounded number of sessions."""
    options = {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "batchsize": "10000",
        "numPartitions": "16",
    }
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def publish_jdbc(tables: Mapping[str, DataFrame], url: str, schema: str, **credentials: str) -> None:
    """Load every table into a database over JDBC, keeping the target's DDL."""
    for name, df in tables.items():
        options = jdbc_options(url, f"{schema}.{name}", **credentials)
        df.write.format("jdbc").options(**options).mode("overwrite").save()
