"""Date and time expressions (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_utc(text: Column) -> Column:
    """ISO text to timestamp; null for anything else. Timestamps pass through."""
    return F.try_to_timestamp(text.cast("string"))


def date_key(ts: Column) -> Column:
    """``YYYYMMDD`` as bigint."""
    return F.date_format(ts, "yyyyMMdd").cast("bigint")


def iso_text(ts: Column) -> Column:
    """``2026-09-10T11:00:00+00:00``; microseconds only when there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, ".SSSSSS")
    return F.concat(whole, F.when(micros == ".000000", F.lit("")).otherwise(micros), F.lit("+00:00"))


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def day_parts(ts: Column) -> list[Column]:
    """Zero-padded ``year``, ``month``, ``day`` texts for a partitioned layout."""
    return [
        F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
    ]
