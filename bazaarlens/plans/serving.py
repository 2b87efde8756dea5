"""Served queries: pages with totals, lookups, filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.dates import iso_text
from bazaarlens.operators.paging import page
from bazaarlens.operators.relational import equal_filters
from bazaarlens.plans.gold import in_report_order, order_columns


def iso_times(df: DataFrame) -> DataFrame:
    """Served rows carry times as ISO text."""
    return df.select(
        *(iso_text(F.col(n)).alias(n) if t.startswith("timestamp") else F.col(n) for n, t in df.dtypes)
    )


def overview(mart: DataFrame) -> DataFrame:
    return iso_times(mart.orderBy(F.col("snapshot_date_key").desc_nulls_last()))


def categories_page(mart: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    order = [*order_columns("category_metrics"), F.col("snapshot_date_key").desc()]
    return page(mart, order, limit, offset)


def category(mart: DataFrame, category_id: str) -> DataFrame:
    """No row or the rows of one category; the equality reaches the Parquet filter."""
    return mart.filter(F.col("category_id") == category_id)


def seller_metrics_page(mart: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    return page(iso_times(mart), order_columns("seller_item_metrics"), limit, offset)


def seller_items_page(
    mart: DataFrame,
    limit: int = 50,
    offset: int = 0,
    seller_id: str | None = None,
    category_id: str | None = None,
    status: str | None = None,
) -> DataFrame:
    wanted = equal_filters(mart, seller_id=seller_id, category_id=category_id, status=status)
    order = [F.col("snapshot_date_key").desc_nulls_last(), F.col("item_id").asc_nulls_last()]
    return page(iso_times(wanted), order, limit, offset)


def scores_page(scores: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    return page(scores, [F.col("opportunity_rank"), F.col("category_id"), F.col("snapshot_date_key")], limit, offset)


def anomalies(scores: DataFrame) -> DataFrame:
    return scores.filter("is_anomaly").orderBy(F.col("anomaly_score").desc_nulls_last(), "category_id")


def price_history_page(history: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    order = [
        F.col("snapshot_date_key").desc_nulls_last(),
        F.col("item_id").asc_nulls_last(),
        F.col("snapshot_date").desc_nulls_last(),
    ]
    paged = page(history, order, limit, offset)
    return iso_times(paged)


def query_metrics(metrics: DataFrame) -> DataFrame:
    return in_report_order(metrics, "public_query_metrics")
