"""Silver to Gold: category, marketplace, search-term, seller and price metrics.

The frames come back unordered; :func:`in_report_order` sorts for presentation only, because a
global sort before a write would be a shuffle that no reader needs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.numbers import exact_mean, np_round, percent_of, sum_or_zero
from bazaarlens.functions.text import path_depth
from bazaarlens.operators.dedup import keep_first
from bazaarlens.operators.previous import HOT_KEY_ROWS, with_previous
from bazaarlens.operators.relational import count_distinct_or_zero
from bazaarlens.operators.stats import relative_to_max, whole_table

REPORT_ORDER = {
    "category_metrics": [("catalog_coverage_score", True), ("category_id", False)],
    "public_query_metrics": [("domain_count", True), ("category_count", True), ("search_query", False)],
    "seller_item_metrics": [
        ("item_count", True), ("seller_id", False), ("category_id", False), ("status", False),
    ],
    "price_history": [("item_id", False), ("snapshot_date", False)],
}


def order_columns(name: str) -> list[Column]:
    """Report order; nulls come last whichever the direction."""
    return [
        F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()
        for c, descending in REPORT_ORDER[name]
    ]


def in_report_order(df: DataFrame, name: str) -> DataFrame:
    return df.orderBy(*order_columns(name))


def gold_category_metrics(categories: DataFrame, domains: DataFrame) -> DataFrame:
    """Domain count, depth and item coverage (relative to the largest category) per category."""
    items = F.coalesce("total_items_in_this_category", F.lit(0))
    counted = count_distinct_or_zero(categories, domains, "category_id", "domain_id", "domain_count")
    return counted.select(
        "category_id",
        "category_name",
        "domain_count",
        "total_items_in_this_category",
        "children_categories_count",
        path_depth(F.col("path_from_root")).alias("category_depth"),
        np_round(relative_to_max(categories, items), 2).alias("catalog_coverage_score"),
    )


def gold_marketplace_overview(categories: DataFrame, domains: DataFrame) -> DataFrame:
    """One row of totals; zeros and a null time for empty inputs."""
    domain_stats = whole_table(
        domains, n=F.count_distinct("domain_id"), latest=F.max("ingested_at")
    )
    children = F.col("children_categories_count")
    mean_children = F.try_divide(F.sum(children).cast("double"), F.count(children))
    totals = categories.agg(
        F.count_distinct("category_id").alias("total_categories"),
        sum_or_zero(F.col("total_items_in_this_category")).alias("total_items_in_categories"),
        F.count(F.lit(1)).alias("_rows"),
        np_round(mean_children, 2).alias("_children"),
        F.max("ingested_at").alias("_latest"),
    )
    return totals.select(
        "total_categories",
        domain_stats.getField("n").alias("total_domains"),
        "total_items_in_categories",
        F.when(F.col("_rows") == 0, F.lit(0.0)).otherwise(F.col("_children")).alias("avg_children_categories"),
        F.greatest("_latest", domain_stats.getField("latest")).alias("latest_ingestion_at"),
    )


def gold_public_query_metrics(categories: DataFrame, domains: DataFrame) -> DataFrame:
    """Reach of each search term. Items of a category count once per domain row that leads to it.

    Domain rows are first reduced to one row per (term, category): a category or term with a third
    of the rows reaches the lookup join as a single row per pair.
    """
    if "search_query" not in domains.columns:
        domains = domains.withColumn("search_query", F.lit("unknown"))
    lookup = keep_first(
        categories.select("category_id", "total_items_in_this_category", "ingested_at"),
        ["category_id"], "ingested_at", ["total_items_in_this_category"],
    ).select("category_id", F.coalesce("total_items_in_this_category", F.lit(0)).alias("items"))
    has_time = "ingested_at" in domains.columns
    pairs = domains.groupBy("search_query", "category_id").agg(
        F.count(F.lit(1)).alias("n"),
        *([F.max("ingested_at").alias("latest")] if has_time else []),
    )
    if not has_time:
        # without a time of its own a domain row takes the time of its category
        times = categories.groupBy("category_id").agg(F.min("ingested_at").alias("latest"))
        pairs = pairs.join(times, "category_id", "left")
    reached = lookup.join(domains.select("category_id"), "category_id", "left_semi")
    peak = whole_table(reached, peak=F.max("items")).getField("peak")
    per_query = (
        pairs.join(lookup, "category_id", "left")
        .withColumn("weighted", F.coalesce("items", F.lit(0)) * F.col("n"))
        .groupBy("search_query")
        .agg(
            F.count("category_id").alias("category_count"),
            F.sum("weighted").cast("bigint").alias("total_items_in_categories"),
            F.sum("n").alias("_rows"),
            F.max("latest").alias("latest_ingestion_at"),
        )
    )
    score = F.when(
        peak > 0,
        F.try_divide(
            F.col("total_items_in_categories").cast("double") * 100,
            (peak * F.col("_rows")).cast("double"),
        ),
    ).otherwise(F.lit(0.0))
    domain_counts = domains.groupBy(F.col("search_query").alias("_query")).agg(
        F.count_distinct("domain_id").alias("domain_count")
    )
    return per_query.join(domain_counts, F.col("search_query").eqNullSafe(F.col("_query"))).select(
        "search_query",
        "category_count",
        "domain_count",
        "total_items_in_categories",
        np_round(score, 2).alias("avg_catalog_coverage_score"),
        "latest_ingestion_at",
    )


def seller_group_aggregates() -> list[Column]:
    """The aggregates shared by the Gold table and the mart; status is already non-null."""
    status = F.col("status")
    stock = F.coalesce("available_quantity", F.lit(0))
    sold = F.coalesce("sold_quantity", F.lit(0))
    return [
        F.count_distinct("item_id").alias("item_count"),
        F.count_if(status == "active").alias("active_item_count"),
        np_round(exact_mean(F.col("price")), 2).alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum(stock).cast("bigint").alias("total_available_quantity"),
        F.sum(sold).cast("bigint").alias("total_sold_quantity"),
        F.count_if(status == "paused").alias("paused_item_count"),
        F.count_if((stock > 0) & (sold == 0)).alias("zero_sales_stock_count"),
    ]


def sell_through() -> Column:
    sold = F.col("total_sold_quantity")
    return np_round(percent_of(sold, F.col("total_available_quantity") + sold), 2)


HOT_SELLER = 2_000_000  # rows that one task may take for a seller
ROWS_PER_TASK = 1_000_000
WRITERS = 200  # up to so many partitions a task writes its rows as they come, without a buffer


def by_seller(items: DataFrame) -> DataFrame:
    """Rows dealt by their seller, if none has more than ``HOT_SELLER``, so that groups and their distinct
    items need no other shuffle. Else they stay, and Spark deals them by group and item and then by group.

    Give it a stored frame: sellers are counted first.
    """
    most, rows = items.groupBy("seller_id").count().agg(F.max("count"), F.sum("count")).first()
    if (most or 0) > HOT_SELLER:
        return items
    least = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return items.repartition(max(least, min(WRITERS, math.ceil((rows or 0) / ROWS_PER_TASK))), "seller_id")


def gold_seller_item_metrics(item_details: DataFrame) -> DataFrame:
    """Metrics per (seller, category, status); null sellers and categories keep their group."""
    items = by_seller(item_details).withColumn("status", F.coalesce("status", F.lit("unknown")))
    grouped = items.groupBy("seller_id", "category_id", "status").agg(
        *seller_group_aggregates(), F.max("ingested_at").alias("latest_ingestion_at")
    )
    return grouped.select(
        "seller_id", "category_id", "status", "item_count", "active_item_count",
        "avg_price", "min_price", "max_price",
        "total_available_quantity", "total_sold_quantity",
        sell_through().alias("sell_through_rate"),
        np_round(F.col("max_price") - F.col("min_price"), 2).alias("price_spread"),
        "paused_item_count", "zero_sales_stock_count", "latest_ingestion_at",
    )


def gold_price_history(item_price_snapshots: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Each snapshot with its change against the listing's previous snapshot."""
    before = {"_price": "price", "_stock": "available_quantity", "_sold": "sold_quantity"}
    rows = with_previous(item_price_snapshots, "item_id", "snapshot_date", before, hot_rows=hot_rows)
    change = F.col("price") - F.col("_price")
    return rows.select(
        "item_id", "seller_id", "category_id", "snapshot_date_key", "snapshot_date",
        "price", "base_price", "original_price", "currency_id",
        "available_quantity", "sold_quantity", "status",
        np_round(change, 2).alias("price_change_abs"),
        np_round(
            F.when(F.col("_price") > 0, F.try_divide(change, F.col("_price")) * 100), 2
        ).alias("price_change_pct"),
        (F.col("available_quantity") - F.col("_stock")).alias("stock_change"),
        (F.col("sold_quantity") - F.col("_sold")).alias("sold_change"),
    )


def build_gold(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    categories, domains = silver["categories"], silver["domain_discovery"]
    return {
        "category_metrics": gold_category_metrics(categories, domains),
        "marketplace_overview": gold_marketplace_overview(categories, domains),
        "public_query_metrics": gold_public_query_metrics(categories, domains),
        "seller_item_metrics": gold_seller_item_metrics(silver["item_details"]),
        "price_history": gold_price_history(silver["item_price_snapshots"]),
    }
