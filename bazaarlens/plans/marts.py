"""Staging, intermediate and mart layers over the star schema.

All of it stays lazy: Catalyst collapses the layers into one plan per mart and reads only the
columns the mart keeps.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.operators.quality import (
    References,
    TableRules,
    check_accepted_values,
    check_range,
    check_references,
    check_table,
)
from bazaarlens.fixed_values import COVERAGE_BANDS
from bazaarlens.operators.relational import count_distinct_or_zero, coverage_band, union_by_name
from bazaarlens.plans.gold import by_seller, sell_through, seller_group_aggregates

Tables = Mapping[str, DataFrame]

STAGING = {
    "stg_categories": (
        "dim_category",
        ["category_id", "category_name", "path_from_root", "attribute_types", "settings_adult_content"],
    ),
    "stg_domains": (
        "dim_domain",
        ["domain_category_id", "domain_id", "domain_name", "category_id", "category_name", "search_query"],
    ),
    "stg_dates": ("dim_date", ["date_key", "date", "year", "month", "day"]),
    "stg_category_snapshots": (
        "fact_category_snapshot",
        [
            "category_id", "snapshot_date_key", "domain_count", "total_items_in_this_category",
            "children_categories_count", "category_depth", "catalog_coverage_score",
        ],
    ),
    "stg_marketplace_overview": (
        "fact_marketplace_overview",
        [
            "snapshot_date_key", "total_categories", "total_domains", "total_items_in_categories",
            "avg_children_categories", "latest_ingestion_at",
        ],
    ),
}


def staging(star: Tables, name: str) -> DataFrame:
    table, columns = STAGING[name]
    return star[table].select(*columns)


def _calendar(star: Tables, key: str = "snapshot_date_key", date: str = "snapshot_date") -> DataFrame:
    """One row per calendar day, 366 a year at most, so it is broadcast: a day that holds a third of
    the facts is never shuffled by its date."""
    return F.broadcast(star["dim_date"].select(F.col("date_key").alias(key), F.col("date").alias(date)))


def stg_item_details(star: Tables) -> DataFrame:
    """Item snapshots with the item's attributes and the calendar date."""
    facts = star["fact_seller_item_snapshot"]
    joined = facts.join(star["dim_item"], "item_id", "left").join(_calendar(star), "snapshot_date_key", "left")
    return joined.select(
        "item_id", "title", "price", "available_quantity", "sold_quantity",
        F.coalesce("status", F.lit("unknown")).alias("status"),
        "condition", "category_id", "listing_type_id", "permalink", "seller_id",
        "snapshot_date_key", "snapshot_date",
    )


def int_category_domain_metrics(star: Tables) -> DataFrame:
    """Distinct domains discovered per category, 0 for a category without any."""
    categories = staging(star, "stg_categories").select("category_id", "category_name", "path_from_root")
    return count_distinct_or_zero(
        categories, staging(star, "stg_domains"), "category_id", "domain_category_id",
        "discovered_domain_count",
    )


def int_category_snapshot_enriched(star: Tables) -> DataFrame:
    names = star["dim_category"].select("category_id", "category_name")
    discovered = int_category_domain_metrics(star).select("category_id", "discovered_domain_count")
    joined = (
        staging(star, "stg_category_snapshots")
        .join(names, "category_id", "left")
        .join(_calendar(star), "snapshot_date_key", "left")
        .join(discovered, "category_id", "left")
    )
    return joined.select(
        "category_id", "category_name", "snapshot_date_key", "snapshot_date", "domain_count",
        "discovered_domain_count", "total_items_in_this_category", "children_categories_count",
        "category_depth", "catalog_coverage_score",
    )


def mart_category_metrics(star: Tables) -> DataFrame:
    return int_category_snapshot_enriched(star).withColumn(
        "coverage_band", coverage_band(F.col("catalog_coverage_score"))
    )


def mart_marketplace_overview(star: Tables) -> DataFrame:
    rows = staging(star, "stg_marketplace_overview").join(_calendar(star), "snapshot_date_key", "left")
    return rows.select(
        "snapshot_date_key", "snapshot_date", "total_categories", "total_domains",
        "total_items_in_categories", "avg_children_categories", "latest_ingestion_at",
    )


def mart_seller_item_metrics(star: Tables, items: DataFrame | None = None) -> DataFrame:
    """As the Gold seller table, but over item snapshots: raw price spread, latest calendar date.

    The latest date is found by its number and named afterwards: a maximum over text would force
    the whole aggregation to sort instead of hash. ``items`` are the joined item snapshots, if they are
    stored as ``mart_seller_items``; they are then dealt by their seller and not joined again.
    """
    dated = F.when(F.col("snapshot_date").isNotNull(), F.col("snapshot_date_key"))
    joined = (stg_item_details(star) if items is None else items).select(
        "seller_id", "category_id", "status", "item_id", "price", "available_quantity", "sold_quantity", dated.alias("_dated")
    )
    dealt = joined if items is None else by_seller(joined)
    grouped = dealt.groupBy("seller_id", "category_id", "status").agg(*seller_group_aggregates(), F.max("_dated").alias("_latest"))
    named = grouped.join(_calendar(star, "_latest", "latest_snapshot_date"), "_latest", "left")
    return named.select(
        "seller_id", "category_id", "status", "item_count", "active_item_count",
        "avg_price", "min_price", "max_price",
        "total_available_quantity", "total_sold_quantity",
        sell_through().alias("sell_through_rate"),
        (F.col("max_price") - F.col("min_price")).alias("price_spread"),
        "paused_item_count", "zero_sales_stock_count", "latest_snapshot_date",
    )


MART_SELLER_ITEMS = [
    "item_id", "title", "seller_id", "category_id", "status", "condition", "listing_type_id",
    "permalink", "price", "available_quantity", "sold_quantity", "snapshot_date_key", "snapshot_date",
]


def mart_seller_items(star: Tables) -> DataFrame:
    return stg_item_details(star).select(*MART_SELLER_ITEMS)


def seller_items_from_silver(item_details: DataFrame) -> DataFrame:
    """The item list rebuilt from Silver, for a lake whose marts are not published yet."""
    renamed = item_details.withColumnRenamed("ingested_at", "snapshot_date")
    keyed = renamed.withColumn("snapshot_date_key", F.date_format("snapshot_date", "yyyyMMdd").cast("bigint"))
    return keyed.select(*MART_SELLER_ITEMS)


MARTS = {
    "mart_category_metrics": mart_category_metrics,
    "mart_marketplace_overview": mart_marketplace_overview,
    "mart_seller_item_metrics": mart_seller_item_metrics,
    "mart_seller_items": mart_seller_items,
}


def build_marts(star: Tables) -> Tables:
    return {name: build(star) for name, build in MARTS.items()}


# --- data tests ------------------------------------------------------------------------------

KEY_RULES = [
    TableRules("dim_category", non_null=["category_id", "category_name"], unique=["category_id"]),
    TableRules("dim_domain", non_null=["domain_category_id", "domain_id", "category_id"], unique=["domain_category_id"]),
    TableRules("dim_date", non_null=["date_key"], unique=["date_key"]),
    TableRules("dim_seller", unique=["seller_id"]),
    TableRules("dim_item", non_null=["item_id"], unique=["item_id"]),
    TableRules("fact_category_snapshot", non_null=["category_id", "snapshot_date_key"]),
    TableRules("fact_marketplace_overview", non_null=["snapshot_date_key"], unique=["snapshot_date_key"]),
    TableRules("fact_seller_item_snapshot", non_null=["item_id", "snapshot_date_key"]),
    TableRules(
        "mart_category_metrics", non_null=["category_id", "snapshot_date_key", "catalog_coverage_score"]
    ),
    TableRules(
        "mart_marketplace_overview",
        non_null=["snapshot_date_key", "total_categories", "total_domains"],
        unique=["snapshot_date_key"],
    ),
    TableRules(
        "mart_seller_item_metrics",
        non_null=[
            "status", "item_count", "active_item_count", "total_available_quantity",
            "total_sold_quantity", "sell_through_rate", "paused_item_count", "zero_sales_stock_count",
        ],
    ),
    TableRules("mart_seller_items", non_null=["item_id", "status", "snapshot_date_key"]),
]

REFERENCE_RULES = [
    References("dim_item", "seller_id", "dim_seller", "seller_id"),
    References("fact_category_snapshot", "category_id", "dim_category", "category_id"),
    References("fact_category_snapshot", "snapshot_date_key", "dim_date", "date_key"),
    References("fact_seller_item_snapshot", "item_id", "dim_item", "item_id"),
    References("fact_seller_item_snapshot", "snapshot_date_key", "dim_date", "date_key"),
]


def key_checks(tables: Tables) -> DataFrame:
    """Not-null and unique tests, one pass per table."""
    return union_by_name([check_table(tables[r.dataset], r) for r in KEY_RULES])


def reference_checks(tables: Tables) -> DataFrame:
    return check_references(tables, REFERENCE_RULES)


def band_check(mart: DataFrame) -> DataFrame:
    return check_accepted_values(mart, "mart_category_metrics_coverage_band", "coverage_band", COVERAGE_BANDS)


def range_checks(items: DataFrame, categories: DataFrame, sellers: DataFrame) -> DataFrame:
    return union_by_name(
        [
            check_range(categories, "category_scores_between_0_and_100", ["catalog_coverage_score"], 0, 100),
            check_range(items, "seller_item_prices_non_negative", ["price"], low=0),
            check_range(items, "seller_item_quantities_non_negative", ["available_quantity", "sold_quantity"], low=0),
            check_range(sellers, "seller_item_sell_through_between_0_and_100", ["sell_through_rate"], 0, 100),
        ]
    )
