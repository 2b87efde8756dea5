"""Star schema: five dimensions and three facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.dates import date_key
from bazaarlens.operators.dedup import keep_first, keep_first_of_rare


def dim_category(categories: DataFrame) -> DataFrame:
    first = keep_first(
        categories.select(
            "category_id", "category_name", "path_from_root", "attribute_types",
            "settings_adult_content", "ingested_at",
        ),
        ["category_id"], "ingested_at", ["category_name"],
    )
    return first.drop("ingested_at")


def dim_domain(domains: DataFrame) -> DataFrame:
    """One row per (domain, category), with the earliest search term that led to it."""
    first = keep_first(
        domains.select(
            "domain_category_id", "domain_id", "domain_name", "category_id", "category_name",
            "search_query", "ingested_at",
        ),
        ["domain_category_id"], "ingested_at", ["search_query"],
    )
    return first.drop("ingested_at")


def dim_seller(item_details: DataFrame) -> DataFrame:
    return item_details.select("seller_id").dropna().distinct()


def dim_item(item_details: DataFrame) -> DataFrame:
    columns = ["item_id", "title", "category_id", "seller_id", "condition", "listing_type_id", "permalink"]
    rows = item_details.select(*columns, "ingested_at").dropna(subset=["item_id"])
    return keep_first_of_rare(rows, ["item_id"], "ingested_at", ["title"]).drop("ingested_at")


def dim_date(*ingestion_times: DataFrame) -> DataFrame:
    """Calendar days on which anything was ingested; inputs are one-column frames of times.

    Days are made distinct per task before the shuffle, so it carries days, not rows.
    """
    days = [df.select(F.to_date(df[df.columns[0]]).alias("day")) for df in ingestion_times]
    day = F.col("day")
    distinct = reduce(DataFrame.unionAll, days).filter("day is not null").distinct()
    return distinct.select(
        F.date_format(day, "yyyyMMdd").cast("bigint").alias("date_key"),
        F.date_format(day, "yyyy-MM-dd").alias("date"),
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.dayofmonth(day).cast("bigint").alias("day"),
    )


def fact_category_snapshot(metrics: DataFrame, categories: DataFrame) -> DataFrame:
    stamped = metrics.join(
        categories.select("category_id", date_key(F.col("ingested_at")).alias("snapshot_date_key")),
        "category_id", "left",
    )
    return stamped.select(
        "category_id", "snapshot_date_key", "domain_count", "total_items_in_this_category",
        "children_categories_count", "category_depth", "catalog_coverage_score",
    )


def fact_marketplace_overview(overview: DataFrame) -> DataFrame:
    return overview.select(
        date_key(F.col("latest_ingestion_at")).alias("snapshot_date_key"),
        "total_categories", "total_domains", "total_items_in_categories",
        "avg_children_categories", "latest_ingestion_at",
    )


def fact_seller_item_snapshot(item_details: DataFrame) -> DataFrame:
    return item_details.dropna(subset=["item_id", "ingested_at"]).select(
        "item_id", date_key(F.col("ingested_at")).alias("snapshot_date_key"),
        "price", "available_quantity", "sold_quantity", "status",
    )


def _calendar(categories: DataFrame, domains: DataFrame, items: DataFrame, overview: DataFrame) -> DataFrame:
    ingested = [df.select("ingested_at") for df in (categories, domains, items)]
    return dim_date(*ingested, overview.select("latest_ingestion_at"))


# table -> its builder and the inputs it takes; dimensions before the facts that refer to them
STAR = {
    "dim_category": (dim_category, ["categories"]),
    "dim_domain": (dim_domain, ["domains"]),
    "dim_seller": (dim_seller, ["items"]),
    "dim_item": (dim_item, ["items"]),
    "dim_date": (_calendar, ["categories", "domains", "items", "overview"]),
    "fact_category_snapshot": (fact_category_snapshot, ["metrics", "categories"]),
    "fact_marketplace_overview": (fact_marketplace_overview, ["overview"]),
    "fact_seller_item_snapshot": (fact_seller_item_snapshot, ["items"]),
}


def build_star(
    categories: DataFrame, domains: DataFrame, items: DataFrame, metrics: DataFrame, overview: DataFrame
) -> dict[str, DataFrame]:
    """The eight tables, dimensions before the facts that refer to them."""
    inputs = {"categories": categories, "domains": domains, "items": items, "metrics": metrics, "overview": overview}
    return {name: build(*(inputs[i] for i in needed)) for name, (build, needed) in STAR.items()}
