"""Bronze to Silver: parse, type, keep the latest record per key.

Payloads are parsed before the shuffle, so only the columns that are kept travel, not the JSON text; ties
on the ingestion time are settled by a payload hash. Fields of the wide tables travel as one packed text and
are typed for the rows that stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens import schemas
from bazaarlens.functions.dates import date_key, parse_utc
from bazaarlens.functions.numbers import to_number, to_whole_number
from bazaarlens.functions.payload import is_broken, parse_object
from bazaarlens.functions.text import PATH_SEPARATOR, joined_key, packed, packed_parts, unpacked, url_query_param
from bazaarlens.operators.dedup import keep_last_sound
from bazaarlens.operators.quality import TableRules, check_table
from bazaarlens.operators.relational import union_by_name

_TIE = "_tie"
_BROKEN = "_broken"


def parsed(bronze: DataFrame, payload_schema: str) -> DataFrame:
    """Envelope with the payload as struct ``p``; optional envelope columns absent here are null.

    Records whose payload is not JSON carry the flag ``_broken``: keep-last puts them behind all valid
    ones and then drops them, so that a broken one never replaces an older valid one. They go to
    :func:`broken_payloads`. Only payloads without a single field are looked at twice.
    """
    have = set(bronze.columns)
    column = {c: F.col(c) if c in have else F.lit(None).cast("string") for c in schemas.ENVELOPE}
    rows = bronze.select(
        parse_utc(column["ingested_at"]).alias("ingested_at"),
        column["source"].cast("string").alias("source"),
        column["endpoint"].alias("endpoint"),
        column["record_id"].alias("record_id"),
        parse_object(column["payload"], payload_schema).alias("p"),
        F.xxhash64(column["payload"]).alias(_TIE),
        column["payload"].alias("_payload"),
    )
    blank = F.lit(True)
    for name in rows.schema["p"].dataType.names:
        blank = blank & F.col("p").getField(name).isNull()
    broken = F.when(blank, is_broken(F.col("_payload"))).otherwise(False)
    return rows.withColumn(_BROKEN, broken).drop("_payload")


def _latest(records: DataFrame, keys: list[str]) -> DataFrame:
    return keep_last_sound(records, keys, "ingested_at", [_TIE], _BROKEN).drop(_TIE)


def _latest_payloads(records: DataFrame, keys: list[str]) -> DataFrame:
    """Latest row per key with its payload ``p``, all fields of which are text; they are sorted and sent as one."""
    names = records.schema["p"].dataType.names
    text = packed([F.col("p").getField(n) for n in names])
    narrow = records.select(*dict.fromkeys([*keys, "ingested_at", "source"]), text.alias("_text"), _TIE, _BROKEN)
    parts = _latest(narrow, keys).withColumn("_parts", packed_parts(F.col("_text"))).drop("_text")
    p = F.struct(*(unpacked(F.col("_parts"), i).alias(n) for i, n in enumerate(names)))
    return parts.withColumn("p", p).drop("_parts")


def latest_by_record(records: DataFrame) -> DataFrame:
    return _latest(records, ["record_id"])


def silver_domain_discovery(bronze: DataFrame) -> DataFrame:
    """One row per (search query, domain, category); the query comes from the landed endpoint."""
    rows = parsed(bronze, schemas.DOMAIN_PAYLOAD)
    query = url_query_param(F.col("endpoint"), "q")
    domain_category = joined_key(F.col("p.domain_id"), F.col("p.category_id"))
    named = rows.select(
        domain_category.alias("domain_category_id"),
        joined_key(query, domain_category).alias("query_domain_category_id"),
        "p.domain_id", "p.domain_name", "p.category_id", "p.category_name",
        query.alias("search_query"), "ingested_at", "source", _TIE, _BROKEN,
    )
    return _latest(named, ["query_domain_category_id"])


def silver_categories(bronze: DataFrame) -> DataFrame:
    """Latest record per category, with its path as text and its number of children."""
    names = F.transform(F.col("p.path_from_root"), lambda x: F.coalesce(x["name"], F.lit("")))
    rows = parsed(bronze, schemas.CATEGORY_PAYLOAD).select(
        "record_id",
        F.col("p.id").alias("category_id"),
        F.col("p.name").alias("category_name"),
        F.col("p.picture").alias("picture_url"),
        to_whole_number(F.col("p.total_items_in_this_category")).alias("total_items_in_this_category"),
        F.coalesce(F.array_join(names, PATH_SEPARATOR), F.lit("")).alias("path_from_root"),
        F.coalesce(F.array_size("p.children_categories"), F.lit(0)).cast("bigint").alias("children_categories_count"),
        F.col("p.attribute_types").alias("attribute_types"),
        F.col("p.settings.adult_content").try_cast("boolean").alias("settings_adult_content"),
        "ingested_at", "source", _TIE, _BROKEN,
    )
    return latest_by_record(rows).drop("record_id")


def silver_item_details(bronze: DataFrame) -> DataFrame:
    """Latest record per listing, 17 typed columns."""
    return _latest_payloads(parsed(bronze, schemas.ITEM_PAYLOAD), ["record_id"]).select(
        F.col("p.id").alias("item_id"),
        "p.title",
        to_number(F.col("p.price")).alias("price"),
        "p.currency_id",
        to_whole_number(F.col("p.available_quantity")).alias("available_quantity"),
        to_whole_number(F.col("p.sold_quantity")).alias("sold_quantity"),
        "p.status", "p.condition", "p.category_id", "p.listing_type_id", "p.permalink",
        "p.seller_id", "p.site_id",
        parse_utc(F.col("p.date_created")).alias("date_created"),
        parse_utc(F.col("p.last_updated")).alias("last_updated"),
        "ingested_at", "source",
    )


def silver_item_price_snapshots(bronze: DataFrame) -> DataFrame:
    """Every landed price per listing; only repeats of one (listing, time) collapse."""
    rows = parsed(bronze, schemas.PRICE_PAYLOAD).withColumn("_item", F.coalesce("p.item_id", "p.id"))
    return _latest_payloads(rows, ["_item", "ingested_at"]).select(
        F.col("_item").alias("item_id"),
        "p.seller_id", "p.category_id",
        to_number(F.col("p.price")).alias("price"),
        to_number(F.col("p.base_price")).alias("base_price"),
        to_number(F.col("p.original_price")).alias("original_price"),
        "p.currency_id",
        to_whole_number(F.col("p.available_quantity")).alias("available_quantity"),
        to_whole_number(F.col("p.sold_quantity")).alias("sold_quantity"),
        "p.status", "p.condition",
        parse_utc(F.col("p.last_updated")).alias("last_updated"),
        F.col("ingested_at").alias("snapshot_date"),
        date_key(F.col("ingested_at")).alias("snapshot_date_key"),
        "ingested_at", "source",
    )


def silver_item_descriptions(bronze: DataFrame) -> DataFrame:
    """Latest description per listing with its length in characters."""
    text = F.coalesce("p.plain_text", F.lit(""))
    rows = parsed(bronze, schemas.DESCRIPTION_PAYLOAD).select(
        "record_id",
        F.col("p.id").alias("item_id"),
        text.alias("plain_text"),
        F.char_length(text).cast("bigint").alias("text_length"),
        "ingested_at", "source", _TIE, _BROKEN,
    )
    return latest_by_record(rows).drop("record_id")


TRANSFORMS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "domain_discovery": silver_domain_discovery,
    "categories": silver_categories,
    "item_details": silver_item_details,
    "item_price_snapshots": silver_item_price_snapshots,
    "item_descriptions": silver_item_descriptions,
}

_DOMAIN_KEYS = ["query_domain_category_id", "domain_category_id", "domain_id", "category_id", "ingested_at"]
RULES: dict[str, TableRules] = {
    "domain_discovery": TableRules(
        "silver_domain_discovery", _DOMAIN_KEYS, _DOMAIN_KEYS, ["query_domain_category_id"]
    ),
    "categories": TableRules(
        "silver_categories",
        ["category_id", "category_name", "ingested_at"],
        ["category_id", "category_name", "ingested_at"],
        ["category_id"],
    ),
    "item_details": TableRules(
        "silver_item_details", ["item_id", "ingested_at"], ["item_id", "ingested_at"], ["item_id"]
    ),
    "item_price_snapshots": TableRules(
        "silver_item_price_snapshots", ["item_id", "snapshot_date"], ["item_id", "snapshot_date"]
    ),
    "item_descriptions": TableRules(
        "silver_item_descriptions", ["item_id", "ingested_at"], ["item_id", "ingested_at"], ["item_id"]
    ),
}


def silver_checks(silver: dict[str, DataFrame]) -> DataFrame:
    """Results of the per-table rules, one pass per table."""
    return union_by_name([check_table(df, RULES[name]) for name, df in silver.items()])


def broken_payloads(bronze: DataFrame) -> DataFrame:
    """Landed records whose payload is not JSON, for quarantine."""
    return bronze.filter(is_broken(F.col("payload")))


def build_silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: transform(bronze[name]) for name, transform in TRANSFORMS.items()}
