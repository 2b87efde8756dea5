"""Landed API response bodies to payload rows.

Input frames hold one response per row in a JSON text column; nothing is grouped, so each body is
unpacked where it was read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.payload import is_object, is_text, is_whole_number, json_elements
from bazaarlens.schemas import PRICE_PAYLOAD


def _explode_where(df: DataFrame, elements, keep) -> DataFrame:
    return df.withColumn("_e", F.explode(F.filter(elements, keep)))


def unwrap_multiget(df: DataFrame, body: str) -> DataFrame:
    """``[{code, body}, ...]`` to one ``payload`` per object body with a 2xx code."""

    def usable(e):
        code = F.try_variant_get(e, "$.code", "bigint")
        return (
            is_whole_number(F.try_variant_get(e, "$.code", "variant"))
            & code.between(200, 299)
            & is_object(F.try_variant_get(e, "$.body", "variant"))
        )

    rows = _explode_where(df, json_elements(F.col(body)), lambda e: is_object(e) & usable(e))
    return rows.withColumn("payload", F.to_json(F.try_variant_get("_e", "$.body", "variant"))).drop("_e")


def explode_listing_ids(df: DataFrame, body: str, seller: str, kept: Sequence[str] = ()) -> DataFrame:
    """Text ids of ``results`` as ``id`` with the requested ``seller_id``, after the columns ``kept``."""
    results = json_elements(F.get_json_object(F.col(body), "$.results"))
    rows = _explode_where(df, results, is_text)
    return rows.select(
        *kept, F.variant_get("_e", "$", "string").alias("id"), F.col(seller).cast("string").alias("seller_id")
    )


def explode_search_results(df: DataFrame, body: str) -> DataFrame:
    """Object entries of ``results`` as ``payload``."""
    results = json_elements(F.get_json_object(F.col(body), "$.results"))
    return _explode_where(df, results, is_object).withColumn("payload", F.to_json("_e")).drop("_e")


def explode_objects(df: DataFrame, body: str) -> DataFrame:
    """Object entries of a JSON list as ``payload``; other entries are dropped."""
    return _explode_where(df, json_elements(F.col(body)), is_object).withColumn("payload", F.to_json("_e")).drop("_e")


def explode_categories(df: DataFrame, body: str) -> DataFrame:
    """A category list given bare or under ``categories``."""
    listed = F.coalesce(
        json_elements(F.col(body)), json_elements(F.get_json_object(F.col(body), "$.categories"))
    )
    return _explode_where(df, listed, is_object).withColumn("payload", F.to_json("_e")).drop("_e")


PRICE_FIELDS = [f.split()[0] for f in PRICE_PAYLOAD.split(", ")]


def price_snapshot_payloads(df: DataFrame, payload: str = "payload", kept: Sequence[str] = ()) -> DataFrame:
    """The 13 price and stock fields of each item payload, after the columns ``kept``; items without an id are dropped."""
    p = F.from_json(F.col(payload), PRICE_PAYLOAD)
    rows = df.withColumn("_p", p).filter("_p.id is not null and _p.id <> ''")
    return rows.select(*kept, *(F.col("_p.id" if f == "item_id" else f"_p.{f}").alias(f) for f in PRICE_FIELDS))


def merge_id(df: DataFrame, payload: str, requested_id: str) -> DataFrame:
    """Description payloads with the requested id inside, and as ``id``; an id already inside wins."""
    inner = F.get_json_object(F.col(payload), "$.id")
    fields = F.map_filter(F.from_json(F.col(payload), "map<string,variant>"), lambda k, _: k != "id")
    asked = F.col(requested_id).cast("string")
    own = F.map_from_arrays(F.array(F.lit("id")), F.array(F.parse_json(F.to_json(F.array(asked)))))
    one = F.transform_values(own, lambda _, v: F.variant_get(v, "$[0]", "variant"))
    merged = F.when(inner.isNull() & fields.isNotNull(), F.to_json(F.map_concat(one, fields))).otherwise(F.col(payload))
    return df.withColumn("id", F.coalesce(inner, asked)).withColumn(payload, merged)


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    """Each non-empty id once."""
    return df.select(F.col(column).cast("string").alias(column)).filter(F.col(column) != "").distinct()


def discovered_category_ids(domain_payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Distinct category ids named by discovered domains."""
    found = domain_payloads.select(F.get_json_object(payload, "$.category_id").alias("category_id"))
    return distinct_ids(found, "category_id")
