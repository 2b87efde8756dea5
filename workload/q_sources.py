"""Sources, sinks, response normalisers and Silver transforms (inventory 2.1 to 2.3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens import schemas
from bazaarlens.functions.text import url_query_param
from bazaarlens.plans import gold, marts, scoring, silver
from bazaarlens.session import scratch_path
from bazaarlens.sources import bronze, documents, responses, tables
from bazaarlens.streaming import landing
from workload import check_views  # noqa: F401
from workload.check_views import date_key
from workload.inputs import Lake
from workload.registry import ORACLES, query, view

# --- sources and sinks -----------------------------------------------------------------------

view(
    "landed_categories",
    """
select p_brand, p_type, p_brand || '-' || p_type as category_id, year(l_shipdate) as y,
    cast(sum(cast(l_quantity as bigint)) as bigint) as items, count(distinct p_size) as children, max(l_shipdate) as landed
from lineitem join part on l_partkey = p_partkey
group by p_brand, p_type, year(l_shipdate)
""",
)
view(
    "landed_lines",
    """
select *, 'I' || l_partkey || '-' || l_suppkey as item_id,
    l_shipdate + to_microseconds(l_orderkey * 8 + l_linenumber) as landed
from lineitem join part on l_partkey = p_partkey
""",
)


_LANDED: dict[tuple[str, str, str], tuple[str, int]] = {}


def _landed_root(lake: Lake, entity: str) -> tuple[str, int]:
    """Root and row count of an entity landed in date folders, once per session."""
    key = (lake.spark.sparkContext.applicationId, lake.dir, entity)
    if key not in _LANDED:
        root = scratch_path(lake.spark, "landing")
        _LANDED[key] = root, bronze.write_bronze(lake.bronze(entity), root, entity, many_days=True)
    return _LANDED[key]


@query(
    "scan_bronze",
    """
select category_id as record_id, 'public_api' as source, '/categories' as endpoint, strftime(landed, '%Y') as year,
    strftime(landed, '%m') as month, strftime(landed, '%d') as day,
    case when p_brand = 'Brand#7' then 'many' else cast(items as varchar) end as items
from landed_categories
""",
)
def scan_bronze(lake: Lake) -> DataFrame:
    root, _ = _landed_root(lake, "categories")
    rows = bronze.scan_bronze(lake.spark, root, "categories")
    items = F.get_json_object("payload", "$.total_items_in_this_category")
    return rows.select("record_id", "source", "endpoint", "year", "month", "day", items.alias("items"))


@query("sink_parquet", "select * from categories")
def sink_parquet(lake: Lake) -> DataFrame:
    path = scratch_path(lake.spark, "sink")
    tables.write_table(lake.categories, path)
    return tables.read_table(lake.spark, path)


@query(
    "sink_partitioned",
    """
select strftime(landed, '%Y') as year, strftime(landed, '%m') as month, strftime(landed, '%d') as day, count(*) as records
from landed_lines group by 1, 2, 3
""",
)
def sink_partitioned(lake: Lake) -> DataFrame:
    root, _ = _landed_root(lake, "item_details")
    rows = bronze.scan_bronze(lake.spark, root, "item_details")
    return rows.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("records"))


@query(
    "bronze_envelope",
    """
select case when l_returnflag = 'A' then 'I' || l_partkey when l_returnflag = 'N' then 'D' || l_suppkey
        else 'C' || l_orderkey end as record_id,
    'public_api' as source, '/items/' || l_linenumber as endpoint, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as ingested_at,
    l_quantity as quantity
from lineitem
""",
)
def bronze_envelope(lake: Lake) -> DataFrame:
    flag = F.col("l_returnflag")
    payload = F.struct(
        F.when(flag == "A", F.concat(F.lit("I"), "l_partkey")).when(flag == "N", "").alias("id"),
        F.when(flag == "N", F.concat(F.lit("D"), "l_suppkey")).alias("domain_id"),
        F.concat(F.lit("C"), "l_orderkey").alias("category_id"),
        F.col("l_quantity").alias("quantity"),
    )
    lines = lake.raw("lineitem").withColumn("payload", F.to_json(payload))
    endpoint = F.concat(F.lit("/items/"), "l_linenumber")
    rows = bronze.envelope(lines, "payload", "public_api", endpoint, F.col("l_shipdate"))
    quantity = F.get_json_object("payload", "$.quantity").cast("double")
    return rows.select("record_id", "source", "endpoint", "ingested_at", quantity.alias("quantity"))


@query(
    "sink_jsonl",
    """
select item_id as record_id, strftime(landed, '%m') as month, l_quantity as sold, count(*) over () as rows_written
from landed_lines
""",
)
def sink_jsonl(lake: Lake) -> DataFrame:
    root, written = _landed_root(lake, "item_details")
    rows = bronze.scan_jsonl(lake.spark, root, "item_details")
    sold = F.get_json_object("payload", "$.sold_quantity").cast("double")
    return rows.select(
        "record_id", "month", sold.alias("sold"), F.lit(written).cast("bigint").alias("rows_written")
    )


@query(
    "scan_json_docs",
    """
select 'run-' || o_orderkey as run_id, case when o_orderstatus = 'F' then 'failed' else 'success' end as status,
    o_orderpriority as query, o_custkey / 1000e0 as duration_seconds
from orders
""",
)
def scan_json_docs(lake: Lake) -> DataFrame:
    path = scratch_path(lake.spark, "manifests")  # many documents to a file
    documents.write_document(lake.manifests, path)
    fields = "run_id string, status string, query string, duration_seconds double"
    return documents.read_documents(lake.spark, path, fields)


@query(
    "sink_json_doc",
    """
select 'category_ml_baseline_v1' as model_version, count(*) as output_rows,
    sum(case when is_anomaly then 1 else 0 end)::bigint as anomaly_count, true as has_training_time
from scores
""",
)
def sink_json_doc(lake: Lake) -> DataFrame:
    path = scratch_path(lake.spark, "metadata")
    described = scoring.model_metadata(lake.scores).withColumn("trained_at", F.current_timestamp())
    documents.write_document(described, path)
    fields = "model_version string, output_rows bigint, anomaly_count bigint, trained_at string"
    written = documents.read_documents(lake.spark, path, fields)
    return written.withColumn("has_training_time", F.col("trained_at").isNotNull()).drop("trained_at")


@query(
    "sink_warehouse",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as rows from {t}"
        for t in (
            "dim_category", "dim_domain", "dim_seller", "dim_item", "dim_date", "fact_category_snapshot",
            "fact_marketplace_overview", "fact_seller_item_snapshot",
        )
    ),
)
def sink_warehouse(lake: Lake) -> DataFrame:
    """All eight tables published at once; rows of the version that readers now follow."""
    root = scratch_path(lake.spark, "warehouse")
    written = tables.publish_together(lake.star_plan(), root)
    current = tables.published_root(lake.spark, root)
    counts = [tables.read_table(lake.spark, f"{current}/{name}").select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")) for name in written]
    return reduce(DataFrame.unionByName, counts)


@query(
    "scan_mart",
    """
select item_id, seller_id, price, snapshot_date_key from mart_seller_items
where status = 'paused' and price >= 20000 order by snapshot_date_key
""",
)
def scan_mart(lake: Lake) -> DataFrame:
    return tables.query(
        {"mart": lake.mart("mart_seller_items")},
        """
        select item_id, seller_id, price, snapshot_date_key from {mart}
        where status = :status and price >= :price order by snapshot_date_key
        """,
        status="paused", price=20000.0,
    )


@query(
    "optional_source",
    """
select 'item_details' as source_name, count(*) as rows, count(distinct seller_id) as sellers from item_details
union all select 'absent', 0, 0
""",
)
def optional_source(lake: Lake) -> DataFrame:
    path = scratch_path(lake.spark, "optional")
    tables.write_table(lake.items, f"{path}/item_details")
    counted = []
    for name in ("item_details", "absent"):
        rows = tables.read_optional(lake.spark, f"{path}/{name}", schemas.SILVER["item_details"])
        counted.append(
            rows.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("seller_id").alias("sellers")).select(
                F.lit(name).alias("source_name"), "rows", "sellers"
            )
        )
    return counted[0].unionByName(counted[1])


@query(
    "empty_contract",
    """
select 'domain_discovery' as table_name, 9 as columns, 0 as rows_when_empty,
    (select count(*) from (select distinct n_name, p_brand, p_type, p_name from lineitem
        join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
        join nation on s_nationkey = n_nationkey) x) as rows
union all select 'categories', 10, 0, (select count(distinct category_id) from landed_categories)
union all select 'item_details', 17, 0, (select count(distinct item_id) from landed_lines)
union all select 'item_price_snapshots', 16, 0, (select count(distinct (l_partkey, landed)) from landed_lines)
union all select 'item_descriptions', 5, 0, (select count(distinct doc_id) + count(*) filter (where lang = 'de') from documents)
""",
)
def empty_contract(lake: Lake) -> DataFrame:
    """Each Silver transform on no rows and on all rows: same columns, zero rows against all."""
    out = []
    for name, transform in silver.TRANSFORMS.items():
        landed = lake.bronze(name)
        full, empty = transform(landed), transform(landed.filter("false"))
        assert full.schema == empty.schema
        nothing = empty.agg(F.count(F.lit(1)))
        out.append(
            full.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table_name"),
                F.lit(len(full.columns)).alias("columns"),
                nothing.scalar().cast("int").alias("rows_when_empty"),
                "rows",
            )
        )
    return reduce(DataFrame.unionByName, out)


@query(
    "mart_or_fallback",
    f"""
select item_id, title, seller_id, category_id, status, condition, listing_type_id, permalink, price,
    available_quantity, sold_quantity, {date_key("ingested_at")} as snapshot_date_key, ingested_at as snapshot_date
from item_details
""",
)
def mart_or_fallback(lake: Lake) -> DataFrame:
    return tables.table_or(lake.spark, "unpublished_seller_items", marts.seller_items_from_silver(lake.items))


# --- landed responses ------------------------------------------------------------------------


def _lines(lake: Lake) -> DataFrame:
    return lake.raw("lineitem")


def _json(**fields):
    return F.to_json(F.struct(*(v.alias(k) for k, v in fields.items())))


@query(
    "unwrap_multiget",
    """
select l_orderkey, 'I' || l_partkey as id, l_extendedprice as price from lineitem where l_returnflag in ('A', 'R')
""",
)
def unwrap_multiget(lake: Lake) -> DataFrame:
    flag = F.col("l_returnflag")
    code = F.when(flag == "A", "200").when(flag == "N", "404").otherwise("206")
    item = _json(id=F.concat(F.lit("I"), "l_partkey"), price=F.col("l_extendedprice"))
    body = F.concat(
        F.lit('[{"code":'), code, F.lit(',"body":'), item,
        F.lit('},{"code":200,"body":"gone"},{"code":"200","body":{"id":"x"}},{"code":200},7]'),
    )
    rows = responses.unwrap_multiget(_lines(lake).withColumn("body", body), "body")
    return rows.select(
        "l_orderkey",
        F.get_json_object("payload", "$.id").alias("id"),
        F.get_json_object("payload", "$.price").cast("double").alias("price"),
    )


@query(
    "explode_listing_ids",
    """
select 'I' || l_partkey as id, cast(l_suppkey as varchar) as seller_id from lineitem
union all select 'O' || l_orderkey, cast(l_suppkey as varchar) from lineitem
""",
)
def explode_listing_ids(lake: Lake) -> DataFrame:
    body = F.concat(
        F.lit('{"results":["I'), "l_partkey", F.lit('",5,null,{"id":"x"},"O'), "l_orderkey", F.lit('"],"paging":{}}')
    )
    return responses.explode_listing_ids(_lines(lake).withColumn("body", body), "body", "l_suppkey")


@query(
    "explode_search_results",
    """
select 'I' || l_partkey as id, l_quantity as quantity from lineitem
union all select 'S' || l_suppkey, null from lineitem
""",
)
def explode_search_results(lake: Lake) -> DataFrame:
    body = F.concat(
        F.lit('{"results":['), _json(id=F.concat(F.lit("I"), "l_partkey"), quantity=F.col("l_quantity")),
        F.lit(',"text",9,'), _json(id=F.concat(F.lit("S"), "l_suppkey")), F.lit('],"paging":{"total":2}}'),
    )
    rows = responses.explode_search_results(_lines(lake).withColumn("body", body), "body")
    return rows.select(
        F.get_json_object("payload", "$.id").alias("id"),
        F.get_json_object("payload", "$.quantity").cast("double").alias("quantity"),
    )


@query("normalise_category_list", "select 'C' || l_partkey as id, l_linestatus from lineitem")
def normalise_category_list(lake: Lake) -> DataFrame:
    listed = F.concat(F.lit("["), _json(id=F.concat(F.lit("C"), "l_partkey")), F.lit(',"x",null]'))
    wrapped = F.concat(F.lit('{"categories":'), listed, F.lit("}"))
    body = F.when(F.col("l_linestatus") == "O", listed).otherwise(wrapped)
    rows = responses.explode_categories(_lines(lake).withColumn("body", body), "body")
    return rows.select(F.get_json_object("payload", "$.id").alias("id"), "l_linestatus")


@query("filter_object_rows", "select 'D' || l_suppkey as domain_id, l_orderkey from lineitem")
def filter_object_rows(lake: Lake) -> DataFrame:
    body = F.concat(F.lit('["x",1,[2],'), _json(domain_id=F.concat(F.lit("D"), "l_suppkey")), F.lit(",null]"))
    rows = responses.explode_objects(_lines(lake).withColumn("body", body), "body")
    return rows.select(F.get_json_object("payload", "$.domain_id").alias("domain_id"), "l_orderkey")


@query(
    "derive_price_snapshots",
    """
select 'I' || l_partkey as id, 'I' || l_partkey as item_id, cast(l_suppkey as varchar) as seller_id,
    l_extendedprice as price, cast(null as double) as base_price, cast(l_linenumber as varchar) as available_quantity,
    'active' as status
from lineitem where l_returnflag = 'A'
""",
)
def derive_price_snapshots(lake: Lake) -> DataFrame:
    flag = F.col("l_returnflag")
    payload = _json(
        id=F.when(flag == "A", F.concat(F.lit("I"), "l_partkey")).when(flag == "N", ""),
        seller_id=F.col("l_suppkey"), price=F.col("l_extendedprice"),
        available_quantity=F.col("l_linenumber"), status=F.lit("active"), title=F.lit("dropped"),
    )
    rows = responses.price_snapshot_payloads(_lines(lake).withColumn("payload", payload))
    return rows.select(
        "id", "item_id", "seller_id", F.col("price").cast("double").alias("price"),
        F.col("base_price").cast("double").alias("base_price"), "available_quantity", "status",
    )


@query(
    "merge_id_into_payload",
    """
select case when lang = 'en' then 'OWN' || doc_id else cast(doc_id as varchar) end as id, length(text) as chars from documents
""",
)
def merge_id_into_payload(lake: Lake) -> DataFrame:
    own = F.when(F.col("lang") == "en", F.concat(F.lit("OWN"), "doc_id"))
    docs = lake.raw("documents").withColumn("payload", _json(id=own, plain_text=F.col("text")))
    rows = responses.merge_id(docs, "payload", "doc_id")
    text = F.get_json_object("payload", "$.plain_text")
    return rows.select("id", F.char_length(text).cast("bigint").alias("chars"))


@query("distinct_ids", "select distinct 'I' || l_partkey as id from lineitem where l_returnflag <> 'R'")
def distinct_ids(lake: Lake) -> DataFrame:
    ids = F.when(F.col("l_returnflag") == "R", "").otherwise(F.concat(F.lit("I"), "l_partkey"))
    return responses.distinct_ids(_lines(lake).withColumn("id", ids), "id")


@query("category_ids_from_domains", "select distinct p_brand || '-' || p_type as category_id from lineitem join part on l_partkey = p_partkey")
def category_ids_from_domains(lake: Lake) -> DataFrame:
    return responses.discovered_category_ids(lake.bronze("domain_discovery"))


# --- Silver ----------------------------------------------------------------------------------


@query(
    "parse_payload",
    """
select event_id, case when event_type = 'error' then 'invalid' when event_type = 'view' then 'array' else 'object' end as kind,
    case when event_type in ('error', 'view') then null else cast(json_extract_string(props, '$.k') as bigint) end as k
from events
""",
)
def parse_payload(lake: Lake) -> DataFrame:
    """Broken and non-object payloads give null fields and are told apart by their kind."""
    from bazaarlens.functions.payload import json_kind, parse_object

    kind = F.col("event_type")
    text = F.when(kind == "error", F.concat(F.lit("{"), "props")).when(kind == "view", F.concat(F.lit("["), "props", F.lit("]")))
    rows = lake.raw("events").withColumn("payload", F.coalesce(text, F.when(~kind.isin("error", "view"), F.col("props"))))
    state = json_kind(F.col("payload"))
    k = F.when(state == "object", parse_object(F.col("payload"), "k bigint").getField("k"))
    return rows.select("event_id", state.alias("kind"), k.alias("k"))


@query(
    "latest_by_record_id",
    """
select item_id as record_id, landed as ingested_at, l_quantity as quantity from (
    select *, row_number() over (partition by item_id order by landed desc) as nth from landed_lines) x
where nth = 1
""",
)
def latest_by_record_id(lake: Lake) -> DataFrame:
    rows = silver.latest_by_record(silver.parsed(lake.bronze("item_details"), schemas.ITEM_PAYLOAD))
    return rows.select("record_id", "ingested_at", F.col("p.sold_quantity").cast("double").alias("quantity"))


@query(
    "silver_domain_discovery",
    """
select domain_id || '__' || category_id as domain_category_id,
    search_query || '__' || domain_id || '__' || category_id as query_domain_category_id,
    domain_id, domain_name, category_id, category_name, search_query, ingested_at, 'public_api' as source
from (
    select 'DOM-' || n_name as domain_id, n_name as domain_name, p_brand || '-' || p_type as category_id,
        p_type || ' ' || p_brand as category_name, p_name as search_query, max(l_shipdate) as ingested_at
    from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
    join nation on s_nationkey = n_nationkey
    group by n_name, p_brand, p_type, p_name
) x
""",
)
def silver_domain_discovery(lake: Lake) -> DataFrame:
    return silver.silver_domain_discovery(lake.bronze("domain_discovery"))


@query(
    "url_query_param",
    """
select page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') as page,
    nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') as ref from pages
""",
)
def url_param(lake: Lake) -> DataFrame:
    url = F.col("url")
    return lake.raw("pages").select(
        "page_id", url_query_param(url, "page").alias("page"), url_query_param(url, "ref").alias("ref")
    )


@query(
    "silver_categories",
    """
select category_id, p_type || ' ' || p_brand as category_name, 'https://img.example.com/' || p_brand as picture_url,
    case when p_brand = 'Brand#7' then null else items end as total_items_in_this_category,
    case when p_brand = 'Brand#9' then '' when p_brand = 'Brand#5' then 'Catalog >  > ' || p_type
        else 'Catalog > ' || p_type || ' > ' || p_brand end as path_from_root,
    case when p_brand = 'Brand#4' then 0 else children end as children_categories_count,
    case when p_type = 'PROMO' then 'variations' end as attribute_types, p_type = 'SMALL' as settings_adult_content,
    landed as ingested_at, 'public_api' as source
from (select *, row_number() over (partition by category_id order by landed desc) as nth from landed_categories) x
where nth = 1
""",
)
def silver_categories(lake: Lake) -> DataFrame:
    return silver.silver_categories(lake.bronze("categories"))


@query(
    "silver_item_details",
    """
select item_id, p_name as title, case when l_discount <= 0.095 then l_extendedprice end as price, 'BRL' as currency_id,
    case when p_size = 13 then null else cast(p_size as bigint) end as available_quantity,
    cast(l_quantity as bigint) as sold_quantity,
    case l_returnflag when 'A' then 'active' when 'N' then 'paused' end as status,
    case when p_size > 25 then 'new' else 'used' end as condition, p_brand || '-' || p_type as category_id,
    cast(null as varchar) as listing_type_id, 'https://shop.example.com/' || l_partkey as permalink,
    cast(l_suppkey as varchar) as seller_id, cast(null as varchar) as site_id, l_shipdate as date_created,
    case when l_linestatus = 'F' then null else l_shipdate end as last_updated, landed as ingested_at, 'seller_api' as source
from (select *, row_number() over (partition by item_id order by landed desc) as nth from landed_lines) x
where nth = 1
""",
)
def silver_item_details(lake: Lake) -> DataFrame:
    return silver.silver_item_details(lake.bronze("item_details"))


@query(
    "silver_item_price_snapshots",
    f"""
select 'P' || l_partkey as item_id, cast(l_suppkey as varchar) as seller_id, p_brand || '-' || p_type as category_id,
    l_extendedprice as price, p_retailprice as base_price, cast(null as double) as original_price, 'BRL' as currency_id,
    cast(p_size as bigint) as available_quantity, cast(l_quantity as bigint) as sold_quantity,
    case l_returnflag when 'A' then 'active' end as status, cast(null as varchar) as condition,
    cast(null as timestamp) as last_updated, landed as snapshot_date, {date_key("landed")} as snapshot_date_key,
    landed as ingested_at, 'seller_api' as source
from landed_lines
""",
)
def silver_item_price_snapshots(lake: Lake) -> DataFrame:
    return silver.silver_item_price_snapshots(lake.bronze("item_price_snapshots"))


@query(
    "silver_item_descriptions",
    """
select item_id, plain_text, length(plain_text) as text_length, timestamp '2024-01-02 00:00:00' as ingested_at, 'seller_api' as source
from (select 'D' || doc_id as item_id, text as plain_text from documents
    union all select 'N' || doc_id, '' from documents where lang = 'de') x
""",
)
def silver_item_descriptions(lake: Lake) -> DataFrame:
    return silver.silver_item_descriptions(lake.bronze("item_descriptions"))


@query("landing_to_silver", ORACLES["silver_item_descriptions"])
def landing_to_silver(lake: Lake) -> DataFrame:
    """Raw response bodies that arrive in two drops, landed after each and once more, up to Silver values."""
    inbox, root = scratch_path(lake.spark, "inbox"), scratch_path(lake.spark, "landed")
    bodies = lake.bronze("item_descriptions").select(
        "endpoint", F.col("record_id").alias("requested"), F.col("ingested_at").alias("received_at"), F.col("payload").alias("body")
    )
    for drop in (0, 1):
        bodies.filter(F.pmod(F.hash("body"), F.lit(2)) == drop).write.json(f"{inbox}/descriptions/{drop}")
        landing.land_responses(lake.spark, inbox, root, f"{root}/progress", ["descriptions"])
    again = landing.land_responses(lake.spark, inbox, root, f"{root}/progress", ["descriptions"])
    if any(again.values()):
        raise AssertionError(f"a replay has added rows: {again}")
    return silver.silver_item_descriptions(bronze.scan_bronze(lake.spark, root, "item_descriptions"))


@query(
    "build_silver",
    """
select 'domain_discovery' as table_name, count(*) as rows from (select distinct n_name, p_brand, p_type, p_name
    from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
    join nation on s_nationkey = n_nationkey) x
union all select 'categories', count(distinct category_id) from landed_categories
union all select 'item_details', count(distinct item_id) from landed_lines
union all select 'item_price_snapshots', count(distinct (l_partkey, landed)) from landed_lines
union all select 'item_descriptions', count(distinct doc_id) + count(*) filter (where lang = 'de') from documents
""",
)
def build_silver(lake: Lake) -> DataFrame:
    landed = {name: lake.bronze(name) for name in silver.TRANSFORMS}
    counts = tables.publish(silver.build_silver(landed), scratch_path(lake.spark, "silver"))
    return lake.spark.createDataFrame(list(counts.items()), "table_name string, rows bigint")


@query(
    "build_gold",
    """
select 'category_metrics' as table_name, count(*) as rows from category_metrics
union all select 'marketplace_overview', 1
union all select 'public_query_metrics', count(*) from query_metrics
union all select 'seller_item_metrics', count(*) from seller_item_metrics
union all select 'price_history', count(*) from price_history
""",
)
def build_gold(lake: Lake) -> DataFrame:
    counts = tables.publish(gold.build_gold(lake.silver_tables()), scratch_path(lake.spark, "gold"))
    return lake.spark.createDataFrame(list(counts.items()), "table_name string, rows bigint")
