"""Gold builders, star schema, marts and data quality (inventory 2.11 to 2.14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.operators.quality import TableRules, check_table, column_report, gate
from bazaarlens.plans import gold, marts, pipeline, silver, star
from bazaarlens.session import scratch_path
from bazaarlens.sources.tables import append_snapshots, read_table
from workload.inputs import Lake
from workload.registry import query

# --- Gold ------------------------------------------------------------------------------------


@query("gold_category_metrics", "select * from category_metrics")
def gold_category_metrics(lake: Lake) -> DataFrame:
    return gold.gold_category_metrics(lake.categories, lake.domains)


@query("gold_marketplace_overview", "select * from marketplace_overview")
def gold_marketplace_overview(lake: Lake) -> DataFrame:
    return gold.gold_marketplace_overview(lake.categories, lake.domains)


@query("gold_public_query_metrics", "select * from query_metrics")
def gold_public_query_metrics(lake: Lake) -> DataFrame:
    return gold.gold_public_query_metrics(lake.categories, lake.domains)


@query("gold_seller_item_metrics", "select * from seller_item_metrics")
def gold_seller_item_metrics(lake: Lake) -> DataFrame:
    return gold.gold_seller_item_metrics(lake.items)


@query("gold_price_history", "select * from price_history")
def gold_price_history(lake: Lake) -> DataFrame:
    return gold.gold_price_history(lake.prices)


# --- star schema -----------------------------------------------------------------------------


@query("dim_category", "select * from dim_category")
def dim_category(lake: Lake) -> DataFrame:
    return star.dim_category(lake.categories)


@query("dim_domain", "select * from dim_domain")
def dim_domain(lake: Lake) -> DataFrame:
    return star.dim_domain(lake.domains)


@query("dim_seller", "select * from dim_seller")
def dim_seller(lake: Lake) -> DataFrame:
    return star.dim_seller(lake.items)


@query("dim_item", "select * from dim_item")
def dim_item(lake: Lake) -> DataFrame:
    return star.dim_item(lake.items)


@query("dim_date", "select * from dim_date")
def dim_date(lake: Lake) -> DataFrame:
    return lake.star_plan("dim_date")["dim_date"]


@query("fact_category_snapshot", "select * from fact_category_snapshot")
def fact_category_snapshot(lake: Lake) -> DataFrame:
    return star.fact_category_snapshot(lake.category_metrics, lake.categories)


@query("fact_marketplace_overview", "select * from fact_marketplace_overview")
def fact_marketplace_overview(lake: Lake) -> DataFrame:
    return star.fact_marketplace_overview(lake.overview)


@query("fact_seller_item_snapshot", "select * from fact_seller_item_snapshot")
def fact_seller_item_snapshot(lake: Lake) -> DataFrame:
    return star.fact_seller_item_snapshot(lake.items)


@query(
    "fact_append_snapshot",
    """
select category_id, snapshot_date_key, case when snapshot_date_key >= 20011101 then domain_count * 2 else domain_count end as domain_count
from fact_category_snapshot
""",
)
def fact_append_snapshot(lake: Lake) -> DataFrame:
    """All dates are loaded, then the later ones again with other counts: only those are replaced."""
    path = scratch_path(lake.spark, "history")
    fact = lake.star["fact_category_snapshot"].select("category_id", "snapshot_date_key", "domain_count")
    append_snapshots(fact, path, "category_id")
    later = fact.filter("snapshot_date_key >= 20011101").withColumn("domain_count", F.col("domain_count") * 2)
    append_snapshots(later, path, "category_id")
    return read_table(lake.spark, path, "category_id string, domain_count bigint, snapshot_date_key bigint")


# --- staging, intermediate, marts ------------------------------------------------------------


def _staging(key: str, table: str) -> None:
    columns = ", ".join(marts.STAGING[key][1])

    @query(key, f"select {columns} from {table}")
    def run(lake: Lake) -> DataFrame:
        return marts.staging(lake.star, key)


for _key, (_table, _columns) in marts.STAGING.items():
    _staging(_key, _table)


@query("stg_item_details", "select * from stg_item_details")
def stg_item_details(lake: Lake) -> DataFrame:
    return marts.stg_item_details(lake.star)


@query("int_category_domain_metrics", "select * from int_category_domain_metrics")
def int_category_domain_metrics(lake: Lake) -> DataFrame:
    return marts.int_category_domain_metrics(lake.star)


@query("int_category_snapshot_enriched", "select * from int_category_snapshot_enriched")
def int_category_snapshot_enriched(lake: Lake) -> DataFrame:
    return marts.int_category_snapshot_enriched(lake.star)


@query("mart_category_metrics", "select * from mart_category_metrics")
def mart_category_metrics(lake: Lake) -> DataFrame:
    return marts.mart_category_metrics(lake.star)


@query("mart_marketplace_overview", "select * from mart_marketplace_overview")
def mart_marketplace_overview(lake: Lake) -> DataFrame:
    return marts.mart_marketplace_overview(lake.star)


@query("mart_seller_item_metrics", "select * from mart_seller_item_metrics")
def mart_seller_item_metrics(lake: Lake) -> DataFrame:
    return marts.mart_seller_item_metrics(lake.star)


@query("mart_seller_items", "select * from mart_seller_items")
def mart_seller_items(lake: Lake) -> DataFrame:
    return marts.mart_seller_items(lake.star)


# --- data quality ----------------------------------------------------------------------------


def required_sql(name: str) -> str:
    return f"select '{name}_required_columns' as name, true as passed, 'all required columns present' as details"


def non_null_sql(name: str, table: str, columns: list[str]) -> str:
    counts = ", ".join(f"count(*) - count({c}) as {c}" for c in columns)
    parts = ", ".join(f"case when {c} > 0 then '''{c}'': ' || {c} end" for c in columns)
    found = f"list_filter([{parts}], lambda x: x is not null)"
    return f"""
select '{name}_non_null' as name, len({found}) = 0 as passed,
    case when len({found}) = 0 then 'no nulls in required columns' else '{{' || array_to_string({found}, ', ') || '}}' end as details
from (select {counts} from {table}) n"""


def unique_sql(name: str, table: str, column: str) -> str:
    return f"""
select '{name}_{column}_unique' as name, coalesce(sum(n - 1), 0) = 0 as passed,
    'duplicate_count=' || cast(coalesce(sum(n - 1), 0) as bigint) as details
from (select count(*) as n from {table} group by {column}) g"""


def rules_sql(rules: TableRules, table: str) -> str:
    parts = [required_sql(rules.dataset)] if rules.required else []
    if rules.non_null:
        parts.append(non_null_sql(rules.dataset, table, list(rules.non_null)))
    parts += [unique_sql(rules.dataset, table, c) for c in rules.unique]
    return "\nunion all\n".join(parts)


@query(
    "dq_required_columns",
    """
select 'item_details' as dataset, 'seller_id' as column_name, true as present, count(*) - count(seller_id) as nulls, count(*) as rows from item_details
union all select 'item_details', 'ingested_at', true, count(*) - count(ingested_at), count(*) from item_details
union all select 'lineitem', 'l_orderkey', true, count(*) - count(l_orderkey), count(*) from lineitem
union all select 'lineitem', 'item_id', false, count(*), count(*) from lineitem
""",
)
def dq_required_columns(lake: Lake) -> DataFrame:
    first = column_report(lake.items, TableRules("item_details", required=["seller_id", "ingested_at"]))
    return first.unionByName(column_report(lake.raw("lineitem"), TableRules("lineitem", required=["l_orderkey", "item_id"])))


DQ_ITEM_COLUMNS = ["item_id", "price", "seller_id", "status"]


@query("dq_non_null", non_null_sql("item_details", "item_details", DQ_ITEM_COLUMNS))
def dq_non_null(lake: Lake) -> DataFrame:
    return check_table(lake.items, TableRules("item_details", non_null=DQ_ITEM_COLUMNS))


@query(
    "dq_unique",
    "\nunion all\n".join(
        [
            unique_sql("domains", "domains", "query_domain_category_id"),
            unique_sql("domains", "domains", "domain_category_id"),
            unique_sql("item_details", "item_details", "item_id"),
            "select 'item_details_missing_unique' as name, false as passed, 'duplicate_count=-1' as details",
        ]
    ),
)
def dq_unique(lake: Lake) -> DataFrame:
    domains = TableRules("domains", unique=["query_domain_category_id", "domain_category_id"])
    items = TableRules("item_details", unique=["item_id", "missing"])
    return check_table(lake.domains, domains).unionByName(check_table(lake.items, items))


@query(
    "dq_gate",
    f"""
select 'Data quality checks failed: item_details_non_null: ' || details as message, (select count(*) from item_details) as rows
from ({non_null_sql("item_details", "item_details", DQ_ITEM_COLUMNS)}) failed
""",
)
def dq_gate(lake: Lake) -> DataFrame:
    """The gate's message for a failing table, and its silence for a sound one."""
    gate(check_table(lake.items, TableRules("item_details", ["item_id"], ["item_id"], ["item_id"])))
    try:
        gate(check_table(lake.items, TableRules("item_details", non_null=DQ_ITEM_COLUMNS)))
        message = "passed"
    except ValueError as exc:
        message = str(exc)
    return lake.items.agg(F.count(F.lit(1)).alias("rows")).withColumn("message", F.lit(message))


@query(
    "dq_bronze_suite",
    """
select 'bronze_domain_discovery_required_columns' as name, true as passed, 'all required columns present' as details
union all select 'bronze_domain_discovery_non_null', count(p_name) = count(*), 'no nulls in required columns'
    from lineitem join part on l_partkey = p_partkey
union all select 'bronze_categories_required_columns', true, 'all required columns present'
union all select 'bronze_categories_non_null', count(p_brand) = count(*), 'no nulls in required columns'
    from lineitem join part on l_partkey = p_partkey
""",
)
def dq_bronze_suite(lake: Lake) -> DataFrame:
    return pipeline.bronze_checks({e: lake.bronze(e) for e in pipeline.PUBLIC_ENTITIES})


_SILVER_VIEWS = {"categories": "categories", "domain_discovery": "domains", "item_details": "item_details"}


@query(
    "dq_silver_suite",
    "\nunion all\n".join(
        [rules_sql(silver.RULES[n], t) for n, t in _SILVER_VIEWS.items()]
        + [
            rules_sql(TableRules(n, pipeline.SILVER_STAGE_RULES[n], pipeline.SILVER_STAGE_RULES[n]), t)
            for n, t in _SILVER_VIEWS.items()
        ]
    ),
)
def dq_silver_suite(lake: Lake) -> DataFrame:
    tables = {n: t for n, t in lake.silver_tables().items() if n in _SILVER_VIEWS}
    return silver.silver_checks(tables).unionByName(pipeline.silver_stage_checks(tables))


def _reference_sql(r) -> str:
    return f"""
select '{r.child}_{r.column}_in_{r.parent}' as name, count(*) = 0 as passed, 'failures=' || count(*) as details
from {r.child} where {r.column} is not null and {r.column} not in (select {r.parent_column} from {r.parent})"""


@query("dq_relationships", "\nunion all\n".join(_reference_sql(r) for r in marts.REFERENCE_RULES))
def dq_relationships(lake: Lake) -> DataFrame:
    return marts.reference_checks(lake.star)


@query(
    "dq_accepted_values",
    """
select 'mart_category_metrics_coverage_band' as name, count(*) = 0 as passed, 'failures=' || count(*) as details
from mart_category_metrics where coverage_band not in ('high_coverage', 'medium_coverage', 'low_coverage')
""",
)
def dq_accepted_values(lake: Lake) -> DataFrame:
    return marts.band_check(lake.mart("mart_category_metrics"))


@query(
    "dq_range_tests",
    """
select 'category_scores_between_0_and_100' as name, count(*) = 0 as passed, 'failures=' || count(*) as details
    from mart_category_metrics where catalog_coverage_score < 0 or catalog_coverage_score > 100
union all select 'seller_item_prices_non_negative', count(*) = 0, 'failures=' || count(*) from stg_item_details where price < 0
union all select 'seller_item_quantities_non_negative', count(*) = 0, 'failures=' || count(*)
    from stg_item_details where available_quantity < 0 or sold_quantity < 0
union all select 'seller_item_sell_through_between_0_and_100', count(*) = 0, 'failures=' || count(*)
    from mart_seller_item_metrics where sell_through_rate < 0 or sell_through_rate > 100
""",
)
def dq_range_tests(lake: Lake) -> DataFrame:
    return marts.range_checks(
        lake.mart("mart_seller_items"), lake.mart("mart_category_metrics"), lake.mart("mart_seller_item_metrics")
    )


@query("dq_not_null_unique_suite", "\nunion all\n".join(rules_sql(r, r.dataset) for r in marts.KEY_RULES))
def dq_not_null_unique_suite(lake: Lake) -> DataFrame:
    return marts.key_checks({**lake.star, **lake.all_marts()})
