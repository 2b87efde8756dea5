"""Projections, joins, aggregates, windows, sorts, sets and scalar functions (2.4 to 2.10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions import dates, numbers, text
from bazaarlens.functions.payload import parse_object
from bazaarlens.operators import dedup, paging, previous, ranking, relational, stats
from bazaarlens.plans import gold, marts, serving
from bazaarlens.fixed_values import COVERAGE_LABELS
from workload.check_views import date_key, rnd
from workload.inputs import Lake
from workload.registry import query, view

# --- projections, filters, predicates --------------------------------------------------------


@query("project_columns", "select domain_category_id, domain_id, domain_name, category_id, category_name, search_query from domains")
def project_columns(lake: Lake) -> DataFrame:
    return lake.domains.select("domain_category_id", "domain_id", "domain_name", "category_id", "category_name", "search_query")


@query("rename_columns", "select item_id, price, ingested_at as snapshot_date from item_details")
def rename_columns(lake: Lake) -> DataFrame:
    return lake.items.withColumnRenamed("ingested_at", "snapshot_date").select("item_id", "price", "snapshot_date")


@query("filter_eq_point", "select * from mart_category_metrics where category_id = 'Brand#13-ECONOMY'")
def filter_eq_point(lake: Lake) -> DataFrame:
    return serving.category(lake.mart("mart_category_metrics"), "Brand#13-ECONOMY")


@query("filter_optional_conjunction", "select * from mart_seller_items where seller_id = '7' and status = 'active'")
def filter_optional_conjunction(lake: Lake) -> DataFrame:
    return relational.equal_filters(lake.mart("mart_seller_items"), seller_id="7", category_id="", status="active")


@query("filter_boolean", "select category_id, anomaly_type from scores where is_anomaly")
def filter_boolean(lake: Lake) -> DataFrame:
    return lake.scores.filter("is_anomaly").select("category_id", "anomaly_type")


@query("filter_in_list", "select category_id, coverage_band from mart_category_metrics where coverage_band in ('high_coverage', 'medium_coverage')")
def filter_in_list(lake: Lake) -> DataFrame:
    rows = lake.mart("mart_category_metrics").filter(F.col("coverage_band").isin("high_coverage", "medium_coverage"))
    return rows.select("category_id", "coverage_band")


@query("filter_range_violation", "select l_orderkey, l_linenumber, l_extendedprice from lineitem where l_extendedprice < 1500 or l_extendedprice > 90000")
def filter_range_violation(lake: Lake) -> DataFrame:
    rows = lake.raw("lineitem").filter(relational.outside(F.col("l_extendedprice"), 1500, 90000))
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("filter_compound", "select item_id from item_details where coalesce(sold_quantity, 0) = 0 and coalesce(available_quantity, 0) > 0")
def filter_compound(lake: Lake) -> DataFrame:
    unsold = F.coalesce("sold_quantity", F.lit(0)) == 0
    return lake.items.filter(unsold & (F.coalesce("available_quantity", F.lit(0)) > 0)).select("item_id")


@query("dropna_subset", "select item_id, seller_id, price from item_details where seller_id is not null and price is not null")
def dropna_subset(lake: Lake) -> DataFrame:
    return lake.items.dropna(subset=["seller_id", "price"]).select("item_id", "seller_id", "price")


@query(
    "case_band",
    """
select event_id, case when s >= 90 then 'high_coverage' when s >= 50 then 'medium_coverage' else 'low_coverage' end as band
from (select event_id, case when event_type = 'error' then null else value end as s from events) x
""",
)
def case_band(lake: Lake) -> DataFrame:
    score = F.when(F.col("event_type") != "error", F.col("value"))
    return lake.raw("events").select("event_id", relational.coverage_band(score).alias("band"))


@query(
    "case_conditional_flag",
    """
select item_id, case when status = 'active' then 1 else 0 end as is_active, case when status = 'paused' then 1 else 0 end as is_paused,
    case when coalesce(available_quantity, 0) > 0 and coalesce(sold_quantity, 0) = 0 then 1 else 0 end as has_stock_without_sales
from (select item_id, coalesce(status, 'unknown') as status, available_quantity, sold_quantity from item_details) x
""",
)
def case_conditional_flag(lake: Lake) -> DataFrame:
    status = F.coalesce("status", F.lit("unknown"))
    unsold = (F.coalesce("available_quantity", F.lit(0)) > 0) & (F.coalesce("sold_quantity", F.lit(0)) == 0)
    return lake.items.select(
        "item_id",
        (status == "active").cast("int").alias("is_active"),
        (status == "paused").cast("int").alias("is_paused"),
        unsold.cast("int").alias("has_stock_without_sales"),
    )


@query(
    "value_map",
    """
select event_id, case band when 'high_coverage' then 'Alta cobertura' when 'medium_coverage' then 'Media cobertura'
    when 'low_coverage' then 'Baixa cobertura' else band end as label
from (select event_id, case when event_type = 'error' then event_type when value >= 90 then 'high_coverage'
    when value >= 50 then 'medium_coverage' else 'low_coverage' end as band from events) x
""",
)
def value_map(lake: Lake) -> DataFrame:
    kind = F.col("event_type")
    band = F.when(kind == "error", kind).otherwise(relational.coverage_band(F.col("value")))
    return lake.raw("events").select("event_id", relational.relabel(band, COVERAGE_LABELS).alias("label"))


# --- joins -----------------------------------------------------------------------------------


@query(
    "join_left_agg",
    """
select c.category_id, coalesce(d.n, 0) as domain_count from categories c
left join (select category_id, count(distinct domain_id) as n from domains group by category_id) d on c.category_id = d.category_id
""",
)
def join_left_agg(lake: Lake) -> DataFrame:
    rows = relational.count_distinct_or_zero(lake.categories, lake.domains, "category_id", "domain_id", "domain_count")
    return rows.select("category_id", "domain_count")


@query(
    "join_left_fanout",
    """
select d.domain_id, d.search_query, d.category_id, d.ingested_at as domain_ingested_at,
    c.ingested_at as category_ingested_at, c.total_items_in_this_category
from domains d left join categories c on d.category_id = c.category_id
""",
)
def join_left_fanout(lake: Lake) -> DataFrame:
    lookup = dedup.keep_first(lake.categories, ["category_id"], "ingested_at", ["category_name"]).select(
        "category_id", F.col("ingested_at").alias("category_ingested_at"), "total_items_in_this_category"
    )
    rows = lake.domains.withColumnRenamed("ingested_at", "domain_ingested_at").join(lookup, "category_id", "left")
    return rows.select(
        "domain_id", "search_query", "category_id", "domain_ingested_at", "category_ingested_at",
        "total_items_in_this_category",
    )


@query("join_left_chain3", "select * from int_category_snapshot_enriched")
def join_left_chain3(lake: Lake) -> DataFrame:
    return marts.int_category_snapshot_enriched(lake.star)


@query("join_left_count_distinct", "select * from int_category_domain_metrics")
def join_left_count_distinct(lake: Lake) -> DataFrame:
    return marts.int_category_domain_metrics(lake.star)


@query("join_left_star2", "select item_id, title, snapshot_date, status, price from stg_item_details")
def join_left_star2(lake: Lake) -> DataFrame:
    return marts.stg_item_details(lake.star).select("item_id", "title", "snapshot_date", "status", "price")


@query("join_left_date", "select snapshot_date_key, snapshot_date, total_categories from mart_marketplace_overview")
def join_left_date(lake: Lake) -> DataFrame:
    return marts.mart_marketplace_overview(lake.star).select("snapshot_date_key", "snapshot_date", "total_categories")


@query(
    "join_inner_using",
    """
select c.category_name, f.total_items_in_this_category, f.catalog_coverage_score
from fact_category_snapshot f join dim_category c using (category_id) order by f.catalog_coverage_score desc
""",
)
def join_inner_using(lake: Lake) -> DataFrame:
    rows = lake.star["fact_category_snapshot"].join(lake.star["dim_category"], "category_id")
    return rows.select("category_name", "total_items_in_this_category", "catalog_coverage_score").orderBy(
        F.col("catalog_coverage_score").desc()
    )


@query("join_left_ingestion", "select category_id, snapshot_date_key from fact_category_snapshot")
def join_left_ingestion(lake: Lake) -> DataFrame:
    stamps = lake.categories.select("category_id", dates.date_key(F.col("ingested_at")).alias("snapshot_date_key"))
    return lake.category_metrics.select("category_id").join(stamps, "category_id", "left")


@query(
    "anti_join_orphans",
    """
select category_id, count(*) as rows from domains
where category_id is not null and category_id not in (select category_id from categories) group by category_id
""",
)
def anti_join_orphans(lake: Lake) -> DataFrame:
    return relational.orphans(lake.domains, "category_id", lake.categories, "category_id")


# --- aggregations ----------------------------------------------------------------------------


@query("agg_count", "select count(*) as total from mart_seller_items")
def agg_count(lake: Lake) -> DataFrame:
    return lake.mart("mart_seller_items").agg(F.count(F.lit(1)).alias("total"))


@query("agg_count_distinct", "select category_id, count(distinct seller_id) as sellers from item_details group by category_id")
def agg_count_distinct(lake: Lake) -> DataFrame:
    return lake.items.groupBy("category_id").agg(F.count_distinct("seller_id").alias("sellers"))


@query("agg_global_distinct", "select count(distinct category_id) as categories, count(distinct domain_id) as domains from domains")
def agg_global_distinct(lake: Lake) -> DataFrame:
    return lake.domains.agg(F.count_distinct("category_id").alias("categories"), F.count_distinct("domain_id").alias("domains"))


@query(
    "agg_sum",
    """
select category_id, cast(coalesce(sum(total_items_in_this_category), 0) as bigint) as items from categories group by category_id
""",
)
def agg_sum(lake: Lake) -> DataFrame:
    return lake.categories.groupBy("category_id").agg(numbers.sum_or_zero(F.col("total_items_in_this_category")).alias("items"))


@query(
    "agg_avg_round",
    f"""
select category_id, {rnd("cast(sum(cast(price as decimal(18,4))) as double) / count(price)")} as avg_price
from item_details group by category_id
""",
)
def agg_avg_round(lake: Lake) -> DataFrame:
    return lake.items.groupBy("category_id").agg(numbers.np_round(numbers.exact_mean(F.col("price")), 2).alias("avg_price"))


@query(
    "agg_min_max",
    """
select seller_id, min(price) as min_price, max(price) as max_price, max(ingested_at) as latest, min(title) as first_title
from item_details group by seller_id
""",
)
def agg_min_max(lake: Lake) -> DataFrame:
    return lake.items.groupBy("seller_id").agg(
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.max("ingested_at").alias("latest"), F.min("title").alias("first_title"),
    )


@query(
    "agg_conditional_sum",
    """
select seller_id, sum(case when status = 'active' then 1 else 0 end)::bigint as active,
    sum(case when status = 'paused' then coalesce(available_quantity, 0) else 0 end)::bigint as paused_stock
from item_details group by seller_id
""",
)
def agg_conditional_sum(lake: Lake) -> DataFrame:
    paused = F.when(F.col("status") == "paused", F.coalesce("available_quantity", F.lit(0))).otherwise(0)
    return lake.items.groupBy("seller_id").agg(
        F.count_if(F.col("status") == "active").alias("active"), F.sum(paused).alias("paused_stock")
    )


@query(
    "agg_multi_key",
    """
select seller_id, category_id, status, count(*) as items, cast(sum(sold_quantity) as bigint) as sold,
    max(last_updated) as last_updated
from item_details group by seller_id, category_id, status
""",
)
def agg_multi_key(lake: Lake) -> DataFrame:
    return lake.items.groupBy("seller_id", "category_id", "status").agg(
        F.count(F.lit(1)).alias("items"), F.sum("sold_quantity").alias("sold"), F.max("last_updated").alias("last_updated")
    )


@query("agg_group_by_expr", "select coalesce(status, 'unknown') as status, count(*) as items from item_details group by coalesce(status, 'unknown')")
def agg_group_by_expr(lake: Lake) -> DataFrame:
    return lake.items.groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(F.count(F.lit(1)).alias("items"))


@query(
    "agg_ratio_guarded",
    f"""
select category_id, status, {rnd("case when sum(a) + sum(s) > 0 then cast(sum(s) as double) / (sum(a) + sum(s)) * 100 else 0 end")} as rate
from (select category_id, status, coalesce(available_quantity, 0) as a, coalesce(sold_quantity, 0) as s from item_details) x
group by category_id, status
""",
)
def agg_ratio_guarded(lake: Lake) -> DataFrame:
    grouped = lake.items.groupBy("category_id", "status").agg(
        numbers.sum_or_zero(F.col("available_quantity")).alias("a"), numbers.sum_or_zero(F.col("sold_quantity")).alias("s")
    )
    rate = numbers.np_round(numbers.percent_of(F.col("s"), F.col("a") + F.col("s")), 2)
    return grouped.select("category_id", "status", rate.alias("rate"))


@query("agg_spread", "select seller_id, max(price) - min(price) as spread from item_details group by seller_id")
def agg_spread(lake: Lake) -> DataFrame:
    return lake.items.groupBy("seller_id").agg((F.max("price") - F.min("price")).alias("spread"))


@query(
    "agg_max_of_maxes",
    "select greatest((select max(ingested_at) from categories), (select max(ingested_at) from domains)) as latest",
)
def agg_max_of_maxes(lake: Lake) -> DataFrame:
    other = stats.whole_table(lake.domains, latest=F.max("ingested_at")).getField("latest")
    return lake.categories.agg(F.max("ingested_at").alias("m")).select(F.greatest("m", other).alias("latest"))


@query(
    "agg_stddev_pop_mean",
    f"select {rnd('stddev_pop(catalog_coverage_score)', 8)} as std, {rnd('avg(catalog_coverage_score)', 8)} as mean from category_metrics",
)
def agg_stddev_pop_mean(lake: Lake) -> DataFrame:
    moments = stats.moments(lake.category_metrics, F.col("catalog_coverage_score"))
    one = lake.category_metrics.agg(F.count(F.lit(1)).alias("n"))
    return one.select(
        numbers.np_round(stats.population_std(moments), 8).alias("std"),
        numbers.np_round(stats.mean_of(moments), 8).alias("mean"),
    )


@query(
    "agg_percentile",
    f"""
select {rnd('quantile_cont(cast(catalog_coverage_score as double), 0.25)', 6)} as q1,
    {rnd('quantile_cont(cast(catalog_coverage_score as double), 0.75)', 6)} as q3 from category_metrics
""",
)
def agg_percentile(lake: Lake) -> DataFrame:
    q = stats.quartiles(lake.category_metrics, F.col("catalog_coverage_score"))
    one = lake.category_metrics.agg(F.count(F.lit(1)).alias("n"))
    return one.select(numbers.np_round(q.getItem(0), 6).alias("q1"), numbers.np_round(q.getItem(1), 6).alias("q3"))


@query(
    "agg_min_max_global",
    """
select event_id, (value - lo) / (hi - lo) * 100 as scaled
from events cross join (select min(value) as lo, max(value) as hi from events) b
""",
)
def agg_min_max_global(lake: Lake) -> DataFrame:
    events = lake.raw("events")
    return events.select("event_id", stats.min_max_score(events, F.col("value")).alias("scaled"))


@query(
    "agg_argmax",
    """
select seller_id, item_id, sold_quantity from (
    select *, row_number() over (partition by seller_id order by sold_quantity desc, item_id) as nth from item_details) x
where nth = 1
""",
)
def agg_argmax(lake: Lake) -> DataFrame:
    best = ranking.row_with_max(F.col("sold_quantity"), F.col("item_id"), F.col("item_id"), F.col("sold_quantity"))
    return lake.items.groupBy("seller_id").agg(best.alias("best")).select("seller_id", "best.item_id", "best.sold_quantity")


@query("agg_distinct_dates", "select count(distinct snapshot_date_key) as dates from category_snapshots")
def agg_distinct_dates(lake: Lake) -> DataFrame:
    return lake.category_snapshots.agg(F.count_distinct("snapshot_date_key").alias("dates"))


# --- windows ---------------------------------------------------------------------------------

CHANGES = ["item_id", "snapshot_date"]


@query("win_lag_price", "select item_id, snapshot_date, price_change_abs from price_history")
def win_lag_price(lake: Lake) -> DataFrame:
    rows = previous.with_previous(lake.prices, "item_id", "snapshot_date", {"before": "price"})
    return rows.select(*CHANGES, numbers.np_round(F.col("price") - F.col("before"), 2).alias("price_change_abs"))


@query("win_pct_change", "select item_id, snapshot_date, price_change_pct from price_history")
def win_pct_change(lake: Lake) -> DataFrame:
    return gold.gold_price_history(lake.prices).select(*CHANGES, "price_change_pct")


@query("win_delta_stock_sold", "select item_id, snapshot_date, stock_change, sold_change from price_history")
def win_delta_stock_sold(lake: Lake) -> DataFrame:
    return gold.gold_price_history(lake.prices).select(*CHANGES, "stock_change", "sold_change")


@query(
    "win_lag_forecast",
    """
select * from (
    select category_id, snapshot_date_key, lag(opportunity_score) over (partition by category_id order by snapshot_date_key) as forecast_value
    from category_snapshots) x
where forecast_value is not null
""",
)
def win_lag_forecast(lake: Lake) -> DataFrame:
    rows = previous.with_previous(
        lake.category_snapshots, "category_id", "snapshot_date_key", {"forecast_value": "opportunity_score"},
        position=F.col("snapshot_date_key"),
    )
    return rows.dropna(subset=["forecast_value"]).select("category_id", "snapshot_date_key", "forecast_value")


@query("win_dense_rank", "select category_id, dense_rank() over (order by catalog_coverage_score desc) as place from category_metrics")
def win_dense_rank(lake: Lake) -> DataFrame:
    return ranking.dense_rank_desc(lake.category_metrics, "catalog_coverage_score", "place").select("category_id", "place")


@query(
    "win_keep_last",
    """
select user_id, event_type, event_id, ts from (
    select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as nth from events) x
where nth = 1
""",
)
def win_keep_last(lake: Lake) -> DataFrame:
    return dedup.keep_last(lake.raw("events"), ["user_id", "event_type"], "ts", ["event_id"]).select(
        "user_id", "event_type", "event_id", "ts"
    )


@query(
    "win_keep_first",
    """
select domain_category_id, search_query, ingested_at from (
    select *, row_number() over (partition by domain_category_id order by ingested_at, search_query nulls last) as nth from domains) x
where nth = 1
""",
)
def win_keep_first(lake: Lake) -> DataFrame:
    return dedup.keep_first(lake.domains, ["domain_category_id"], "ingested_at", ["search_query"]).select(
        "domain_category_id", "search_query", "ingested_at"
    )


@query(
    "win_share_of_total",
    "select o_orderkey, o_custkey / cast((select sum(o_custkey) from orders) as double) as share from orders",
)
def win_share_of_total(lake: Lake) -> DataFrame:
    orders = lake.raw("orders")
    return orders.select("o_orderkey", stats.share_of_total(orders, F.col("o_custkey")).alias("share"))


@query(
    "win_relative_to_max",
    f"select event_id, {rnd('value / (select max(value) from events) * 100')} as score from events",
)
def win_relative_to_max(lake: Lake) -> DataFrame:
    events = lake.raw("events")
    return events.select("event_id", numbers.np_round(stats.relative_to_max(events, F.col("value")), 2).alias("score"))


# --- sort, limit, top-k ----------------------------------------------------------------------

view(
    "ordered_sellers",
    "select *, row_number() over (order by item_count desc, seller_id nulls last, category_id nulls last, status) as nth from mart_seller_item_metrics",
)


@query(
    "sort_multi_key",
    "select seller_id, category_id, status, item_count from mart_seller_item_metrics order by item_count desc nulls last, seller_id nulls last, category_id nulls last, status nulls last",
)
def sort_multi_key(lake: Lake) -> DataFrame:
    rows = lake.mart("mart_seller_item_metrics").select("seller_id", "category_id", "status", "item_count")
    return gold.in_report_order(rows, "seller_item_metrics")


@query(
    "page_limit_offset",
    "select seller_id, category_id, status, item_count, (select count(*) from ordered_sellers) as total from ordered_sellers where nth > 40 and nth <= 65",
)
def page_limit_offset(lake: Lake) -> DataFrame:
    rows = lake.mart("mart_seller_item_metrics").select("seller_id", "category_id", "status", "item_count")
    return paging.page(rows, gold.order_columns("seller_item_metrics"), limit=25, offset=40)


@query("topk_smallest_rank", "select opportunity_rank, category_id, opportunity_score from scores order by opportunity_rank, category_id limit 8")
def topk_smallest_rank(lake: Lake) -> DataFrame:
    rows = ranking.top_k(lake.scores, 8, F.col("opportunity_rank"), F.col("category_id"))
    return rows.select("opportunity_rank", "category_id", "opportunity_score")


@query("topk_largest", "select p_partkey, p_retailprice from part order by p_retailprice desc, p_partkey limit 12")
def topk_largest(lake: Lake) -> DataFrame:
    return ranking.top_k(
        lake.raw("part").select("p_partkey", "p_retailprice"), 12, F.col("p_retailprice").desc(), F.col("p_partkey")
    )


@query(
    "topk_then_resort",
    """
select * from (select category_id, opportunity_score from scores order by opportunity_score desc, category_id limit 15) x
order by opportunity_score, category_id
""",
)
def topk_then_resort(lake: Lake) -> DataFrame:
    first = ranking.top_k(lake.scores, 15, F.col("opportunity_score").desc(), F.col("category_id"))
    return first.select("category_id", "opportunity_score").orderBy("opportunity_score", "category_id")


@query("sort_flagged", "select category_id, anomaly_score from scores where is_anomaly order by anomaly_score desc, category_id")
def sort_flagged(lake: Lake) -> DataFrame:
    return serving.anomalies(lake.scores).select("category_id", "anomaly_score")


# --- sets ------------------------------------------------------------------------------------


@query(
    "union_all_columns",
    """
select ingested_at as ts from categories union all select ingested_at from domains
union all select ingested_at from item_details union all select latest_ingestion_at from marketplace_overview
""",
)
def union_all_columns(lake: Lake) -> DataFrame:
    parts = [lake.categories, lake.domains, lake.items, lake.overview.withColumnRenamed("latest_ingestion_at", "ingested_at")]
    return relational.union_by_name([p.select(F.col("ingested_at").alias("ts")) for p in parts])


@query("distinct_sorted", "select distinct strftime(ingested_at, '%Y-%m-%d') as day from item_details order by day")
def distinct_sorted(lake: Lake) -> DataFrame:
    return lake.items.select(F.date_format("ingested_at", "yyyy-MM-dd").alias("day")).dropna().distinct().orderBy("day")


@query(
    "union_by_name_promote",
    """
select category_id, ingested_at, cast(null as varchar) as domain_id, picture_url from categories
union all select category_id, ingested_at, domain_id, null from domains
""",
)
def union_by_name_promote(lake: Lake) -> DataFrame:
    return relational.union_by_name(
        [lake.categories.select("category_id", "picture_url", "ingested_at"), lake.domains.select("domain_id", "category_id", "ingested_at")]
    )


# --- scalar functions ------------------------------------------------------------------------


@query(
    "fn_string",
    """
select p_partkey, lower(p_name) as lowered, contains(lower(p_type), 'small') or contains(lower(p_type), 'promo') as has_term,
    p_brand || '__' || nullif(p_type, 'PROMO') as joined_key,
    cast(len(list_filter(string_split(case when p_size < 10 then '' else p_type || ' > ' || p_brand || ' > ' end, ' > '), lambda x: x <> '')) as bigint) as depth,
    length(p_name) as chars, replace(p_brand, '#', '-') as safe_name,
    array_to_string(list_filter(list_transform(string_split(p_name || ' , ,' || p_type || ',', ','), lambda x: trim(x)), lambda x: x <> ''), '|') as listed
from part
""",
)
def fn_string(lake: Lake) -> DataFrame:
    path = F.when(F.col("p_size") < 10, "").otherwise(F.concat("p_type", F.lit(" > "), "p_brand", F.lit(" > ")))
    csv = F.concat("p_name", F.lit(" , ,"), "p_type", F.lit(","))
    return lake.raw("part").select(
        "p_partkey",
        F.lower("p_name").alias("lowered"),
        text.contains_any(F.lower("p_type"), ["small", "promo"]).alias("has_term"),
        text.joined_key(F.col("p_brand"), F.nullif("p_type", F.lit("PROMO"))).alias("joined_key"),
        text.path_depth(path).alias("depth"),
        F.char_length("p_name").cast("bigint").alias("chars"),
        F.replace("p_brand", F.lit("#"), F.lit("-")).alias("safe_name"),
        F.array_join(text.csv_list(csv), "|").alias("listed"),
    )


@query(
    "fn_format",
    """
select o_orderkey, replace(format('{:,}', cast(trunc(o_totalprice) as bigint)), ',', '.') as thousands,
    case when big >= 1e6 then replace(printf('%.1fM', round_even(big / 1e5, 0) / 10), '.', ',')
        when big >= 1e3 then printf('%.0f mil', round_even(big / 1e3, 0))
        else replace(format('{:,}', cast(trunc(big) as bigint)), ',', '.') end as compact,
    'Encontrei ' || o_custkey || ' anuncios com status ' || o_orderstatus || '.' as sentence
from (select *, case o_orderstatus when 'P' then o_totalprice * 100 when 'O' then o_totalprice else o_totalprice / 1000 end as big from orders) x
""",
)
def fn_format(lake: Lake) -> DataFrame:
    price, state = F.col("o_totalprice"), F.col("o_orderstatus")
    big = F.when(state == "P", price * 100).when(state == "O", price).otherwise(price / 1000)
    return lake.raw("orders").select(
        "o_orderkey",
        text.pt_thousands(price).alias("thousands"),
        text.pt_compact(big).alias("compact"),
        text.sentence("Encontrei %s anuncios com status %s.", F.col("o_custkey"), state).alias("sentence"),
    )


@query(
    "fn_datetime",
    f"""
select event_id, case when event_type = 'error' then null else ts end as parsed, {date_key("ts")} as date_key,
    date_trunc('day', ts) as day, strftime(ts, '%Y-%m-%d') as date, year(ts) as year, month(ts) as month, day(ts) as day_of_month,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') || case when microsecond(ts) % 1000000 = 0 then '' else strftime(ts, '.%f') end || '+00:00' as iso,
    strftime(ts, '%m') as padded_month, (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1e6 as elapsed
from events
""",
)
def fn_datetime(lake: Lake) -> DataFrame:
    ts = F.col("t")
    written = F.when(F.col("event_type") == "error", "not a time").otherwise(dates.iso_text(ts))
    rows = lake.raw("events").withColumn("t", F.col("ts").cast("timestamp"))
    day = F.date_trunc("day", ts)
    return rows.select(
        "event_id",
        dates.parse_utc(written).alias("parsed"),
        dates.date_key(ts).alias("date_key"),
        day.alias("day"),
        F.date_format(ts, "yyyy-MM-dd").alias("date"),
        F.year(ts).cast("bigint").alias("year"),
        F.month(ts).cast("bigint").alias("month"),
        F.dayofmonth(ts).cast("bigint").alias("day_of_month"),
        dates.iso_text(ts).alias("iso"),
        dates.day_parts(ts)[1].alias("padded_month"),
        dates.seconds_between(day, ts).alias("elapsed"),
    )


@query(
    "fn_math",
    f"""
select l_orderkey, l_linenumber, {rnd("l_extendedprice * l_discount / 8")} as rounded2, {rnd("l_extendedprice * l_discount / 8", 4)} as rounded4,
    {rnd("ln(1 + l_quantity)", 10)} as log_quantity, abs(l_discount - l_tax) as gap, greatest(l_discount, l_tax) as larger,
    case when l_tax > 0 then l_discount / l_tax else 0 end as ratio,
    case when l_returnflag = 'R' then null else l_quantity end as coerced
from lineitem
""",
)
def fn_math(lake: Lake) -> DataFrame:
    amount = F.col("l_extendedprice") * F.col("l_discount") / 8
    written = F.when(F.col("l_returnflag") == "R", "unknown").otherwise(F.col("l_quantity").cast("string"))
    return lake.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.np_round(amount, 2).alias("rounded2"),
        numbers.np_round(amount, 4).alias("rounded4"),
        numbers.np_round(F.log1p("l_quantity"), 10).alias("log_quantity"),
        F.abs(F.col("l_discount") - F.col("l_tax")).alias("gap"),
        F.greatest("l_discount", "l_tax").alias("larger"),
        numbers.ratio_or_zero(F.col("l_discount"), F.col("l_tax")).alias("ratio"),
        numbers.to_number(written).alias("coerced"),
    )


@query(
    "fn_null",
    """
select item_id, coalesce(status, 'unknown') as status, coalesce(available_quantity, 0) as stock, price,
    nullif(title, 'red widget') as title
from item_details
""",
)
def fn_null(lake: Lake) -> DataFrame:
    not_a_number = F.coalesce("price", F.lit(float("nan")))
    return lake.items.select(
        "item_id",
        F.coalesce("status", F.lit("unknown")).alias("status"),
        F.coalesce("available_quantity", F.lit(0)).alias("stock"),
        F.nanvl(not_a_number, F.lit(None).cast("double")).alias("price"),
        F.nullif("title", F.lit("red widget")).alias("title"),
    )


@query(
    "fn_json",
    """
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, cast(null as varchar) as missing,
    '{"id":' || event_id || ',"kind":"' || event_type || '"}' as encoded, user_id as inner_user
from events
""",
)
def fn_json(lake: Lake) -> DataFrame:
    nested = F.to_json(F.struct(F.struct(F.struct(F.col("user_id").alias("b")).alias("a")).alias("settings")))
    props = parse_object(F.col("props"), "k bigint, missing string")
    return lake.raw("events").select(
        "event_id",
        props.getField("k").alias("k"),
        props.getField("missing").alias("missing"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("encoded"),
        F.get_json_object(nested, "$.settings.a.b").cast("bigint").alias("inner_user"),
    )


@query(
    "fn_array",
    """
select doc_id, cast(len(string_split(text, ' ')) as bigint) as words,
    cast(len(list_filter(string_split(text, ' '), lambda x: length(x) > 8)) as bigint) as long_words,
    array_to_string(list_transform(string_split(lang || ',' || source, ','), lambda x: upper(x)), ' > ') as path
from documents
""",
)
def fn_array(lake: Lake) -> DataFrame:
    words = F.split("text", " ", -1)
    parts = F.split(F.concat("lang", F.lit(","), "source"), ",", -1)
    return lake.raw("documents").select(
        "doc_id",
        F.coalesce(F.size(words), F.lit(0)).cast("bigint").alias("words"),
        F.size(F.filter(words, lambda w: F.char_length(w) > 8)).cast("bigint").alias("long_words"),
        F.array_join(F.transform(parts, F.upper), " > ").alias("path"),
    )


@query(
    "fn_map",
    """
select user_id, event_type, count(*) as events from events group by user_id, event_type
""",
)
def fn_map(lake: Lake) -> DataFrame:
    """Counts per user gathered into a map of event types and unfolded again.

    Types are counted before the map is built, so a map holds one entry per type, not per event.
    """
    counted = lake.raw("events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("events"))
    maps = counted.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "events"))).alias("m"))
    return maps.select("user_id", F.explode("m").alias("event_type", "events"))


@query(
    "fn_cast",
    """
select p_partkey, cast(p_size as bigint) as whole, cast(null as bigint) as fraction, case when p_size > 25 then null else p_size::bigint end as mixed,
    p_size > 25 as flag, cast(p_size as double) as number, cast(p_partkey as varchar) as written
from part
""",
)
def fn_cast(lake: Lake) -> DataFrame:
    size = F.col("p_size")
    return lake.raw("part").select(
        "p_partkey",
        numbers.to_whole_number(F.concat(size.cast("string"), F.lit(".0"))).alias("whole"),
        numbers.to_whole_number(F.concat(size.cast("string"), F.lit(".5"))).alias("fraction"),
        numbers.to_whole_number(F.when(size > 25, "n/a").otherwise(size.cast("string"))).alias("mixed"),
        F.when(size > 25, "true").otherwise("false").try_cast("boolean").alias("flag"),
        numbers.to_number(size.cast("string")).alias("number"),
        F.col("p_partkey").cast("string").alias("written"),
    )
