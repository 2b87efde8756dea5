"""Models, served queries, answers, dashboard and observability (inventory 2.15 to 2.18)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens import fixed_values as fixed
from bazaarlens.functions.numbers import np_round
from bazaarlens.operators import stats
from bazaarlens.plans import answers, dashboard, intents, isolation, marts, observability, scoring, serving
from bazaarlens.plans.clusters import fit_clusters, standardised
from bazaarlens.plans.pipeline import PUBLIC_ENTITIES, SELLER_ENTITIES, run_pipeline
from bazaarlens.session import scratch_path
from bazaarlens.sources.documents import read_documents, write_document
from bazaarlens.sources.history import read_history
from bazaarlens.sources.tables import append_snapshots, read_table, write_table
from workload.check_views import rnd
from workload.inputs import QUESTIONS, Lake
from workload import cluster_views, forest_views  # noqa: F401
from workload.registry import query, view

# Irrational results (logarithms, roots) are compared at ten decimals: the last bit of a
# logarithm is the math library's.


def at_ten(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: np_round(F.col(c), 10) for c in columns})


# --- models ----------------------------------------------------------------------------------


@query("ml_category_features", f"select * replace ({rnd('total_items_log', 10)} as total_items_log) from features")
def ml_category_features(lake: Lake) -> DataFrame:
    return at_ten(scoring.build_category_features(lake.mart("mart_category_metrics")), "total_items_log")


@query("ml_zscore", f"select category_id, {rnd('zscore_abs', 10)} as zscore_abs from anomalies")
def ml_zscore(lake: Lake) -> DataFrame:
    z = stats.z_score(lake.features, F.coalesce("catalog_coverage_score", F.lit(0.0)))
    return at_ten(lake.features.select("category_id", F.abs(z).alias("zscore_abs")), "zscore_abs")


@query("ml_iqr_outlier", "select category_id, iqr_anomaly from anomalies")
def ml_iqr_outlier(lake: Lake) -> DataFrame:
    x = F.coalesce("catalog_coverage_score", F.lit(0.0))
    lower, upper = scoring.iqr_bounds(lake.features, x)
    return lake.features.select("category_id", ((x < lower) | (x > upper)).alias("iqr_anomaly"))


@query("ml_isolation_forest", f"select category_id, snapshot_date_key, {rnd('isolation_score', 8)} as isolation_score from forest_scores")
def ml_isolation_forest(lake: Lake) -> DataFrame:
    """Every draw is a hash, so the check grows and walks the same trees; path lengths are summed in another order there."""
    rows = isolation.isolation_scores(lake.features).select("category_id", "snapshot_date_key", "isolation_score")
    return rows.withColumn("isolation_score", np_round(F.col("isolation_score"), 8))


ANOMALY_SQL = f"""
select a.* exclude (upper_bound) replace (
    {rnd('total_items_log', 10)} as total_items_log, {rnd('zscore_abs', 10)} as zscore_abs, {rnd('f.isolation_score', 8)} as isolation_score,
    {rnd('greatest(a.zscore_abs * 20, f.isolation_score)', 4)} as anomaly_score)
from anomalies a join forest_scores f on a.category_id = f.category_id and a.snapshot_date_key = f.snapshot_date_key
"""


@query("ml_anomaly_flags", ANOMALY_SQL)
def ml_anomaly_flags(lake: Lake) -> DataFrame:
    rows = at_ten(scoring.detect_anomalies(isolation.isolation_scores(lake.features)), "total_items_log", "zscore_abs")
    return rows.withColumn("isolation_score", np_round(F.col("isolation_score"), 8))


@query("ml_opportunity_score", "select category_id, competition_density, is_anomaly, opportunity_score from scores")
def ml_opportunity_score(lake: Lake) -> DataFrame:
    rows = scoring.calculate_opportunity_score(lake.anomalies)
    return rows.select("category_id", "competition_density", "is_anomaly", "opportunity_score")


@query("ml_opportunity_rank", "select opportunity_rank, category_id, opportunity_score from scores order by opportunity_rank, category_id")
def ml_opportunity_rank(lake: Lake) -> DataFrame:
    rows = scoring.calculate_opportunity_score(lake.anomalies)
    return rows.select("opportunity_rank", "category_id", "opportunity_score").orderBy("opportunity_rank", "category_id")


@query(
    "ml_standardise",
    "select category_id, "
    + ", ".join(
        rnd(f"case when (select stddev_pop({c}) from features) > 0 then ({c} - (select avg({c}) from features)) / (select stddev_pop({c}) from features) else 0 end", 8)
        + f" as {c}"
        for c in fixed.FEATURE_COLUMNS
    )
    + " from features",
)
def ml_standardise(lake: Lake) -> DataFrame:
    rows = lake.features.select("category_id", *standardised(lake.features))
    # averages of doubles are compared at eight decimals; adding 0.0 turns -0.0 into 0.0
    return rows.withColumns({c: np_round(F.col(c), 8) + F.lit(0.0) for c in fixed.FEATURE_COLUMNS})


@query("ml_kmeans_sweep", f"select cast(k as int) as k, {rnd('silhouette_score', 8)} as silhouette_score from cluster_candidates")
def ml_kmeans_sweep(lake: Lake) -> DataFrame:
    """Starts follow a hash, so the check runs every fit again; silhouettes compare every two points there."""
    _, candidates = fit_clusters(lake.scores)
    return candidates.withColumn("silhouette_score", np_round(F.col("silhouette_score"), 8))


def _clusters(lake: Lake) -> DataFrame:
    return lake.stored("clusters", lambda: fit_clusters(lake.scores)[0])


@query("ml_cluster_assign", "select * from clusters")
def ml_cluster_assign(lake: Lake) -> DataFrame:
    return _clusters(lake).select("category_id", "cluster_id", "cluster_label", "cluster_distance")


FORECAST_SQL = """
select category_id, snapshot_date_key, opportunity_score, forecast_value, 'naive_previous_snapshot' as model_name from (
    select *, lag(opportunity_score) over (partition by category_id order by snapshot_date_key) as forecast_value
    from category_snapshots) x
where forecast_value is not null
"""


@query("ml_naive_forecast", FORECAST_SQL)
def ml_naive_forecast(lake: Lake) -> DataFrame:
    return scoring.build_naive_forecast(lake.category_snapshots)


@query(
    "ml_readiness",
    """
select 'scores' as source_name, 'clustering' as name, count(*) >= 5 as ready,
    case when count(*) >= 5 then 'Dataset has enough rows for baseline clustering.'
        else 'Requires at least 5 rows; current dataset has ' || count(*) || '.' end as reason from scores
union all select 'scores', 'forecasting', count(distinct snapshot_date_key) >= 14,
    case when count(distinct snapshot_date_key) >= 14 then 'Dataset has enough temporal snapshots.'
        else 'Requires at least 14 temporal snapshots; current dataset has ' || count(distinct snapshot_date_key) || '.' end from scores
union all select 'category_snapshots', 'clustering', count(*) >= 5, 'Dataset has enough rows for baseline clustering.' from category_snapshots
union all select 'category_snapshots', 'forecasting', count(distinct snapshot_date_key) >= 14,
    'Dataset has enough temporal snapshots.' from category_snapshots
""",
)
def ml_readiness(lake: Lake) -> DataFrame:
    frames = {"scores": lake.scores, "category_snapshots": lake.category_snapshots}
    parts = [scoring.readiness(df).select(F.lit(n).alias("source_name"), "name", "ready", "reason") for n, df in frames.items()]
    return parts[0].unionByName(parts[1])


# two dated runs: the later one lands the last dates again, with other scores, and a category that paused
view(
    "dated_snapshots",
    """
select category_id, snapshot_date_key, case when snapshot_date_key >= since then opportunity_score + 1 else opportunity_score end as opportunity_score
from category_snapshots, (select min(d) as since from (select distinct snapshot_date_key as d from category_snapshots order by d desc limit 5) l) s
where not (category_id = 'click' and snapshot_date_key < since and snapshot_date_key >= (
    select min(d) from (select distinct snapshot_date_key as d from category_snapshots order by d desc limit 12) m))
""",
)
SNAPSHOT_SCHEMA = "category_id string, opportunity_score double, snapshot_date_key bigint"


def _two_runs(lake: Lake) -> tuple[DataFrame, int]:
    path = scratch_path(lake.spark, "snapshots")
    dates = [r[0] for r in lake.category_snapshots.select("snapshot_date_key").distinct().orderBy(F.desc("snapshot_date_key")).head(12)]
    since, pause = dates[4], dates[-1]
    day = F.col("snapshot_date_key")
    away = (F.col("category_id") == "click") & (day >= pause) & (day < since)
    append_snapshots(lake.category_snapshots.filter(~away), path, "category_id")
    again = lake.category_snapshots.filter(day >= since).withColumn("opportunity_score", F.col("opportunity_score") + 1)
    append_snapshots(again, path, "category_id")
    return read_history(lake.spark, path, SNAPSHOT_SCHEMA), since


@query(
    "ml_history_forecast",
    """
select * from (
    select category_id, snapshot_date_key, opportunity_score, lag(opportunity_score) over (partition by category_id order by snapshot_date_key) as forecast_value,
        'naive_previous_snapshot' as model_name from dated_snapshots) x
where forecast_value is not null and snapshot_date_key >= (
    select min(d) from (select distinct snapshot_date_key as d from category_snapshots order by d desc limit 5) l)
""",
)
def ml_history_forecast(lake: Lake) -> DataFrame:
    """Forecasts of the dates that the second run changed, read from the history."""
    return scoring.forecast_from(*_two_runs(lake))


@query(
    "ml_history_readiness",
    """
select 'clustering' as name, count(*) >= 5 as ready, 'Dataset has enough rows for baseline clustering.' as reason from dated_snapshots
union all select 'forecasting', count(distinct snapshot_date_key) >= 14, 'Dataset has enough temporal snapshots.' from dated_snapshots
""",
)
def ml_history_readiness(lake: Lake) -> DataFrame:
    """Are there dates enough, counted over all runs?"""
    return scoring.readiness(_two_runs(lake)[0])


METADATA_SQL = """
select 'category_ml_baseline_v1' as model_version,
    'total_items_log,domain_count,category_depth,catalog_coverage_score,items_share,competition_density' as features,
    count(*) as output_rows, sum(case when is_anomaly then 1 else 0 end)::bigint as anomaly_count,
    'z_score,iqr,isolation_forest' as methods, true as isolation_forest_used, cast(null as varchar) as limitation, 42 as random_state
from scores
"""


def _flat_metadata(scores: DataFrame) -> DataFrame:
    described = scoring.model_metadata(scores)
    return described.withColumns({c: F.array_join(c, ",") for c in ("features", "methods")})


@query("ml_metadata", METADATA_SQL)
def ml_metadata(lake: Lake) -> DataFrame:
    return _flat_metadata(lake.scores)


SCORES_SQL = f"""
select category_id, category_name, snapshot_date_key, snapshot_date, {rnd('total_items_log', 10)} as total_items_log,
    domain_count, category_depth, catalog_coverage_score, items_share, competition_density,
    {rnd('zscore_abs', 10)} as zscore_abs, iqr_anomaly, is_anomaly, anomaly_type, opportunity_score, opportunity_rank
from scores
"""


def _scored_afresh(lake: Lake) -> DataFrame:
    """Mart to scores, with every stage written and read back as the pipeline does."""
    root = scratch_path(lake.spark, "ml")
    write_table(scoring.build_category_features(marts.mart_category_metrics(lake.star)), f"{root}/features")
    features = read_table(lake.spark, f"{root}/features")
    flagged = scoring.detect_anomalies(isolation.isolation_scores(features))
    write_table(flagged, f"{root}/anomalies")
    return scoring.calculate_opportunity_score(read_table(lake.spark, f"{root}/anomalies"))


@query("ml_pipeline", SCORES_SQL)
def ml_pipeline(lake: Lake) -> DataFrame:
    """The isolation score is random and left out, with the combined score it can raise."""
    rows = _scored_afresh(lake).drop("isolation_score", "anomaly_score")
    return at_ten(rows, "total_items_log", "zscore_abs")


@query(
    "ml_advanced_pipeline",
    f"""
select 'clustering' as name, true as ready, 'Dataset has enough rows for baseline clustering.' as reason,
    (select count(*) from scores) as output_rows from category_snapshots having count(*) >= 5
union all select 'forecasting', true, 'Dataset has enough temporal snapshots.', (select count(*) from ({FORECAST_SQL}) f)
    from category_snapshots having count(distinct snapshot_date_key) >= 14
""",
)
def ml_advanced_pipeline(lake: Lake) -> DataFrame:
    """Readiness decides which models run; one row per model with its output size."""
    state = scoring.readiness(lake.category_snapshots)
    ready = {r["name"] for r in state.filter("ready").collect()}
    clusters = _clusters(lake) if "clustering" in ready else lake.scores.filter("false")
    forecast = scoring.build_naive_forecast(lake.category_snapshots.filter(F.lit("forecasting" in ready)))
    sizes = F.when(F.col("name") == "clustering", clusters.select(F.count(F.lit(1))).scalar()).otherwise(
        forecast.select(F.count(F.lit(1))).scalar()
    )
    return state.withColumn("output_rows", sizes)


# --- served queries --------------------------------------------------------------------------

ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S') || '+00:00'"


@query("q_overview", f"select * replace ({ISO.format('latest_ingestion_at')} as latest_ingestion_at) from mart_marketplace_overview order by snapshot_date_key desc")
def q_overview(lake: Lake) -> DataFrame:
    return serving.overview(lake.mart("mart_marketplace_overview"))


@query(
    "q_categories_page",
    """
select *, (select count(*) from mart_category_metrics) as total from mart_category_metrics
order by catalog_coverage_score desc, category_id limit 20 offset 10
""",
)
def q_categories_page(lake: Lake) -> DataFrame:
    return serving.categories_page(lake.mart("mart_category_metrics"), limit=20, offset=10)


@query("q_category_by_id", "select * from mart_category_metrics where category_id = 'Brand#7-LARGE'")
def q_category_by_id(lake: Lake) -> DataFrame:
    return serving.category(lake.mart("mart_category_metrics"), "Brand#7-LARGE")


@query(
    "q_seller_metrics_page",
    """
select *, (select count(*) from mart_seller_item_metrics) as total from mart_seller_item_metrics
order by item_count desc, seller_id nulls last, category_id nulls last, status limit 50 offset 100
""",
)
def q_seller_metrics_page(lake: Lake) -> DataFrame:
    return serving.seller_metrics_page(lake.mart("mart_seller_item_metrics"), limit=50, offset=100)


@query(
    "q_seller_items_page",
    """
select *, (select count(*) from mart_seller_items where status = 'active' and category_id = 'Brand#13-ECONOMY') as total
from mart_seller_items where status = 'active' and category_id = 'Brand#13-ECONOMY'
order by snapshot_date_key desc, item_id limit 30 offset 5
""",
)
def q_seller_items_page(lake: Lake) -> DataFrame:
    items = lake.mart("mart_seller_items")
    return serving.seller_items_page(items, 30, 5, category_id="Brand#13-ECONOMY", status="active")


@query(
    "q_scores_page",
    """
select opportunity_rank, category_id, opportunity_score, (select count(*) from scores) as total from scores
order by opportunity_rank, category_id limit 25 offset 5
""",
)
def q_scores_page(lake: Lake) -> DataFrame:
    return serving.scores_page(lake.scores, 25, 5).select("opportunity_rank", "category_id", "opportunity_score", "total")


@query("q_anomalies", "select category_id, anomaly_type, anomaly_score, opportunity_score from scores where is_anomaly order by anomaly_score desc, category_id")
def q_anomalies(lake: Lake) -> DataFrame:
    return serving.anomalies(lake.scores).select("category_id", "anomaly_type", "anomaly_score", "opportunity_score")


@query(
    "q_price_history_page",
    f"""
select * replace ({ISO.format('snapshot_date')} as snapshot_date), (select count(*) from price_history) as total from price_history
order by snapshot_date_key desc, item_id limit 40 offset 20
""",
)
def q_price_history_page(lake: Lake) -> DataFrame:
    return serving.price_history_page(lake.price_history, 40, 20)


@query("q_query_metrics", "select * from query_metrics order by domain_count desc, category_count desc, search_query nulls last")
def q_query_metrics(lake: Lake) -> DataFrame:
    return serving.query_metrics(lake.query_metrics)


@query(
    "q_model_metadata",
    f"""
select model_version, output_rows, anomaly_count, isolation_forest_used, limitation, random_state from ({METADATA_SQL}) m
""",
)
def q_model_metadata(lake: Lake) -> DataFrame:
    path = scratch_path(lake.spark, "metadata")
    write_document(scoring.model_metadata(lake.scores), path)
    return read_documents(
        lake.spark,
        path,
        "model_version string, output_rows bigint, anomaly_count bigint, isolation_forest_used boolean, "
        "limitation string, random_state int",
    )


# --- questions and answers -------------------------------------------------------------------


def _any(terms) -> str:
    return "(" + " or ".join(f"contains(t, '{term}')" for term in terms) + ")" if terms else "true"


def _case(rules, otherwise: str, column: int) -> str:
    arms = " ".join(f"when {_any(r[2])} then {r[column]!r}" for r in rules)
    return f"case {arms} else {otherwise} end"


def _intent_sql(column: int, unknown: str) -> str:
    seller = _case(fixed.SELLER_INTENTS, "null", column)
    listed = f"case when {_any(fixed.ITEM_LIST_TERMS)} then {_case(fixed.ITEM_INTENTS, 'null', column)} end"
    market = _case(fixed.MARKET_INTENTS, unknown, column)
    return f"case when {_any(fixed.SELLER_TERMS)} then coalesce({listed}, {seller}) else {market} end"


view(
    "questions",
    "select conv_id, turn, list_extract(["
    + ", ".join(f"'{q}'" for q in QUESTIONS)
    + f"], cast(conv_id % {len(QUESTIONS)} as int) + 1) || ' ' || text as question from conversations where role = 'user'",
)
view(
    "classified",
    f"""
select conv_id, turn, question, {_intent_sql(0, "'unknown'")} as intent, cast({_intent_sql(1, "0.0")} as double) as confidence
from (select *, lower(question) as t from questions) lowered
""",
)


@query("intent_classify", "select conv_id, turn, intent, confidence from classified")
def intent_classify(lake: Lake) -> DataFrame:
    return intents.classify(lake.questions, "question").select("conv_id", "turn", "intent", "confidence")


def _fill(template: str, *values: str) -> str:
    """The sentence as a SQL concatenation."""
    pieces = template.replace("%%", "%").split("%s")
    out = f"'{pieces[0]}'"
    for value, piece in zip(values, pieces[1:], strict=True):
        out += f" || coalesce(cast({value} as varchar), 'None') || '{piece}'"
    return out


def _leader_sql(metric: str) -> str:
    return f"""(select category_id, status, {metric} as value from mart_seller_item_metrics
        order by {metric} desc, item_count desc, seller_id nulls last, category_id nulls last, status limit 1)"""


ANSWER_SQL = {
    "top_opportunities": f"""
select 'top_opportunities' as intent, {_fill(fixed.ANSWER_OPPORTUNITIES, "category_name", "opportunity_score", "n")} as answer, n as total
from (select * from scores order by opportunity_rank, category_id limit 1) a cross join (select count(*) as n from scores) b""",
    "anomalies": f"""
select 'anomalies' as intent, {_fill(fixed.ANSWER_ANOMALIES, "count(*)")} as answer, count(*) as total from scores where is_anomaly""",
    "category_variation": f"""
select 'category_variation' as intent, {_fill(fixed.ANSWER_VARIATION, "reason")} as answer, cast(null as bigint) as total
from (select case when count(distinct snapshot_date_key) >= 14 then '{fixed.FORECASTING_READY}'
    else 'Requires at least 14 temporal snapshots; current dataset has ' || count(distinct snapshot_date_key) || '.' end as reason from scores) r""",
    "advanced_ml_status": f"""
select 'advanced_ml_status' as intent, {_fill(fixed.ANSWER_ML_STATUS, "c", "cr", "f", "fr")} as answer, cast(null as bigint) as total
from (select case when count(*) >= 5 then 'True' else 'False' end as c,
    case when count(*) >= 5 then '{fixed.CLUSTERING_READY}' else 'Requires at least 5 rows; current dataset has ' || count(*) || '.' end as cr,
    case when count(distinct snapshot_date_key) >= 14 then 'True' else 'False' end as f,
    case when count(distinct snapshot_date_key) >= 14 then '{fixed.FORECASTING_READY}'
    else 'Requires at least 14 temporal snapshots; current dataset has ' || count(distinct snapshot_date_key) || '.' end as fr from scores) r""",
    "marketplace_overview": f"""
select 'marketplace_overview' as intent, {_fill(fixed.ANSWER_OVERVIEW, "total_categories", "total_domains", "total_items_in_categories")} as answer, cast(1 as bigint) as total
from (select * from mart_marketplace_overview order by snapshot_date_key desc limit 1) o""",
    "seller_summary": f"""
select 'seller_summary' as intent, {_fill(fixed.ANSWER_SELLER_SUMMARY, "cast(sum(item_count) as bigint)", "cast(sum(active_item_count) as bigint)", "count(distinct category_id)", "cast(sum(zero_sales_stock_count) as bigint)")} as answer,
    count(*) as total from mart_seller_item_metrics""",
    "seller_top_categories": f"""
select 'seller_top_categories' as intent, {_fill(fixed.ANSWER_SELLER_TOP_CATEGORY, "category_id", "value", "status")} as answer,
    (select count(*) from mart_seller_item_metrics) as total from {_leader_sql("item_count")} l""",
    "seller_stock": f"""
select 'seller_stock' as intent, {_fill(fixed.ANSWER_SELLER_STOCK, "stock", "category_id", "value", "unsold")} as answer, n as total
from {_leader_sql("total_available_quantity")} l cross join (select count(*) as n, cast(sum(total_available_quantity) as bigint) as stock,
    cast(sum(zero_sales_stock_count) as bigint) as unsold from mart_seller_item_metrics) t""",
    "seller_sales": f"""
select 'seller_sales' as intent, {_fill(fixed.ANSWER_SELLER_SALES, "sold", "category_id", "value", "rate")} as answer, n as total
from {_leader_sql("total_sold_quantity")} l cross join (select count(*) as n, cast(sum(total_sold_quantity) as bigint) as sold,
    {rnd("cast(sum(cast(sell_through_rate as decimal(9,2))) as double) / count(*)")} as rate from mart_seller_item_metrics) t""",
}


def _items_sql(where: str, order: str) -> str:
    return f"select *, row_number() over (order by {order}) as place from mart_seller_items where {where} qualify place <= 5"


_LATEST = "snapshot_date_key desc, item_id"
_LINE = _fill(fixed.ANSWER_ITEM, "coalesce(nullif(title, ''), item_id)", "price", "available_quantity", "sold_quantity", "status")
_UNSOLD = "coalesce(sold_quantity, 0) = 0 and coalesce(available_quantity, 0) > 0"


def _list_sql(intent: str, prefix: str, where: str, order: str, total: str) -> str:
    return f"""
select '{intent}' as intent, {prefix} || ' ' || string_agg({_LINE}, ' ' order by place) as answer, {total} as total
from ({_items_sql(where, order)}) top_items"""


for _intent, _status in (("seller_paused_items", "paused"), ("seller_active_items", "active")):
    _n = f"(select count(*) from mart_seller_items where status = '{_status}')"
    ANSWER_SQL[_intent] = _list_sql(
        _intent, _fill(fixed.ANSWER_ITEMS_BY_STATUS, _n, f"'{_status}'"), f"status = '{_status}'", _LATEST, _n
    )
ANSWER_SQL["seller_zero_sales_items"] = _list_sql(
    "seller_zero_sales_items", _fill(fixed.ANSWER_ZERO_SALES, "count(*)"), _UNSOLD, _LATEST, "count(*)"
)
for _intent, _metric in (("seller_top_stock_items", "available_quantity"), ("seller_expensive_items", "price")):
    ANSWER_SQL[_intent] = _list_sql(
        _intent, _fill(fixed.ANSWER_TOP_ITEMS, "count(*)", f"'{_metric}'"), "true",
        f"coalesce({_metric}, 0) desc, {_LATEST}", "(select count(*) from mart_seller_items)",
    )
ANSWER_SQL["unknown"] = f"select 'unknown' as intent, '{fixed.ANSWER_UNKNOWN}' as answer, cast(null as bigint) as total"
for _intent, _sql in ANSWER_SQL.items():
    view(f"answer_{_intent}", _sql)


@query(
    "ans_top_opportunities",
    "select opportunity_rank, category_id, opportunity_score, (select count(*) from scores) as total from scores order by opportunity_rank, category_id limit 5",
)
def ans_top_opportunities(lake: Lake) -> DataFrame:
    rows = answers.top_opportunities_rows(lake.scores)
    return rows.select("opportunity_rank", "category_id", "opportunity_score", "total")


@query("ans_anomaly_count", "select * from answer_anomalies")
def ans_anomaly_count(lake: Lake) -> DataFrame:
    return answers.anomaly_count(lake.scores)


@query("ans_readiness", "select * from answer_category_variation union all select * from answer_advanced_ml_status")
def ans_readiness(lake: Lake) -> DataFrame:
    return answers.readiness_answers(lake.scores)


@query("ans_overview", "select intent, answer, total from answer_marketplace_overview")
def ans_overview(lake: Lake) -> DataFrame:
    return answers.overview_answer(lake.mart("mart_marketplace_overview"))


@query("ans_seller_summary", "select * from answer_seller_summary")
def ans_seller_summary(lake: Lake) -> DataFrame:
    return answers.seller_summary(lake.mart("mart_seller_item_metrics"))


@query("ans_seller_top_category", "select * from answer_seller_top_categories")
def ans_seller_top_category(lake: Lake) -> DataFrame:
    return answers.seller_top_category(lake.mart("mart_seller_item_metrics"))


@query("ans_seller_stock", "select * from answer_seller_stock")
def ans_seller_stock(lake: Lake) -> DataFrame:
    return answers.seller_stock(lake.mart("mart_seller_item_metrics"))


@query("ans_seller_sales", "select * from answer_seller_sales")
def ans_seller_sales(lake: Lake) -> DataFrame:
    return answers.seller_sales(lake.mart("mart_seller_item_metrics"))


@query("ans_items_by_status", "select * from answer_seller_paused_items union all select * from answer_seller_active_items")
def ans_items_by_status(lake: Lake) -> DataFrame:
    items = lake.mart("mart_seller_items")
    paused = answers.items_by_status_answer(items, "seller_paused_items", "paused")
    return paused.unionByName(answers.items_by_status_answer(items, "seller_active_items", "active"))


@query("ans_zero_sales_items", "select * from answer_seller_zero_sales_items")
def ans_zero_sales_items(lake: Lake) -> DataFrame:
    return answers.zero_sales_answer(lake.mart("mart_seller_items"))


@query("ans_top_items_by_metric", "select * from answer_seller_top_stock_items union all select * from answer_seller_expensive_items")
def ans_top_items_by_metric(lake: Lake) -> DataFrame:
    items = lake.mart("mart_seller_items")
    stock = answers.top_items_answer(items, "seller_top_stock_items", "available_quantity")
    return stock.unionByName(answers.top_items_answer(items, "seller_expensive_items", "price"))


def _answers(lake: Lake) -> DataFrame:
    return answers.all_answers(
        lake.scores, lake.mart("mart_marketplace_overview"), lake.mart("mart_seller_item_metrics"),
        lake.mart("mart_seller_items"),
    )


@query(
    "ans_batch",
    "select c.conv_id, c.turn, c.intent, c.confidence, a.answer, a.total from classified c left join ("
    + " union all ".join(f"select * from answer_{i}" for i in ANSWER_SQL)
    + ") a on c.intent = a.intent",
)
def ans_batch(lake: Lake) -> DataFrame:
    answered = answers.answer_batch(lake.questions, "question", lake.stored("answers", lambda: _answers(lake)))
    return answered.select("conv_id", "turn", "intent", "confidence", "answer", "total")


# --- dashboard -------------------------------------------------------------------------------


@query(
    "dash_kpis",
    """
select total_categories, total_domains, replace(format('{:,}', total_items_in_categories), ',', '.') as mapped_items,
    (select count(*) from scores) as opportunities, (select count(*) from scores where is_anomaly) as anomalies
from mart_marketplace_overview order by snapshot_date_key desc limit 1
""",
)
def dash_kpis(lake: Lake) -> DataFrame:
    return dashboard.kpis(lake.mart("mart_marketplace_overview"), lake.scores)


def _compact(x: str) -> str:
    return f"""case when {x} >= 1e6 then replace(printf('%.1fM', round_even({x} / 1e5, 0) / 10), '.', ',')
        when {x} >= 1e3 then printf('%.0f mil', round_even({x} / 1e3, 0)) else replace(format('{{:,}}', {x}), ',', '.') end"""


@query(
    "dash_market_size_by_query",
    f"""
select *, {_compact("total_items_in_categories")} as size_label from (
    select * from query_metrics order by domain_count desc, category_count desc, search_query nulls last limit 8) x
""",
)
def dash_market_size_by_query(lake: Lake) -> DataFrame:
    return dashboard.market_size_by_query(lake.query_metrics)


@query(
    "dash_top_opportunities",
    "select opportunity_rank, category_name, opportunity_score, is_anomaly from scores order by opportunity_rank, category_id limit 8",
)
def dash_top_opportunities(lake: Lake) -> DataFrame:
    return dashboard.top_opportunities(lake.scores)


@query(
    "dash_top_categories",
    f"""
select category_id, category_name, total_items_in_this_category,
    case coverage_band when 'high_coverage' then 'Alta cobertura' when 'medium_coverage' then 'Media cobertura' else 'Baixa cobertura' end as coverage_label,
    domain_count, catalog_coverage_score, {_compact("total_items_in_this_category")} as size_label
from mart_category_metrics where coverage_band in ('medium_coverage', 'low_coverage')
order by total_items_in_this_category desc nulls last, category_id limit 12
""",
)
def dash_top_categories(lake: Lake) -> DataFrame:
    return dashboard.top_categories(lake.mart("mart_category_metrics"), ["Media cobertura", "Baixa cobertura"])


@query(
    "dash_coverage_vs_depth",
    """
select category_id, category_name, category_depth, catalog_coverage_score, total_items_in_this_category, domain_count,
    case coverage_band when 'high_coverage' then 'Alta cobertura' when 'medium_coverage' then 'Media cobertura' else 'Baixa cobertura' end as coverage_label
from mart_category_metrics
""",
)
def dash_coverage_vs_depth(lake: Lake) -> DataFrame:
    return dashboard.coverage_vs_depth(lake.mart("mart_category_metrics"))


@query(
    "dash_score_kpis",
    f"""
select max(opportunity_score) as max_score, {rnd("cast(sum(cast(opportunity_score as decimal(9,2))) as double) / count(*)")} as mean_score,
    count(*) as categories from scores
""",
)
def dash_score_kpis(lake: Lake) -> DataFrame:
    return dashboard.score_kpis(lake.scores)


@query(
    "dash_top_scores",
    f"""
select category_id, category_name, opportunity_score, opportunity_rank, anomaly_score, anomaly_type, is_anomaly,
    {rnd("opportunity_score", 1)} as score_label
from scores order by opportunity_score desc, category_id limit 15
""",
)
def dash_top_scores(lake: Lake) -> DataFrame:
    return dashboard.top_scores(lake.scores)


@query(
    "dash_score_histogram",
    """
select least(cast(floor(opportunity_score / 12.5) as bigint) + 1, 8) as bin, is_anomaly, count(*) as categories,
    (least(cast(floor(opportunity_score / 12.5) as bigint) + 1, 8) - 1) * 12.5e0 as bin_start
from scores group by 1, 2, 4
""",
)
def dash_score_histogram(lake: Lake) -> DataFrame:
    return dashboard.score_histogram(lake.scores)


# --- observability ---------------------------------------------------------------------------

view(
    "run_outputs",
    """
select 'run-' || l_orderkey as run_id, l_returnflag,
    cast(sum(case when l_linestatus = 'O' then cast(l_quantity as bigint) else 0 end) as bigint) as o_rows,
    cast(sum(case when l_linestatus = 'F' then cast(l_quantity as bigint) else 0 end) as bigint) as f_rows
from lineitem group by l_orderkey, l_returnflag
""",
)
view(
    "runs",
    """
select 'run-' || o_orderkey as run_id, case when o_orderstatus = 'F' then 'failed' else 'success' end as status,
    o_orderpriority as query, o_orderdate as started_at, o_orderdate + to_microseconds(o_custkey * 1000) as finished_at,
    o_custkey / 1000e0 as duration_seconds, coalesce(n, 0) as task_count,
    coalesce(statuses, '') as all_statuses, coalesce(reported, '') as reported_statuses, coalesce(rows, 0) as total_rows_processed
from orders left join (
    select run_id, count(*) as n, cast(sum(o_rows + f_rows) as bigint) as rows,
        string_agg('task_' || l_returnflag || '=' || case when l_returnflag = 'N' then 'skipped' else 'success' end, ',' order by l_returnflag) as statuses,
        string_agg('task_' || l_returnflag || '=' || case when l_returnflag = 'N' then 'skipped' else 'success' end, ',' order by l_returnflag)
            filter (where l_returnflag <> 'A') as reported
    from run_outputs group by run_id) t on 'run-' || o_orderkey = t.run_id
""",
)


def _map_text(column: str) :
    pairs = F.array_sort(F.map_entries(column))
    text = F.array_join(F.transform(pairs, lambda p: F.concat(p["key"], F.lit("="), p["value"].cast("string"))), ",")
    return F.coalesce(text, F.lit(""))


@query(
    "obs_row_counts",
    """
select run_id, 'categories' as entity, cast(sum(o_rows) as bigint) as rows from run_outputs group by run_id
union all select run_id, 'item_details', cast(sum(f_rows) as bigint) from run_outputs group by run_id
""",
)
def obs_row_counts(lake: Lake) -> DataFrame:
    return observability.row_counts(lake.manifests)


@query(
    "obs_summary",
    """
select runs.run_id, status, started_at, finished_at, duration_seconds, task_count, all_statuses as task_statuses, total_rows_processed,
    coalesce(counts, '') as row_counts
from runs left join (select run_id, 'categories=' || cast(sum(o_rows) as bigint) || ',item_details=' || cast(sum(f_rows) as bigint) as counts
    from run_outputs group by run_id) c on runs.run_id = c.run_id
""",
)
def obs_summary(lake: Lake) -> DataFrame:
    rows = observability.summary(lake.manifests)
    return rows.withColumns({c: _map_text(c) for c in ("task_statuses", "row_counts")})


@query(
    "obs_runs_page",
    """
select run_id, status, query, started_at, finished_at, duration_seconds, task_count, reported_statuses as task_statuses,
    (select count(*) from runs) as total
from runs order by started_at desc, run_id limit 30 offset 15
""",
)
def obs_runs_page(lake: Lake) -> DataFrame:
    return observability.runs_page(lake.manifests, 30, 15).withColumn("task_statuses", _map_text("task_statuses"))


@query(
    "obs_run_lookup",
    """
select 'by_id' as lookup, run_id, status, started_at from runs where run_id = 'run-7'
union all select * from (select 'latest', run_id, status, started_at from runs order by started_at desc, run_id limit 1) l
""",
)
def obs_run_lookup(lake: Lake) -> DataFrame:
    found = observability.run_by_id(lake.manifests, "run-7").select(F.lit("by_id").alias("lookup"), "run_id", "status", "started_at")
    latest = observability.latest_run(lake.manifests).select(F.lit("latest").alias("lookup"), "run_id", "status", "started_at")
    return found.unionByName(latest)


view("latest_lines", "select * from (select *, row_number() over (partition by item_id order by landed desc) as nth from landed_lines) x where nth = 1")
view("latest_categories", "select * from (select *, row_number() over (partition by category_id order by landed desc) as nth from landed_categories) x where nth = 1")
view(
    "found_domains",
    """
select n_name, p_brand, p_type, p_name, l_returnflag, max(l_shipdate) as landed
from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
group by n_name, p_brand, p_type, p_name, l_returnflag
""",
)
view("latest_domains", "select n_name, p_brand, p_type, p_name, max(landed) as landed from found_domains group by n_name, p_brand, p_type, p_name")

_CATEGORY_ROWS = "select '{0}' as entity, count(*) as rows from latest_categories"
_ITEM_ROWS = "select '{0}' as entity, count(*) as rows from latest_lines"
_GROUP_ROWS = "select '{0}' as entity, count(*) as rows from (select distinct l_suppkey, p_brand, p_type, l_returnflag from latest_lines) g"


@query(
    "run_pipeline",
    "select 'registered-run' as run_id, entity, cast(sum(rows) as bigint) as rows from ("
    + " union all ".join(
        [_CATEGORY_ROWS.format(t) for t in ("categories", "category_metrics", "dim_category", "fact_category_snapshot", "mart_category_metrics", "ml_category_scores", "ml_category_clusters")]
        + [_ITEM_ROWS.format(t) for t in ("item_details", "dim_item", "fact_seller_item_snapshot", "mart_seller_items")]
        + [_GROUP_ROWS.format(t) for t in ("seller_item_metrics", "mart_seller_item_metrics")]
        + [f"select '{t}', 1" for t in ("marketplace_overview", "fact_marketplace_overview", "mart_marketplace_overview")]
        + [
            "select 'categories', count(*) from landed_categories",
            "select 'domain_discovery', count(*) from found_domains",
            "select 'domain_discovery', count(*) from latest_domains",
            "select 'item_details', count(*) from lineitem",
            "select 'item_price_snapshots', 2 * count(*) from lineitem",
            "select 'item_price_snapshots', count(distinct (l_partkey, landed)) from landed_lines",
            "select 'price_history', count(distinct (l_partkey, landed)) from landed_lines",
            "select 'item_descriptions', 3 * count(*) + 2 * count(*) filter (where lang = 'de') from documents",
            "select 'public_query_metrics', count(distinct p_name) from latest_domains",
            "select 'dim_domain', count(distinct (n_name, p_brand, p_type)) from latest_domains",
            "select 'dim_seller', count(distinct l_suppkey) from latest_lines",
            """select 'dim_date', count(distinct day) from (select date_trunc('day', landed) as day from latest_categories
                union all select date_trunc('day', landed) from latest_domains union all select date_trunc('day', landed) from latest_lines) d""",
            "select 'ml_category_forecast', 0 from latest_categories having count(distinct date_trunc('day', landed)) >= 14",
        ]
    )
    + ") counts group by entity",
)
def pipeline(lake: Lake) -> DataFrame:
    """All nine stages over landed Bronze; returns the run's row counts per entity.

    A category, domain or listing has one latest row, so the forecast, if there are dates enough to
    run it, has none: the check counts on that.
    """
    for entity in PUBLIC_ENTITIES + SELLER_ENTITIES:
        lake.bronze(entity)  # written where the pipeline reads it
    manifest = run_pipeline(lake.spark, lake.bronze_root, scratch_path(lake.spark, "lake"), run_id="registered-run")
    return observability.row_counts(manifest)
