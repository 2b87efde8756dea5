"""Canned answers: one row ``(intent, answer, total)`` per intent, each from a full-table query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens import fixed_values as fixed
from bazaarlens.functions.numbers import np_round, python_float
from bazaarlens.functions.text import sentence
from bazaarlens.operators.ranking import top_k
from bazaarlens.operators.relational import union_by_name
from bazaarlens.operators.stats import whole_table
from bazaarlens.plans.gold import order_columns
from bazaarlens.plans.intents import classify
from bazaarlens.plans.scoring import readiness

TOP = 5


def _answer(one_row: DataFrame, intent: str, empty: Column, text_if_empty: str, text: Column, total: Column) -> DataFrame:
    return one_row.select(
        F.lit(intent).alias("intent"),
        F.when(empty, F.lit(text_if_empty)).otherwise(text).alias("answer"),
        total.cast("bigint").alias("total"),
    )


# --- category questions ----------------------------------------------------------------------


def top_opportunities_rows(scores: DataFrame) -> DataFrame:
    order = [F.col("opportunity_rank"), F.col("category_id"), F.col("snapshot_date_key")]
    return top_k(scores, TOP, *order).withColumn("total", scores.select(F.count(F.lit(1))).scalar())


def top_opportunities(scores: DataFrame) -> DataFrame:
    order = [F.col("opportunity_rank"), F.col("category_id"), F.col("snapshot_date_key")]
    best = top_k(scores, 1, *order).select(F.struct("category_name", "opportunity_score")).scalar()
    n = F.col("n")
    text = sentence(
        fixed.ANSWER_OPPORTUNITIES,
        best.getField("category_name"), python_float(best.getField("opportunity_score")), n,
    )
    rows = scores.agg(F.count(F.lit(1)).alias("n"))
    return _answer(rows, "top_opportunities", n == 0, fixed.ANSWER_OPPORTUNITIES_EMPTY, text, n)


def anomaly_count(scores: DataFrame) -> DataFrame:
    n = F.col("n")
    rows = scores.agg(F.count_if("is_anomaly").alias("n"))
    return _answer(rows, "anomalies", n == 0, fixed.ANSWER_ANOMALIES_EMPTY, sentence(fixed.ANSWER_ANOMALIES, n), n)


def readiness_answers(scores: DataFrame) -> DataFrame:
    """The variation and the model-status answer, both from the readiness rows."""
    state = readiness(scores)
    picked = state.agg(
        *(
            F.max(F.when(F.col("name") == name, F.col(column).cast("string"))).alias(f"{name}_{column}")
            for name in ("clustering", "forecasting")
            for column in ("ready", "reason")
        )
    )
    flags = {name: F.initcap(f"{name}_ready") for name in ("clustering", "forecasting")}
    status = sentence(
        fixed.ANSWER_ML_STATUS,
        flags["clustering"], F.col("clustering_reason"), flags["forecasting"], F.col("forecasting_reason"),
    )
    never, none = F.lit(False), F.lit(None)
    variation = sentence(fixed.ANSWER_VARIATION, F.col("forecasting_reason"))
    return union_by_name(
        [
            _answer(picked, "category_variation", never, "", variation, none),
            _answer(picked, "advanced_ml_status", never, "", status, none),
        ]
    )


def overview_answer(mart: DataFrame) -> DataFrame:
    latest = top_k(mart, 1, F.col("snapshot_date_key").desc_nulls_last())
    fields = ["total_categories", "total_domains", "total_items_in_categories"]
    row = latest.select(F.struct(*fields)).scalar()
    counted = mart.agg(F.count(F.lit(1)).alias("n"))
    text = sentence(fixed.ANSWER_OVERVIEW, *(F.coalesce(row.getField(f), F.lit(0)) for f in fields))
    return _answer(counted, "marketplace_overview", F.lit(False), "", text, F.col("n"))


# --- seller questions ------------------------------------------------------------------------


def _leader(metrics: DataFrame, metric: str) -> Column:
    """The row with the largest metric; of equals, the first in report order."""
    best = top_k(metrics, 1, F.col(metric).desc_nulls_last(), *order_columns("seller_item_metrics"))
    return best.select(F.struct("category_id", "status", F.col(metric).alias("value"))).scalar()


def seller_summary(metrics: DataFrame) -> DataFrame:
    rows = metrics.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("item_count").alias("items"),
        F.sum("active_item_count").alias("active"),
        F.count_distinct(F.nullif("category_id", F.lit(""))).alias("categories"),
        F.sum(F.coalesce("zero_sales_stock_count", F.lit(0))).alias("unsold"),
    )
    n = F.col("n")
    text = sentence(
        fixed.ANSWER_SELLER_SUMMARY, F.col("items"), F.col("active"), F.col("categories"), F.col("unsold")
    )
    return _answer(rows, "seller_summary", n == 0, fixed.ANSWER_SELLER_SUMMARY_EMPTY, text, n)


def seller_top_category(metrics: DataFrame) -> DataFrame:
    lead, n = _leader(metrics, "item_count"), F.col("n")
    text = sentence(
        fixed.ANSWER_SELLER_TOP_CATEGORY,
        lead.getField("category_id"), lead.getField("value"), lead.getField("status"),
    )
    rows = metrics.agg(F.count(F.lit(1)).alias("n"))
    return _answer(rows, "seller_top_categories", n == 0, fixed.ANSWER_SELLER_TOP_CATEGORY_EMPTY, text, n)


def seller_stock(metrics: DataFrame) -> DataFrame:
    lead, n = _leader(metrics, "total_available_quantity"), F.col("n")
    rows = metrics.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_available_quantity").alias("stock"),
        F.sum(F.coalesce("zero_sales_stock_count", F.lit(0))).alias("unsold"),
    )
    text = sentence(
        fixed.ANSWER_SELLER_STOCK,
        F.col("stock"), lead.getField("category_id"), lead.getField("value"), F.col("unsold"),
    )
    return _answer(rows, "seller_stock", n == 0, fixed.ANSWER_SELLER_STOCK_EMPTY, text, n)


def seller_sales(metrics: DataFrame) -> DataFrame:
    lead, n = _leader(metrics, "total_sold_quantity"), F.col("n")
    # rates carry two decimals: summed as whole hundredths the mean does not depend on task order
    hundredths = F.rint(F.coalesce("sell_through_rate", F.lit(0.0)) * 100).cast("bigint")
    rows = metrics.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_sold_quantity").alias("sold"),
        F.sum(hundredths).cast("double").alias("rate_sum"),
    )
    mean_rate = np_round(F.try_divide(F.col("rate_sum"), n * F.lit(100.0)), 2)
    text = sentence(
        fixed.ANSWER_SELLER_SALES,
        F.col("sold"), lead.getField("category_id"), lead.getField("value"), python_float(mean_rate),
    )
    return _answer(rows, "seller_sales", n == 0, fixed.ANSWER_SELLER_SALES_EMPTY, text, n)


# --- item lists ------------------------------------------------------------------------------

def _item_order() -> list[Column]:
    return [F.col("snapshot_date_key").desc_nulls_last(), F.col("item_id").asc_nulls_last()]


def items_by_status(items: DataFrame, status: str) -> DataFrame:
    """The first five items of a status."""
    return top_k(items.filter(F.col("status") == status), TOP, *_item_order())


def zero_sales_items(items: DataFrame) -> DataFrame:
    """The first five items with stock but no recorded sale."""
    unsold = F.coalesce("sold_quantity", F.lit(0)) == 0
    stocked = F.coalesce("available_quantity", F.lit(0)) > 0
    return top_k(items.filter(unsold & stocked), TOP, *_item_order())


def top_items(items: DataFrame, metric: str) -> DataFrame:
    """The five items with the largest metric; a missing value counts as 0."""
    value = F.coalesce(F.col(metric).cast("double"), F.lit(0.0))
    return top_k(items, TOP, value.desc(), *_item_order())


def _item_list(rows: DataFrame, first: list[Column]) -> DataFrame:
    """One row: how many items (five at most) and their sentences in order."""
    line = sentence(
        fixed.ANSWER_ITEM,
        F.coalesce(F.nullif("title", F.lit("")), "item_id"), python_float(F.col("price")),
        F.col("available_quantity"), F.col("sold_quantity"), F.col("status"),
    )
    keys = [k.alias(f"k{i}") for i, k in enumerate(first)]
    listed = F.array_sort(F.collect_list(F.struct(*keys, line.alias("line"))))
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(listed, lambda x: x["line"]), " ").alias("lines"),
    )


def _rank_keys() -> list[Column]:
    return [-F.col("snapshot_date_key"), F.col("item_id")]


def _list_answer(intent: str, listed: DataFrame, prefix: Column, empty: str, total: Column) -> DataFrame:
    text = F.concat_ws(" ", prefix, F.col("lines"))
    return _answer(listed, intent, F.col("n") == 0, empty, text, total)


def items_by_status_answer(items: DataFrame, intent: str, status: str) -> DataFrame:
    total = whole_table(items, n=F.count_if(F.col("status") == status)).getField("n")
    prefix = sentence(fixed.ANSWER_ITEMS_BY_STATUS, total, F.lit(status))
    empty = fixed.ANSWER_ITEMS_BY_STATUS_EMPTY % status
    return _list_answer(intent, _item_list(items_by_status(items, status), _rank_keys()), prefix, empty, total)


def zero_sales_answer(items: DataFrame) -> DataFrame:
    prefix = sentence(fixed.ANSWER_ZERO_SALES, F.col("n"))
    listed = _item_list(zero_sales_items(items), _rank_keys())
    return _list_answer("seller_zero_sales_items", listed, prefix, fixed.ANSWER_ZERO_SALES_EMPTY, F.col("n"))


def top_items_answer(items: DataFrame, intent: str, metric: str) -> DataFrame:
    value = F.coalesce(F.col(metric).cast("double"), F.lit(0.0))
    listed = _item_list(top_items(items, metric), [-value, *_rank_keys()])
    prefix = sentence(fixed.ANSWER_TOP_ITEMS, F.col("n"), F.lit(metric))
    total = items.select(F.count(F.lit(1))).scalar()
    return _list_answer(intent, listed, prefix, fixed.ANSWER_TOP_ITEMS_EMPTY, total)


# --- all together ----------------------------------------------------------------------------


def all_answers(scores: DataFrame, overview: DataFrame, seller_metrics: DataFrame, items: DataFrame) -> DataFrame:
    """One row per intent. The size is fixed by the list of intents."""
    spark = scores.sparkSession
    unknown = spark.range(1).select(
        F.lit(fixed.UNKNOWN_INTENT[0]).alias("intent"),
        F.lit(fixed.ANSWER_UNKNOWN).alias("answer"),
        F.lit(None).cast("bigint").alias("total"),
    )
    return union_by_name(
        [
            top_opportunities(scores),
            anomaly_count(scores),
            readiness_answers(scores),
            overview_answer(overview),
            seller_summary(seller_metrics),
            seller_top_category(seller_metrics),
            seller_stock(seller_metrics),
            seller_sales(seller_metrics),
            items_by_status_answer(items, "seller_paused_items", "paused"),
            items_by_status_answer(items, "seller_active_items", "active"),
            zero_sales_answer(items),
            top_items_answer(items, "seller_top_stock_items", "available_quantity"),
            top_items_answer(items, "seller_expensive_items", "price"),
            unknown,
        ]
    )


def answer_batch(questions: DataFrame, text: str, answers: DataFrame) -> DataFrame:
    """Classify every question and attach the answer of its intent.

    Questions crowd on few intents; the answer table has one row per intent (15 at most), so it is
    broadcast and the questions are not shuffled.
    """
    return classify(questions, text).join(F.broadcast(answers), "intent", "left")
