"""Aggregates behind the dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.fixed_values import COVERAGE_LABELS
from bazaarlens.functions.numbers import np_round
from bazaarlens.functions.text import pt_compact, pt_thousands
from bazaarlens.operators.ranking import top_k
from bazaarlens.operators.relational import relabel
from bazaarlens.operators.stats import whole_table
from bazaarlens.plans.gold import order_columns

HISTOGRAM_BINS = 8


def kpis(overview: DataFrame, scores: DataFrame) -> DataFrame:
    stats = whole_table(scores, n=F.count(F.lit(1)), anomalies=F.count_if("is_anomaly"))
    latest = top_k(overview, 1, F.col("snapshot_date_key").desc_nulls_last())
    return latest.select(
        "total_categories",
        "total_domains",
        pt_thousands(F.col("total_items_in_categories")).alias("mapped_items"),
        stats.getField("n").alias("opportunities"),
        stats.getField("anomalies").alias("anomalies"),
    )


def market_size_by_query(query_metrics: DataFrame, k: int = 8) -> DataFrame:
    """The first k terms in report order, shown by ascending volume."""
    first = top_k(query_metrics, k, *order_columns("public_query_metrics"))
    size = F.col("total_items_in_categories")
    return first.withColumn("size_label", pt_compact(size)).orderBy(size, "search_query")


def top_opportunities(scores: DataFrame, k: int = 8) -> DataFrame:
    rows = top_k(scores, k, F.col("opportunity_rank"), F.col("category_id"))
    return rows.select(
        "opportunity_rank", "category_name", np_round(F.col("opportunity_score"), 2).alias("opportunity_score"),
        "is_anomaly",
    )


def labelled(categories: DataFrame) -> DataFrame:
    return categories.withColumn("coverage_label", relabel(F.col("coverage_band"), COVERAGE_LABELS))


def label_choices(categories: DataFrame) -> DataFrame:
    return labelled(categories).select("coverage_label").dropna().distinct().orderBy("coverage_label")


def with_labels(categories: DataFrame, chosen: Sequence[str] | None = None) -> DataFrame:
    rows = labelled(categories)
    return rows if chosen is None else rows.filter(F.col("coverage_label").isin(*chosen))


def top_categories(categories: DataFrame, chosen: Sequence[str] | None = None, k: int = 12) -> DataFrame:
    """The k chosen categories with most items, shown by ascending size."""
    items = F.col("total_items_in_this_category")
    first = top_k(with_labels(categories, chosen), k, items.desc_nulls_last(), F.col("category_id"))
    return first.select(
        "category_id", "category_name", "total_items_in_this_category", "coverage_label", "domain_count",
        "catalog_coverage_score", pt_compact(items).alias("size_label"),
    ).orderBy(items, "category_id")


def coverage_vs_depth(categories: DataFrame, chosen: Sequence[str] | None = None) -> DataFrame:
    return with_labels(categories, chosen).select(
        "category_id", "category_name", "category_depth", "catalog_coverage_score",
        "total_items_in_this_category", "domain_count", "coverage_label",
    )


def score_kpis(scores: DataFrame) -> DataFrame:
    """Highest and mean score (two decimals, summed as whole hundredths) and the row count."""
    score = F.col("opportunity_score")
    total = F.sum(F.rint(score * 100).cast("bigint")).cast("double")
    return scores.agg(
        np_round(F.max(score), 2).alias("max_score"),
        np_round(F.try_divide(total, F.count(score) * F.lit(100.0)), 2).alias("mean_score"),
        F.count(F.lit(1)).alias("categories"),
    )


def top_scores(scores: DataFrame, k: int = 15) -> DataFrame:
    score = F.col("opportunity_score")
    first = top_k(scores, k, score.desc_nulls_last(), F.col("category_id"))
    return first.select(
        "category_id", "category_name", "opportunity_score", "opportunity_rank", "anomaly_score",
        "anomaly_type", "is_anomaly", np_round(score, 1).alias("score_label"),
    ).orderBy(score, "category_id")


def score_histogram(scores: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts per equal bin of 0..100 and anomaly flag; 100 belongs to the last bin."""
    place = F.least(F.width_bucket("opportunity_score", F.lit(0.0), F.lit(100.0), F.lit(bins)), F.lit(bins))
    return (
        scores.groupBy(place.cast("bigint").alias("bin"), "is_anomaly")
        .agg(F.count(F.lit(1)).alias("categories"))
        .withColumn("bin_start", (F.col("bin") - 1) * F.lit(100.0 / bins))
    )
