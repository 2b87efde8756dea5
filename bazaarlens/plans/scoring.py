"""Category features, anomaly flags, opportunity score, forecast, readiness and metadata."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens import fixed_values as fixed
from bazaarlens.functions.numbers import np_round
from bazaarlens.functions.text import sentence
from bazaarlens.operators.previous import with_previous
from bazaarlens.operators.ranking import dense_rank_desc
from bazaarlens.operators.stats import min_max_score, quartiles, share_of_total, z_score
from bazaarlens.sources.history import last_before


def build_category_features(metrics: DataFrame) -> DataFrame:
    """Six features per category snapshot; market totals span every row given."""
    items = F.coalesce("total_items_in_this_category", F.lit(0))
    return metrics.select(
        "category_id",
        "category_name",
        "snapshot_date_key",
        "snapshot_date",
        F.log1p(items).alias("total_items_log"),
        "domain_count",
        "category_depth",
        "catalog_coverage_score",
        share_of_total(metrics, items).alias("items_share"),
        (F.col("domain_count").cast("double") / F.greatest(items.cast("double"), F.lit(1.0))).alias(
            "competition_density"
        ),
    )


def iqr_bounds(df: DataFrame, value: Column) -> tuple[Column, Column]:
    q = quartiles(df, value)
    low, high = q.getItem(0), q.getItem(1)
    reach = fixed.IQR_FACTOR * (high - low)
    return low - reach, high + reach


def detect_anomalies(features: DataFrame) -> DataFrame:
    """Z-score and interquartile flags on coverage, combined with the isolation score if there is one.

    :func:`bazaarlens.plans.isolation.isolation_scores` adds the column ``isolation_score``.
    """
    scored = "isolation_score" in features.columns
    names = [c for c in features.columns if c != "isolation_score"]
    coverage = F.coalesce("catalog_coverage_score", F.lit(0.0))
    lower, upper = iqr_bounds(features, coverage)
    flagged = features.select(
        "*",
        F.abs(z_score(features, coverage)).alias("zscore_abs"),
        ((coverage < lower) | (coverage > upper)).alias("iqr_anomaly"),
        (coverage >= upper).alias("_high"),
    )
    isolation = F.coalesce("isolation_score", F.lit(0.0)) if scored else F.lit(0.0)
    flagged = flagged.withColumn("isolation_score", isolation)
    anomalous = (F.col("zscore_abs") >= fixed.Z_SCORE_LIMIT) | F.col("iqr_anomaly")
    side = F.when(F.col("_high"), "high_catalog_coverage").otherwise("low_catalog_coverage")
    combined = F.greatest(F.col("zscore_abs") * fixed.Z_SCORE_SCALE, F.col("isolation_score"))
    return flagged.select(
        *names,
        "zscore_abs",
        "iqr_anomaly",
        "isolation_score",
        np_round(combined, 4).alias("anomaly_score"),
        anomalous.alias("is_anomaly"),
        F.when(anomalous, side).otherwise("none").alias("anomaly_type"),
    )


def normalised_weights(weights: Mapping[str, float] | None = None) -> dict[str, float]:
    weights = dict(weights or fixed.OPPORTUNITY_WEIGHTS)
    total = sum(weights[name] for name in fixed.OPPORTUNITY_WEIGHTS)
    if total <= 0:
        raise ValueError("opportunity weights must sum to a positive value")
    return {name: weights[name] / total for name in fixed.OPPORTUNITY_WEIGHTS}


def calculate_opportunity_score(scored: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Weighted 0-100 score and its dense rank.

    High coverage, few competitors, deep paths and the absence of an anomaly score well.
    """
    w = normalised_weights(weights)
    coverage = F.coalesce("catalog_coverage_score", F.lit(0.0))
    calm = F.when(F.col("is_anomaly"), F.lit(0.0)).otherwise(F.lit(100.0))
    score = (
        coverage * w["catalog_coverage"]
        + (F.lit(100.0) - min_max_score(scored, F.col("competition_density"))) * w["low_competition_density"]
        + min_max_score(scored, F.col("category_depth")) * w["category_depth"]
        + calm * w["stability"]
    )
    with_score = scored.withColumn("opportunity_score", np_round(score, 2))
    return dense_rank_desc(with_score, "opportunity_score", "opportunity_rank")


def build_naive_forecast(snapshots: DataFrame, target: str = "opportunity_score") -> DataFrame:
    """The previous snapshot's value as forecast; a category's first snapshot has none."""
    rows = with_previous(
        snapshots, "category_id", "snapshot_date_key", {"forecast_value": target},
        position=F.col("snapshot_date_key"),
    )
    return rows.dropna(subset=["forecast_value"]).withColumn("model_name", F.lit(fixed.FORECAST_MODEL))


def forecast_from(history: DataFrame, since: int, target: str = "opportunity_score") -> DataFrame:
    """The naive forecast of all snapshots from the date ``since`` on, from a dated history.

    Read are the dates from ``since`` on and, for each category in them, its last one before. A date that
    is loaded again changes the forecast of the next one too, so give the least date that has changed.
    """
    fresh = history.filter(F.col("snapshot_date_key") >= since)
    rows = fresh.unionByName(last_before(history, "category_id", since))
    return build_naive_forecast(rows, target).filter(F.col("snapshot_date_key") >= since)


def readiness(snapshots: DataFrame) -> DataFrame:
    """Two rows ``(name, ready, reason)``: is there enough data to cluster and to forecast?"""
    dated = "snapshot_date_key" in snapshots.columns
    dates = F.count_distinct("snapshot_date_key") if dated else F.lit(0)
    counts = snapshots.agg(F.count(F.lit(1)).alias("n"), dates.cast("bigint").alias("dates"))
    n, d = F.col("n"), F.col("dates")
    can_cluster = n >= fixed.MIN_CLUSTERING_ROWS
    can_forecast = d >= fixed.MIN_FORECAST_SNAPSHOTS
    not_clustering = sentence(fixed.CLUSTERING_NOT_READY, F.lit(fixed.MIN_CLUSTERING_ROWS), n)
    not_forecasting = sentence(fixed.FORECASTING_NOT_READY, F.lit(fixed.MIN_FORECAST_SNAPSHOTS), d)
    no_column = (n == 0) | F.lit(not dated)
    clustering = F.struct(
        F.lit("clustering").alias("name"),
        can_cluster.alias("ready"),
        F.when(can_cluster, fixed.CLUSTERING_READY).otherwise(not_clustering).alias("reason"),
    )
    forecasting = F.struct(
        F.lit("forecasting").alias("name"),
        (can_forecast & ~no_column).alias("ready"),
        F.when(no_column, fixed.FORECASTING_NO_COLUMN)
        .when(can_forecast, fixed.FORECASTING_READY)
        .otherwise(not_forecasting)
        .alias("reason"),
    )
    return counts.select(F.inline(F.array(clustering, forecasting)))


def model_metadata(scores: DataFrame) -> DataFrame:
    """One row that describes the scoring run; the caller adds the training time."""
    enough = F.col("output_rows") >= fixed.MIN_ISOLATION_FOREST_ROWS
    base = ["z_score", "iqr"]
    methods = F.when(
        enough, F.array(*map(F.lit, [*base, "isolation_forest"]))
    ).otherwise(F.array(*map(F.lit, base)))
    limitation = sentence(
        fixed.ISOLATION_LIMITATION, F.lit(fixed.MIN_ISOLATION_FOREST_ROWS), F.col("output_rows")
    )
    counts = scores.agg(
        F.count(F.lit(1)).alias("output_rows"), F.count_if("is_anomaly").alias("anomaly_count")
    )
    return counts.select(
        F.lit(fixed.MODEL_VERSION).alias("model_version"),
        F.array(*map(F.lit, fixed.FEATURE_COLUMNS)).alias("features"),
        "output_rows",
        "anomaly_count",
        methods.alias("methods"),
        enough.alias("isolation_forest_used"),
        F.when(~enough, limitation).alias("limitation"),
        F.lit(fixed.RANDOM_STATE).alias("random_state"),
    )


def advanced_metadata(state: DataFrame, candidates: DataFrame | None, outputs: Mapping[str, int]) -> DataFrame:
    """One document row: readiness by name, rows of each output, and the clustering that was chosen.

    ``clustering`` is null when no clusters were made: the chosen k, its silhouette, and all candidates.
    """
    spark = state.sparkSession
    readiness_map = F.map_from_entries(F.collect_list(F.struct("name", F.struct("ready", "reason"))))
    described = state.agg(readiness_map.alias("readiness")).select(
        F.lit("advanced_models").alias("phase"), "readiness", F.from_json(F.lit(json.dumps(dict(outputs))), "map<string,bigint>").alias("outputs")
    )
    shape = "struct<chosen_k:int,silhouette_score:double,candidates:array<struct<k:int,silhouette_score:double>>>"
    if candidates is None:
        return described.withColumn("clustering", F.lit(None).cast(shape))
    best = F.struct("silhouette_score", (-F.col("k")).alias("_less"))
    found = candidates.agg(
        F.max_by("k", best).alias("chosen_k"),
        F.max("silhouette_score").alias("silhouette_score"),
        F.sort_array(F.collect_list(F.struct("k", "silhouette_score"))).alias("candidates"),
    )
    row = found.first()
    chosen = spark.createDataFrame([(row["chosen_k"], row["silhouette_score"], row["candidates"])], "chosen_k int, silhouette_score double, candidates array<struct<k:int,silhouette_score:double>>")
    return described.withColumn("clustering", chosen.select(F.struct("chosen_k", "silhouette_score", "candidates")).scalar())


def score_categories(metrics: DataFrame) -> DataFrame:
    """Mart metrics to ranked opportunity scores, without a forest."""
    return calculate_opportunity_score(detect_anomalies(build_category_features(metrics)))
