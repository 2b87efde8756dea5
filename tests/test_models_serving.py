import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens import fixed_values as fixed
from bazaarlens.operators.relational import relabel
from bazaarlens.plans import answers, dashboard, intents, isolation, observability, scoring, serving
from bazaarlens.plans.clusters import fit_clusters
from bazaarlens.plans.pipeline import run_pipeline
from bazaarlens.sources.bronze import envelope, write_bronze
from tests.conftest import rows

FEATURES = "category_id string, category_name string, snapshot_date_key bigint, snapshot_date string, total_items_log double, domain_count bigint, category_depth bigint, catalog_coverage_score double, items_share double, competition_density double"


def features(spark, n=40, outlier=True):
    rng = np.random.default_rng(3)
    data = []
    for i in range(n):
        far = outlier and i == 0
        data.append((f"C{i:03d}", f"Cat {i}", 20260910, "2026-09-10", 12.0 if far else 4 + float(rng.random()), 90 if far else 5 + i % 3, 9 if far else 2,
                     100.0 if far else 10.0 + i % 5, 0.5 if far else 0.01, 0.9 if far else 0.05 + 0.001 * i))
    return spark.createDataFrame(data, FEATURES)


def test_category_features(spark):
    df = spark.createDataFrame([("A", "a", 20260910, "2026-09-10", 100, 1, 2, 100.0)], "category_id string, category_name string, snapshot_date_key bigint, snapshot_date string, total_items_in_this_category bigint, domain_count bigint, category_depth bigint, catalog_coverage_score double")
    r = rows(scoring.build_category_features(df))[0]
    assert (r["items_share"], r["competition_density"]) == (1.0, 0.01) and r["total_items_log"] == pytest.approx(np.log1p(100))


def test_single_row_is_not_anomalous(spark):
    r = rows(scoring.detect_anomalies(features(spark, 1)))[0]
    assert (r["anomaly_score"], r["is_anomaly"], r["anomaly_type"], r["isolation_score"]) == (0.0, False, "none", 0.0)
    meta = rows(scoring.model_metadata(scoring.detect_anomalies(features(spark, 1))))[0]
    assert not meta["isolation_forest_used"] and "at least 30 rows" in meta["limitation"]


def test_planted_outlier_is_flagged_high(spark):
    got = {r["category_id"]: r for r in rows(scoring.detect_anomalies(features(spark)))}
    assert got["C000"]["is_anomaly"] and got["C000"]["anomaly_type"] == "high_catalog_coverage"
    assert sum(r["is_anomaly"] for r in got.values()) == 1


def test_isolation_forest_properties(spark):
    df = features(spark, 60)
    first = {r["category_id"]: r["isolation_score"] for r in rows(isolation.isolation_scores(df))}
    assert all(0 < s <= 1 for s in first.values())
    assert max(first, key=first.get) == "C000"
    again = {r["category_id"]: r["isolation_score"] for r in rows(isolation.isolation_scores(df.repartition(7)))}
    assert again == first
    flagged = scoring.detect_anomalies(isolation.isolation_scores(df))
    assert all(r["anomaly_score"] >= round(r["isolation_score"], 4) - 1e-9 for r in rows(flagged))


def test_isolation_sample_is_bounded(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"), F.array(F.rand(1), F.rand(2)).alias("x"))
    forest = rows(isolation.grow_forest(df, ["k"], trees=5, sample=32))
    assert [t["rows"] for t in forest] == [32] * 5
    assert all(len(t["feature"]) <= 63 for t in forest)


def test_average_path():
    assert isolation.average_path(1) == 0 and isolation.average_path(2) == 1
    assert isolation.average_path(256) == pytest.approx(10.24477, abs=1e-4)


OPPORTUNITY = "category_id string, catalog_coverage_score double, competition_density double, category_depth bigint, is_anomaly boolean"


def test_opportunity_score(spark):
    df = spark.createDataFrame([("A", 100.0, 0.01, 2, False), ("B", 50.0, 0.10, 1, True)], OPPORTUNITY)
    got = {r["category_id"]: (r["opportunity_score"], r["opportunity_rank"]) for r in rows(scoring.calculate_opportunity_score(df))}
    assert got == {"A": (100.0, 1), "B": (17.5, 2)}
    with pytest.raises(ValueError):
        scoring.calculate_opportunity_score(df, {k: 0.0 for k in fixed.OPPORTUNITY_WEIGHTS})
    alone = rows(scoring.calculate_opportunity_score(df.filter("category_id = 'A'")))[0]
    assert alone["opportunity_score"] == 35 + 15 + 7.5 + 20


def test_forecast_and_readiness(spark):
    df = spark.createDataFrame([("A", 20260910, 10.0), ("A", 20260911, 20.0)], "category_id string, snapshot_date_key bigint, opportunity_score double")
    got = rows(scoring.build_naive_forecast(df))
    assert [(r["forecast_value"], r["model_name"]) for r in got] == [(10.0, "naive_previous_snapshot")]
    state = {r["name"]: r for r in rows(scoring.readiness(df))}
    assert not state["clustering"]["ready"] and "Requires at least 5" in state["clustering"]["reason"]
    assert not state["forecasting"]["ready"] and "temporal snapshots; current dataset has 2" in state["forecasting"]["reason"]
    undated = {r["name"]: r for r in rows(scoring.readiness(df.drop("snapshot_date_key")))}
    assert undated["forecasting"]["reason"] == fixed.FORECASTING_NO_COLUMN


def test_clusters_separate_two_groups(spark):
    rng = np.random.default_rng(1)
    data = [(f"C{i}", "c", 20260910, "d", *(float(10 * (i % 2) + rng.normal(0, 0.1)) for _ in range(1)), 10 * (i % 2), 5 * (i % 2), 50.0 * (i % 2), 0.1 * (i % 2), 0.2) for i in range(24)]
    assigned, candidates = fit_clusters(spark.createDataFrame(data, FEATURES))
    got = rows(assigned)
    groups = {}
    for r in got:
        groups.setdefault(int(r["category_id"][1:]) % 2, set()).add(r["cluster_id"])
    assert all(len(g) == 1 for g in groups.values()) and groups[0] != groups[1]
    assert {r["k"] for r in rows(candidates)} == {2, 3, 4, 5, 6}
    assert all(r["cluster_label"] == f"cluster_{r['cluster_id']}" and r["cluster_distance"] < 1 for r in got)


QUESTIONS = {
    "Quais as melhores oportunidades?": "top_opportunities",
    "Ola": "unknown",
    "Qual o estoque do seller?": "seller_stock",
    "Quanto o vendedor vendeu?": "seller_sales",
    "Liste anuncios pausados": "seller_paused_items",
    "Quais produtos mais caros?": "seller_expensive_items",
    "Lista de anuncios ativos": "seller_active_items",
    "Quais anuncios sem venda?": "seller_zero_sales_items",
    "Variação de preço": "category_variation",
    "RESUMO": "marketplace_overview",
    "cluster": "advanced_ml_status",
    "seller": "seller_summary",
}


def test_intents(spark):
    df = spark.createDataFrame([(q,) for q in QUESTIONS], "q string")
    assert {r["q"]: r["intent"] for r in rows(intents.classify(df, "q"))} == QUESTIONS


SELLER = "seller_id string, category_id string, status string, item_count bigint, active_item_count bigint, total_available_quantity bigint, total_sold_quantity bigint, sell_through_rate double, zero_sales_stock_count bigint"


def test_seller_answers(spark):
    df = spark.createDataFrame([("1", "A", "active", 2, 2, 5, 9, 50.0, 0), ("1", "B", "paused", 1, 0, 7, 1, 12.5, 1)], SELLER)
    assert "3 anuncios monitorados, 2 ativos" in rows(answers.seller_summary(df))[0]["answer"]
    assert "A com 2 anuncios no status active" in rows(answers.seller_top_category(df))[0]["answer"]
    assert "esta em B com 7 unidades" in rows(answers.seller_stock(df))[0]["answer"]
    assert rows(answers.seller_sales(df))[0]["answer"].endswith("agrupamentos e 31.25%.")
    empty = rows(answers.seller_sales(df.filter("false")))[0]
    assert empty["total"] == 0 and empty["answer"] == fixed.ANSWER_SELLER_SALES_EMPTY


ITEMS = "item_id string, title string, status string, price double, available_quantity bigint, sold_quantity bigint, snapshot_date_key bigint"


def test_item_answers(spark):
    df = spark.createDataFrame([("1", "Notebook", "paused", 10.0, 3, 0, 20260910), ("2", "", "active", 100.0, None, 4, 20260910)], ITEMS)
    paused = rows(answers.items_by_status_answer(df, "seller_paused_items", "paused"))[0]
    assert paused["answer"] == "Encontrei 1 anuncios com status paused. Notebook: preco 10.0, estoque 3, vendidos 0, status paused."
    dear = rows(answers.top_items_answer(df, "seller_expensive_items", "price"))[0]["answer"]
    assert dear.index("2: preco 100.0, estoque None") < dear.index("Notebook")
    assert rows(answers.zero_sales_answer(df))[0]["total"] == 1
    none = rows(answers.items_by_status_answer(df, "x", "closed"))[0]
    assert none["total"] == 0 and none["answer"].startswith("Nao encontrei anuncios com status closed")


def test_served_items_page_filters(spark):
    df = spark.createDataFrame([("1", "7", "C", "active", 20260910), ("2", "7", "C", "paused", 20260911)], "item_id string, seller_id string, category_id string, status string, snapshot_date_key bigint")
    got = rows(serving.seller_items_page(df, status="active"))
    assert [(r["item_id"], r["total"]) for r in got] == [("1", 1)]
    assert [r["item_id"] for r in rows(serving.seller_items_page(df))] == ["2", "1"]


def test_histogram_puts_100_in_the_last_bin(spark):
    df = spark.createDataFrame([(100.0, False), (0.0, False), (12.5, True)], "opportunity_score double, is_anomaly boolean")
    assert {(r["bin"], r["bin_start"], r["categories"]) for r in rows(dashboard.score_histogram(df))} == {(8, 87.5, 1), (1, 0.0, 1), (2, 12.5, 1)}


def test_relabel_keeps_unknown_values(spark):
    df = spark.createDataFrame([("high_coverage",), ("other",), (None,)], "b string")
    assert [r["l"] for r in rows(df.select(relabel(F.col("b"), fixed.COVERAGE_LABELS).alias("l")))] == ["Alta cobertura", "other", None]


MANIFEST = "run_id string, status string, query string, started_at timestamp, finished_at timestamp, duration_seconds double, tasks string"


def test_observability(spark):
    tasks = {
        "extract": [{"entity": "categories", "rows": 2}, {"entity": "domain_discovery", "rows": 3}, "x", {"rows": 9}, {"entity": "categories", "rows": "8"}],
        "items": {"status": "skipped", "outputs": [{"entity": "item_details", "rows": 4}]},
        "odd": {"status": 5},
    }
    from datetime import datetime

    df = spark.createDataFrame([("run-1", "success", None, datetime(2026, 9, 10), None, 1.5, json.dumps(tasks)), ("run-0", "failed", None, datetime(2026, 9, 9), None, 1.0, "{}")], MANIFEST)
    got = {r["run_id"]: r for r in rows(observability.summary(df))}
    r = got["run-1"]
    assert r["row_counts"] == {"categories": 2, "domain_discovery": 3, "item_details": 4}
    assert (r["total_rows_processed"], r["task_count"]) == (9, 3)
    assert r["task_statuses"] == {"extract": "success", "items": "skipped", "odd": "success"}
    assert got["run-0"]["total_rows_processed"] == 0 and got["run-0"]["task_count"] == 0
    page = rows(observability.runs_page(df))
    assert [p["run_id"] for p in page] == ["run-1", "run-0"] and page[0]["task_statuses"] == {"items": "skipped", "odd": "success"}
    assert observability.run_by_id(df, "none").count() == 0
    assert rows(observability.latest_run(df))[0]["run_id"] == "run-1"


def test_pipeline_end_to_end_and_failure_manifest(spark, folder):
    at = F.lit("2026-09-10T10:00:00+00:00")

    def land(entity, payloads, endpoint="/x"):
        df = spark.createDataFrame([(json.dumps(p),) for p in payloads], "payload string")
        write_bronze(envelope(df, "payload", "api", endpoint, at), f"{folder}/bronze", entity)

    land("categories", [{"id": f"C{i}", "name": f"Cat {i}", "total_items_in_this_category": 10 * i + 1, "path_from_root": [{"name": "R"}]} for i in range(6)])
    land("domain_discovery", [{"domain_id": "D1", "domain_name": "d", "category_id": "C1", "category_name": "c"}], "/search?q=note book")
    land("item_details", [{"id": "I1", "price": 10, "seller_id": 5, "category_id": "C1", "status": "active", "available_quantity": 1, "sold_quantity": 0}])
    manifest = run_pipeline(spark, f"{folder}/bronze", f"{folder}/out", "run-1")
    r = rows(manifest)[0]
    assert r["status"] == "success" and len(json.loads(r["tasks"])) == 9
    scores = rows(spark.read.parquet(f"{folder}/out/ml/category_scores"))
    assert len(scores) == 6 and {s["isolation_score"] for s in scores} == {0.0}
    assert spark.read.parquet(f"{folder}/out/ml/category_clusters").count() == 6
    assert spark.read.parquet(f"{folder}/out/history/fact_seller_item_snapshot").count() == 1
    land("categories", [{"id": None, "name": "no id"}])
    with pytest.raises(ValueError, match="Data quality checks failed"):
        run_pipeline(spark, f"{folder}/bronze", f"{folder}/out2", "run-2")
    failed = rows(spark.read.parquet(f"{folder}/out2/pipeline_runs"))[0]
    assert failed["status"] == "failed" and "silver_categories" in failed["error"]
