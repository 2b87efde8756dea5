"""Landing of response bodies, the dated history, and the pipeline over both."""

import json
import os

import pytest
from pyspark.sql import functions as F

from bazaarlens.plans import scoring
from bazaarlens.plans.pipeline import run_pipeline
from bazaarlens.sources.bronze import scan_bronze, scan_jsonl
from bazaarlens.sources.history import last_before, read_history
from bazaarlens.sources.tables import append_snapshots, publish_together, published_root
from bazaarlens.streaming.landing import RESPONSE, land_batch, land_responses, still_to_fetch
from tests.conftest import rows

AT = "2026-09-10T10:00:00+00:00"
SNAPSHOTS = "category_id string, opportunity_score double, snapshot_date_key bigint"


def drop(folder, kind, name, bodies, at=AT):
    os.makedirs(f"{folder}/inbox/{kind}", exist_ok=True)
    with open(f"{folder}/inbox/{kind}/{name}.json", "w") as f:
        for endpoint, requested, body in bodies:
            f.write(json.dumps({"endpoint": endpoint, "requested": requested, "received_at": at, "body": body if isinstance(body, str) else json.dumps(body)}) + "\n")


def fill(folder):
    drop(folder, "domain_discovery", "1", [("/search?q=note book", None, [{"domain_id": "D1", "domain_name": "d", "category_id": "C1", "category_name": "c"}, 7]), ("/x", None, "broken [")])
    drop(folder, "categories", "1", [("/categories/C1", "C1", {"id": "C1", "name": "one", "total_items_in_this_category": 5, "path_from_root": [{"name": "R"}]}), ("/c", None, [{"id": "C2", "name": "two"}]), ("/c", None, {"categories": [{"id": "C3", "name": "three"}, None]})])
    drop(folder, "seller_user", "1", [("/users/me", None, {"id": 5})])
    drop(folder, "seller_items", "1", [("/users/5/items", "5", {"results": ["I1", "I2", 3, "I9"]})])
    drop(folder, "items", "1", [("/items", None, [{"code": 200, "body": {"id": "I1", "price": 1.5, "category_id": "C1", "seller_id": 5, "status": "active"}}, {"code": 404, "body": {"id": "I3"}}]), ("/items", None, [{"code": 206, "body": {"id": "I2", "price": 2}}, {"code": 200, "body": "gone"}])])
    drop(folder, "descriptions", "1", [("/items/I1/description", "I1", {"plain_text": "text"}), ("/items/I2/description", "I2", {"id": None, "plain_text": None})])


def test_every_kind_lands_once(spark, folder):
    fill(folder)
    root = f"{folder}/bronze"
    first = land_responses(spark, f"{folder}/inbox", root, f"{folder}/progress", ["domain_discovery", "categories", "seller_user", "seller_items", "items", "descriptions"])
    assert first == {"domain_discovery": 1, "categories": 3, "authenticated_user": 1, "seller_items": 3, "item_details": 2, "item_price_snapshots": 2, "item_descriptions": 2}
    ids = {e: sorted(r["record_id"] for r in rows(scan_bronze(spark, root, e))) for e in first}
    assert ids["seller_items"] == ["I1", "I2", "I9"] and ids["categories"] == ["C1", "C2", "C3"] and ids["item_descriptions"] == ["I1", "I2"]
    assert {json.loads(r["payload"])["seller_id"] for r in rows(scan_bronze(spark, root, "seller_items"))} == {"5"}
    price = json.loads(rows(scan_bronze(spark, root, "item_price_snapshots").filter("record_id = 'I1'"))[0]["payload"])
    assert price["item_id"] == "I1" and float(price["price"]) == 1.5 and price["base_price"] is None
    assert scan_jsonl(spark, root, "item_details").count() == 2
    assert [r["body"] for r in rows(spark.read.json(f"{root}/quarantine/domain_discovery"))] == ["broken ["]
    assert {k: sorted(r["id"] for r in rows(df)) for k, df in still_to_fetch(spark, root).items()} == {"categories": [], "items": ["I9"], "descriptions": []}

    drop(folder, "items", "2", [("/items", None, [{"code": 200, "body": {"id": "I1", "price": 9}}])], "2026-09-11T10:00:00+00:00")
    again = land_responses(spark, f"{folder}/inbox", root, f"{folder}/progress", ["items"])
    assert again == {"item_details": 1, "item_price_snapshots": 1}
    assert land_responses(spark, f"{folder}/inbox", root, f"{folder}/progress", ["items"]) == {"item_details": 0, "item_price_snapshots": 0}
    # a batch that is tried again takes the place of its first attempt
    batch = spark.read.schema(RESPONSE).json(f"{folder}/inbox/items/2.json")
    assert land_batch(batch, "items", 1, root)["item_details"] == 1
    assert scan_bronze(spark, root, "item_details").count() == 3
    assert land_batch(batch.limit(0), "items", 1, root)["item_details"] == 0
    assert scan_bronze(spark, root, "item_details").count() == 2


def test_pipeline_lands_responses_and_records_its_checks(spark, folder):
    fill(folder)
    run = lambda name: rows(run_pipeline(spark, f"{folder}/bronze", f"{folder}/out", name, inbox=f"{folder}/inbox"))[0]
    tasks = json.loads(run("one")["tasks"])
    assert {"entity": "categories", "rows": 3} in tasks["extract_marketplace_data"]
    assert tasks["extract_authenticated_marketplace_data"]["status"] == "success"
    assert [c["passed"] for c in tasks["validate_raw_data"]] == [True] * 4
    assert {c["name"] for c in tasks["data_quality_checks"]} >= {"silver_item_details_item_id_unique"}
    assert {r["item_id"]: r["price"] for r in rows(spark.read.parquet(f"{folder}/out/silver/item_details"))} == {"I1": 1.5, "I2": 2.0}
    tasks = json.loads(run("two")["tasks"])
    assert tasks["extract_authenticated_marketplace_data"]["status"] == "skipped"
    assert spark.read.parquet(f"{folder}/out/silver/item_price_snapshots").count() == 2
    document = json.loads(spark.read.text(f"{folder}/out/ml/advanced_metadata").first()[0])
    assert document["readiness"]["forecasting"]["ready"] is False and not document.get("clustering")


def day(n):
    return 20260900 + n


def test_forecast_reads_only_the_dates_it_needs(spark, folder):
    path = f"{folder}/history"
    first = [(c, float(10 * n + i), day(n)) for n in range(1, 15) for i, c in enumerate(("A", "B", "C")) if not (c == "C" and n > 11)]
    append_snapshots(spark.createDataFrame(first, SNAPSHOTS), path, "category_id")
    again = [("A", 1.0, day(14)), ("B", 2.0, day(14)), ("A", 3.0, day(15)), ("C", 4.0, day(15)), ("N", 5.0, day(15)), (None, 6.0, day(15))]
    append_snapshots(spark.createDataFrame(again, SNAPSHOTS), path, "category_id")
    history = read_history(spark, path, SNAPSHOTS)
    assert history.count() == len(first) - 2 + len(again)
    got = {(r["category_id"], r["snapshot_date_key"]): r["forecast_value"] for r in rows(scoring.forecast_from(history, day(14)))}
    assert got == {("A", day(14)): 130.0, ("B", day(14)): 131.0, ("A", day(15)): 1.0, ("C", day(15)): 112.0}
    # dates before the one C paused on are not opened: their files cannot be read
    for n in range(1, 8):
        for name in os.listdir(f"{path}/snapshot_date_key={day(n)}"):
            if name.endswith(".parquet"):
                with open(f"{path}/snapshot_date_key={day(n)}/{name}", "r+b") as f:
                    f.truncate(10)
    seen_before = history.filter("category_id <> 'N'")  # a new category is looked for in all dates
    assert sorted(r["category_id"] for r in rows(last_before(seen_before, "category_id", day(15)))) == ["A", "C"]
    with pytest.raises(Exception):
        history.agg({"opportunity_score": "sum"}).collect()
    assert {r["name"]: r["ready"] for r in rows(scoring.readiness(read_history(spark, f"{folder}/none", SNAPSHOTS)))} == {"clustering": False, "forecasting": False}


def test_a_failed_publish_leaves_the_version_before(spark, folder):
    root = f"{folder}/star"
    with pytest.raises(ValueError, match="nothing has been published"):
        published_root(spark, root)
    one, more = spark.range(3), spark.range(5)
    assert publish_together({"dim": one, "fact": one}, root) == {"dim": 3, "fact": 3}
    before = published_root(spark, root)
    broken = spark.range(1).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish_together({"dim": more, "fact": broken}, root)
    assert published_root(spark, root) == before
    assert [spark.read.parquet(f"{before}/{t}").count() for t in ("dim", "fact")] == [3, 3]
    publish_together({"dim": more, "fact": more}, root)
    assert published_root(spark, root) != before and spark.read.parquet(f"{published_root(spark, root)}/fact").count() == 5
