import json

from pyspark.sql import functions as F

from bazaarlens.plans.silver import silver_item_details
from bazaarlens.sources.bronze import envelope, scan_bronze, write_bronze
from bazaarlens.streaming.bronze_to_silver import current, follow
from tests.conftest import rows


def land(spark, folder, day, items):
    df = spark.createDataFrame([(json.dumps(i),) for i in items], "payload string")
    records = envelope(df, "payload", "api", "/items", F.lit(f"2026-09-{day}T10:00:00+00:00"))
    write_bronze(records, f"{folder}/bronze", "item_details")


def test_stream_in_steps_equals_one_batch(spark, folder):
    def step():
        follow(spark, f"{folder}/bronze/parquet/item_details", "item_details", f"{folder}/silver", f"{folder}/progress").awaitTermination()

    land(spark, folder, 10, [{"id": "A", "price": 1}, {"id": "B", "price": 2}])
    step()
    land(spark, folder, 12, [{"id": "A", "price": 3}])
    step()
    land(spark, folder, 11, [{"id": "A", "price": 9}, {"id": "C", "price": 4}])
    step()
    step()
    streamed = sorted(map(str, rows(current(spark, f"{folder}/silver", "item_details"))))
    batch = sorted(map(str, rows(silver_item_details(scan_bronze(spark, f"{folder}/bronze", "item_details")))))
    assert streamed == batch
    assert {r["item_id"]: r["price"] for r in rows(current(spark, f"{folder}/silver", "item_details"))} == {"A": 3.0, "B": 2.0, "C": 4.0}
