"""Disk: what is written and shuffled, how often, and how long it is kept."""

import time

import pytest
from pyspark.sql import functions as F

from bazaarlens import session
from bazaarlens.functions import text
from bazaarlens.plans import marts, silver
from bazaarlens.sources import bronze, tables
from tests.conftest import rows


def _landed(spark, ids, days=3):
    payload = F.format_string('{"id":"I%d","plain_text":"%s"}', F.col("id"), F.repeat(F.lit("x"), 50))
    at = F.when(F.col("id") % 7 != 0, F.format_string("2026-09-1%dT10:00:00Z", F.col("id") % days))
    return bronze.envelope(ids.withColumn("payload", payload), "payload", "api", "/items", at)


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _freed(spark, before):
    for _ in range(100):  # files are removed in the background
        if not _shuffle_files(spark) - before:
            return True
        time.sleep(0.1)
    return False


def test_records_of_many_days_are_dealt_once_for_both_twins(spark, folder, monkeypatch):
    lines, made = [], bronze.json_lines
    monkeypatch.setattr(bronze, "json_lines", lambda dated: lines.append(dated) or made(dated))
    before = _shuffle_files(spark)
    for first in (0, 100):  # the second landing adds its own records only
        assert bronze.write_bronze(_landed(spark, spark.range(first, first + 100)), folder, "items", many_days=True) == 100
    assert _freed(spark, before)
    assert len(lines) == 2
    assert all("Repartition" not in df._jdf.queryExecution().optimizedPlan().toString() for df in lines)
    columns = ["record_id", "payload", "ingested_at", "year", "month", "day"]
    twin, back = (scan(spark, folder, "items").select(*columns) for scan in (bronze.scan_bronze, bronze.scan_jsonl))
    assert sorted(r["record_id"] for r in rows(back)) == sorted(f"I{i}" for i in range(200))
    assert sorted(map(str, rows(twin))) == sorted(map(str, rows(back)))
    assert twin.filter("year is null").count() == 29


def test_no_records_of_many_days(spark, folder):
    assert bronze.write_bronze(_landed(spark, spark.range(0)), folder, "items", many_days=True) == 0
    assert bronze.scan_bronze(spark, folder, "items").count() == 0


def test_payload_files_are_small_and_well_packed(spark, folder):
    assert tables.write_table(_landed(spark, spark.range(250_000).coalesce(1)), folder, options=tables.PAYLOAD_GROUP) == 250_000
    files = {r["f"]: r["n"] for r in rows(spark.read.parquet(folder).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count(F.lit(1)).alias("n")))}
    assert sorted(files.values()) == [50_000, 100_000, 100_000] and all(".zstd." in f for f in files)


def test_shuffles_of_a_written_table_are_freed(spark, folder):
    before = _shuffle_files(spark)
    assert tables.write_table(spark.range(1000).repartition(3, "id"), folder) == 1000
    assert _freed(spark, before)


def test_settings_come_back(spark):
    key, other = "spark.sql.files.maxPartitionBytes", "spark.sql.bazaarlens.none"
    kept = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), session.settings(spark, {key: "1m", other: "x"}):
        assert (spark.conf.get(key), spark.conf.get(other)) == ("1m", "x")
        1 / 0
    assert spark.conf.get(key) == kept and spark.conf.get(other, None) is None


def test_packed_texts_come_back(spark):
    texts = ["", None, "a", "\x1f", "\x1b", "\x1b1", "\x1b\x1f0", "\x1b2", "é\x1f\x1f", " \x1b0\x1b"]
    data = [tuple(texts[(i + k) % len(texts)] for k in range(4)) for i in range(len(texts))] + [(None,) * 4, ("",) * 4]
    df = spark.createDataFrame(data, "a string, b string, c string, d string")
    parts = df.select("*", text.packed_parts(text.packed([F.col(c) for c in df.columns])).alias("parts"))
    got = rows(parts.select(*df.columns, *(text.unpacked(F.col("parts"), i).alias(f"{c}2") for i, c in enumerate(df.columns))))
    assert all(r[c] == r[f"{c}2"] for r in got for c in df.columns) and len(got) == len(data)
    one = spark.createDataFrame([("",), (None,), ("x",)], "a string").select("a", text.packed_parts(text.packed([F.col("a")])).alias("parts"))
    assert all(r["a"] == r["b"] for r in rows(one.select("a", text.unpacked(F.col("parts"), 0).alias("b"))))


@pytest.mark.parametrize("name", ["item_details", "item_price_snapshots"])
def test_fields_of_the_wide_tables_are_sorted_and_sent_as_one_text(spark, name):
    at = ["2026-09-10T10:00:00Z", "2026-09-11T10:00:00Z"]
    data = [
        (at[0], '{"id":"A","title":"old","price":1}'), (at[1], '{"id":"A","title":"a\\u001fb\\u001b2","price":"2.50","available_quantity":"3.0","last_updated":"no"}'),
        (at[1], '{"id":"A","title":'), (at[0], '{"id":"B","price":"n/a","sold_quantity":7,"status":""}'), (at[0], "{}"), (None, '{"item_id":"C","title":null}'), (at[0], None),
    ]
    payloads = spark.createDataFrame(data, "at string, payload string")
    df = silver.TRANSFORMS[name](bronze.envelope(payloads, "payload", "api", "/items", F.col("at")))
    got = {(r["item_id"], str(r["ingested_at"])[:10]): r for r in rows(df)}
    a = got["A", "2026-09-11"]
    assert a["price"] == 2.5 and a["available_quantity"] == 3 and a["last_updated"] is None and a.get("title", "a\x1fb\x1b2") == "a\x1fb\x1b2"
    b = got["B", "2026-09-10"]
    assert b["price"] is None and b["sold_quantity"] == 7 and b["status"] == "" and b["source"] == "api"
    assert len(got) == (3 if name == "item_details" else 5)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window [row_number()") :].splitlines()
    sent = next(line for line in below if "Project" in line)  # the rows that the window takes
    assert " AS _text#" in sent and " AS seller_id#" not in sent and " AS price#" not in sent


def test_seller_metrics_of_stored_items_are_those_of_the_star(spark, folder):
    made = {
        "dim_item": "('A','t','c','s',null,null,null), ('B',null,null,null,null,null,null), ('D','t','c','s',null,null,null) as t(item_id, title, category_id, seller_id, condition, listing_type_id, permalink)",
        "dim_date": "(20240101L, '2024-01-01', 2024L, 1L, 1L), (20240102L, '2024-01-02', 2024L, 1L, 2L) as t(date_key, date, year, month, day)",
        "fact_seller_item_snapshot": "('A',20240101L,1.5D,1L,0L,'active'), ('A',20240102L,2.5D,null,3L,'active'), ('A',20240102L,2.5D,null,3L,'active'), ('B',null,null,4L,0L,null),"
        " ('C',20240101L,9.0D,0L,0L,'paused'), ('D',20250101L,0.1D,2L,2L,'active'), (null,20240101L,0.2D,2L,2L,null) as t(item_id, snapshot_date_key, price, available_quantity, sold_quantity, status)",
    }
    star = {}
    for name, values in made.items():
        tables.write_table(spark.sql(f"select * from values {values}"), f"{folder}/{name}")
        star[name] = spark.read.parquet(f"{folder}/{name}")
    tables.write_table(marts.mart_seller_items(star), f"{folder}/items")
    want, got = marts.mart_seller_item_metrics(star), marts.mart_seller_item_metrics(star, spark.read.parquet(f"{folder}/items"))
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(want))) and got.count() == 3
    assert got.dtypes == want.dtypes
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1  # the name of the latest date
