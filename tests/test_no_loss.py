"""Cases in which rows or digits once went missing."""

import json

import pytest
from pyspark.sql import functions as F

from bazaarlens.functions import numbers
from bazaarlens.operators import paging, previous, ranking
from bazaarlens.plans import isolation, scoring
from bazaarlens.sources import bronze, documents, responses
from tests.conftest import rows
from tests.test_models_serving import features


def test_sum_keeps_digits_beyond_the_money_grid(spark):
    df = spark.createDataFrame([(0.00004,), (0.00003,), (None,)], "x double")
    got = rows(df.agg(numbers.exact_sum(F.col("x")).alias("s"), numbers.exact_mean(F.col("x")).alias("m")))[0]
    assert got["s"] == pytest.approx(0.00007, rel=1e-12) and got["m"] == pytest.approx(0.000035, rel=1e-12)


def test_many_documents_in_a_file_come_back(spark, folder):
    df = spark.createDataFrame([(i, f"t {i}") for i in range(7)], "a int, b string")
    documents.write_document(df.coalesce(2), f"{folder}/lines")
    assert sorted(r["a"] for r in rows(documents.read_documents(spark, f"{folder}/lines", "a int, b string"))) == list(range(7))
    pretty = "\n".join(json.dumps({"a": i, "b": f"x\n{{{i}"}, indent=2) for i in range(3))
    spark.createDataFrame([(pretty,)], "value string").coalesce(1).write.text(f"{folder}/pretty")
    assert [r["b"] for r in rows(documents.read_documents(spark, f"{folder}/pretty", "a int, b string"))] == [f"x\n{{{i}" for i in range(3)]
    spark.createDataFrame([(json.dumps([{"a": 1}, {"a": 2}]),)], "value string").write.text(f"{folder}/listed")
    assert sorted(r["a"] for r in rows(documents.read_documents(spark, f"{folder}/listed", "a int, b string"))) == [1, 2]


LISTS = [
    ('[\n{"a": 1},\n{"a": 2},\n{"a": 3}\n]', [1, 2, 3]),
    ('[{"a": 1},\n{"a": 2}]', [1, 2]),
    ('{"a": 1, "b":\n{"c": 2}}', [1]),
    ('{"a": 1}\r\n[{"a": 2},\n{"a": 3}]\n\n{\n"a": 4\n}', [1, 2, 3, 4]),
    ('{"a": 1, "b": "}"}\n[]\n[{"a": 2}, {"a": 3}]\n{"a": null}', [1, 2, 3, None]),
]


@pytest.mark.parametrize("text, ids", LISTS)
def test_line_breaks_inside_documents_lose_no_rows(spark, folder, text, ids):
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/a b+c%20")
    spark.createDataFrame([('\n{"a": 9}\n \n',)], "value string").coalesce(1).write.mode("append").text(f"{folder}/a b+c%20")
    got = [r["a"] for r in rows(documents.read_documents(spark, f"{folder}/a b+c%20", "a int, b string"))]
    assert sorted(got, key=repr) == sorted([*ids, 9], key=repr)


@pytest.mark.parametrize("text", ['{"a": 1}\n{"a": 2', '[{"a": 1}, 5]', "null", '{"a": 1} {"a": 2}', '[{"a": 1}] [{"a": 2}]', "text"])
def test_what_is_no_document_fails_the_read(spark, folder, text):
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/broken")
    with pytest.raises(Exception, match="not a JSON document"):
        documents.read_documents(spark, f"{folder}/broken", "a int, b string").collect()


@pytest.mark.parametrize("descending", [True, False])
def test_keyset_pages_reach_rows_with_null_keys(spark, descending):
    data = [(s, k) for s in (3, 2, None) for k in ("a", "b", None)]
    df = spark.createDataFrame(data, "s int, k string")
    columns, walked, last = [("s", descending), ("k", False)], [], None
    while page := rows(paging.page_after(df, columns, last, 2)):
        walked += [(r["s"], r["k"]) for r in page]
        last = page[-1]
    assert walked == [(r["s"], r["k"]) for r in rows(df.orderBy(*paging.key_order(columns)))]
    assert sorted(walked, key=repr) == sorted(data, key=repr)


def test_the_requested_id_goes_into_the_payload(spark):
    df = spark.createDataFrame([('{"plain_text":"t","n":1.5}', "R1"), ('{"id":"own"}', "R2"), ('{"id":null,"x":[1]}', "R3"), ("broken", "R4")], "payload string, item string")
    got = {r["id"]: r["payload"] for r in rows(responses.merge_id(df, "payload", "item"))}
    assert json.loads(got["R1"]) == {"id": "R1", "plain_text": "t", "n": 1.5}
    assert json.loads(got["own"]) == {"id": "own"} and json.loads(got["R3"]) == {"id": "R3", "x": [1]} and got["R4"] == "broken"


def test_payloads_of_many_lines_stay_one_record(spark, folder):
    payloads = [json.dumps({"id": "A", "t": "x\ny"}, indent=1), '{"id": "B"}', "not json"]
    df = spark.createDataFrame([(p,) for p in payloads], "payload string")
    records = bronze.envelope(df, "payload", "s", "/e", F.lit("2026-09-10T00:00:00Z"))
    bronze.write_bronze(records, folder, "items")
    got = [r["payload"] for r in rows(bronze.scan_jsonl(spark, folder, "items"))]
    assert len(got) == 3 and {"id": "A", "t": "x\ny"} in [json.loads(p) for p in got if p.startswith("{")]


def test_a_row_without_metric_does_not_win(spark):
    df = spark.createDataFrame([(None, "a"), (5, "b"), (3, "c")], "m int, k string")
    assert rows(df.agg(ranking.row_with_max(F.col("m"), F.col("k"), F.col("m"), F.col("k")).alias("r")))[0]["r"] == {"m": 5, "k": "b"}


@pytest.mark.parametrize("value", [0.0005, 0.00012345, 0.00005, 1.5e-7, 12345678.123456789, 1e16, 1e22, -0.0002, 1234567890123.25])
def test_float_text_is_python_s(spark, value):
    assert rows(spark.range(1).select(numbers.python_float(F.lit(value)).alias("t")))[0]["t"] == repr(value)


def test_undated_rows_keep_their_isolation_score(spark):
    df = features(spark, 40).withColumn("snapshot_date_key", F.when(F.col("category_id") != "C000", F.col("snapshot_date_key")))
    got = rows(scoring.detect_anomalies(isolation.isolation_scores(df)))
    assert len(got) == df.count() and all(0 < r["isolation_score"] <= 1 for r in got)


def test_every_row_can_be_drawn_by_a_tree(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("k"), F.array(F.rand(1), F.rand(2)).alias("x"))
    forest = rows(isolation.grow_forest(df, ["k"], trees=50, sample=64))
    assert len(forest) == 50 and all(t["rows"] == 64 for t in forest)


def test_slices_follow_clustered_times(spark):
    times = list(range(99)) + [10_000_000]
    df = spark.createDataFrame([("a", t, t) for t in times], "k string, t long, v long")
    out = {r["t"]: r["p"] for r in rows(previous.with_previous(df, "k", "t", {"p": "v"}, position=F.col("t"), hot_rows=10))}
    assert out == {t: p for t, p in zip(times, [None, *times])}


def test_a_truncated_newest_record_does_not_replace_a_valid_one(spark):
    from bazaarlens.plans import silver
    from tests.test_layers import D10, D11, landed

    df = landed(spark, [(D10, "a", {"id": "a", "plain_text": "kept"}), (D11, "a", '{"id": "a", "plain_te')])
    assert [(r["item_id"], r["plain_text"]) for r in rows(silver.silver_item_descriptions(df))] == [("a", "kept")]
    assert silver.broken_payloads(df).count() == 1
