import json

import pytest
from pyspark.sql import functions as F

from bazaarlens import schemas
from bazaarlens.plans import gold, marts, silver, star
from bazaarlens.sources import bronze, documents, responses, tables
from tests.conftest import rows

D10, D11 = "2026-09-10T10:00:00+00:00", "2026-09-11T10:00:00+00:00"


def landed(spark, payloads):
    data = [(ts, "api", "/x", rid, json.dumps(p) if isinstance(p, dict) else p) for ts, rid, p in payloads]
    return spark.createDataFrame(data, "ingested_at string, source string, endpoint string, record_id string, payload string")


def discovery(spark, hits):
    data = [(ts, "api", f"/sites/S/domain_discovery/search?q={q}", json.dumps(p)) for ts, q, p in hits]
    return spark.createDataFrame(data, "ingested_at string, source string, endpoint string, payload string")


NOTEBOOK = {"domain_id": "D-NOTE", "domain_name": "Notebooks", "category_id": "C1", "category_name": "Notebooks"}


def test_domain_discovery_keeps_one_row_per_query(spark):
    got = rows(silver.silver_domain_discovery(discovery(spark, [(D10, "notebook", NOTEBOOK), (D11, "computador", NOTEBOOK), (D11, "notebook", NOTEBOOK)])))
    assert {r["search_query"] for r in got} == {"notebook", "computador"}
    keys = {r["query_domain_category_id"] for r in got}
    assert "notebook__D-NOTE__C1" in keys and {r["domain_category_id"] for r in got} == {"D-NOTE__C1"}


def test_category_path_children_and_settings(spark):
    base = {
        "id": "C1", "name": "Notebooks", "picture": "p", "total_items_in_this_category": 100,
        "path_from_root": [{"id": "R", "name": "Computacao"}], "children_categories": [{"id": "C2"}],
        "settings": {"adult_content": False},
    }
    odd = {"id": "C2", "name": "Odd", "path_from_root": "text", "children_categories": "none", "total_items_in_this_category": "x"}
    nameless = {"id": "C3", "name": "N", "path_from_root": [{"name": "A"}, {"id": 1}, {"name": "B"}], "children_categories": [{"id": 1}, 5]}
    got = {r["category_id"]: r for r in rows(silver.silver_categories(landed(spark, [(D10, "C1", base), (D10, "C2", odd), (D10, "C3", nameless)])))}
    assert got["C1"]["path_from_root"] == "Computacao" and got["C1"]["children_categories_count"] == 1
    assert got["C1"]["settings_adult_content"] is False and got["C1"]["total_items_in_this_category"] == 100
    assert got["C2"]["path_from_root"] == "" and got["C2"]["children_categories_count"] == 0
    assert got["C2"]["total_items_in_this_category"] is None
    assert got["C3"]["path_from_root"] == "A >  > B" and got["C3"]["children_categories_count"] == 2


def test_item_details_latest_and_typed(spark):
    old = {"id": "I1", "title": "Old", "price": 100, "seller_id": 123}
    new = {"id": "I1", "title": "New", "price": "90.5", "seller_id": 123, "date_created": "2026-09-01T00:00:00.000Z", "last_updated": "bad"}
    got = rows(silver.silver_item_details(landed(spark, [(D10, "I1", old), (D11, "I1", new)])))
    assert len(got) == 1
    r = got[0]
    assert (r["title"], r["price"], r["seller_id"], r["last_updated"]) == ("New", 90.5, "123", None)
    assert r["date_created"].day == 1 and r["available_quantity"] is None


def test_broken_and_foreign_payloads_become_null_rows_and_are_found(spark):
    df = landed(spark, [(D10, "a", '{"id": "a"'), (D10, "b", "[1]"), (D10, "c", {"id": "c"})])
    got = {r["item_id"] for r in rows(silver.silver_item_descriptions(df))}
    assert got == {None, "c"}
    assert [r["record_id"] for r in rows(silver.broken_payloads(df))] == ["a"]


def test_price_snapshots_keep_history(spark):
    p = {"id": "I1", "seller_id": 123, "category_id": "C1", "price": 100, "available_quantity": 5, "sold_quantity": 2, "status": "active"}
    df = landed(spark, [(D10, "I1", p), (D11, "I1", {**p, "price": 90}), (D11, "I1", {**p, "price": 90})])
    got = sorted(rows(silver.silver_item_price_snapshots(df)), key=lambda r: r["snapshot_date_key"])
    assert [(r["price"], r["snapshot_date_key"]) for r in got] == [(100.0, 20260910), (90.0, 20260911)]


def test_descriptions_length(spark):
    df = landed(spark, [(D10, "I1", {"id": "I1", "plain_text": "Descrição"}), (D10, "I2", {"id": "I2"})])
    got = {r["item_id"]: (r["plain_text"], r["text_length"]) for r in rows(silver.silver_item_descriptions(df))}
    assert got == {"I1": ("Descrição", 9), "I2": ("", 0)}


def test_empty_bronze_keeps_the_contract(spark):
    empty = spark.createDataFrame([], schemas.BRONZE)
    for name, transform in silver.TRANSFORMS.items():
        out = transform(empty)
        assert out.count() == 0
        want = spark.createDataFrame([], schemas.SILVER[name]).dtypes
        assert out.dtypes == want, name


def categories(spark, data):
    ddl = "category_id string, category_name string, total_items_in_this_category bigint, children_categories_count bigint, path_from_root string, ingested_at string"
    return spark.createDataFrame(data, ddl).withColumn("ingested_at", F.to_timestamp("ingested_at"))


def domains(spark, data, ddl="domain_id string, category_id string"):
    return spark.createDataFrame(data, ddl)


def test_category_metrics(spark):
    cats = categories(spark, [("A", "a", 50, 2, "X > Y", D10), ("B", "b", 100, 0, "X", D10), ("N", "n", None, 0, None, D10)])
    got = rows(gold.in_report_order(gold.gold_category_metrics(cats, domains(spark, [("D1", "A"), ("D2", "A"), ("D2", "A")])), "category_metrics"))
    assert [r["category_id"] for r in got] == ["B", "A", "N"]
    assert got[0]["catalog_coverage_score"] == 100.0 and got[1]["catalog_coverage_score"] == 50.0
    assert got[1]["domain_count"] == 2 and got[0]["domain_count"] == 0 and got[1]["category_depth"] == 2
    nothing = gold.gold_category_metrics(categories(spark, [("A", "a", 0, 0, "", D10)]), domains(spark, []))
    assert rows(nothing)[0]["catalog_coverage_score"] == 0.0


def test_overview(spark):
    cats = categories(spark, [("A", "a", 50, 1, "", D10), ("B", "b", None, 2, "", D10)])
    doms = domains(spark, [("D1", "A", D11)], "domain_id string, category_id string, ts string").withColumn("ingested_at", F.to_timestamp("ts"))
    r = rows(gold.gold_marketplace_overview(cats, doms))[0]
    assert (r["total_categories"], r["total_domains"], r["total_items_in_categories"], r["avg_children_categories"]) == (2, 1, 50, 1.5)
    assert r["latest_ingestion_at"].day == 11
    e = rows(gold.gold_marketplace_overview(cats.filter("false"), doms.filter("false")))[0]
    assert (e["total_categories"], e["total_domains"], e["total_items_in_categories"], e["avg_children_categories"], e["latest_ingestion_at"]) == (0, 0, 0, 0.0, None)


def test_query_metrics_without_domain_times(spark):
    cats = categories(spark, [("A", "a", 10, 0, "", D10), ("B", "b", 20, 0, "", D10)])
    doms = domains(spark, [("D1", "A", "notebook"), ("D2", "B", "notebook"), ("D2", "B", "celular"), ("D3", "Z", None)], "domain_id string, category_id string, search_query string")
    got = {r["search_query"]: r for r in rows(gold.gold_public_query_metrics(cats, doms))}
    assert (got["notebook"]["category_count"], got["notebook"]["domain_count"], got["notebook"]["total_items_in_categories"]) == (2, 2, 30)
    assert got["notebook"]["avg_catalog_coverage_score"] == 75.0 and got["notebook"]["latest_ingestion_at"].day == 10
    assert got[None]["total_items_in_categories"] == 0 and got[None]["domain_count"] == 1
    unnamed = rows(gold.gold_public_query_metrics(cats, doms.drop("search_query")))
    assert [r["search_query"] for r in unnamed] == ["unknown"]


ITEM_DDL = "item_id string, seller_id string, category_id string, status string, price double, available_quantity bigint, sold_quantity bigint, ts string"


def items(spark, data):
    return spark.createDataFrame(data, ITEM_DDL).withColumn("ingested_at", F.to_timestamp("ts")).drop("ts")


def test_seller_item_metrics(spark):
    df = items(
        spark,
        [
            ("1", "123", "C", "active", 100.0, 5, 2, D10), ("2", "123", "C", "active", 200.0, 7, 3, D10),
            ("3", "123", "C", "paused", 50.0, 1, 0, D10), ("4", None, None, None, None, None, None, None),
        ],
    )
    got = {r["status"]: r for r in rows(gold.gold_seller_item_metrics(df))}
    a = got["active"]
    assert (a["item_count"], a["avg_price"], a["total_available_quantity"], a["total_sold_quantity"], a["sell_through_rate"], a["price_spread"]) == (2, 150.0, 12, 5, 29.41, 100.0)
    assert (a["paused_item_count"], a["zero_sales_stock_count"]) == (0, 0)
    assert (got["paused"]["paused_item_count"], got["paused"]["zero_sales_stock_count"]) == (1, 1)
    u = got["unknown"]
    assert (u["seller_id"], u["avg_price"], u["sell_through_rate"], u["latest_ingestion_at"]) == (None, None, 0.0, None)


def snapshots(spark, data):
    ddl = "item_id string, ts string, price double, available_quantity bigint, sold_quantity bigint"
    df = spark.createDataFrame(data, ddl).withColumn("snapshot_date", F.to_timestamp("ts"))
    extra = {c: F.lit(None).cast("string") for c in ("seller_id", "category_id", "currency_id", "status")}
    extra |= {c: F.lit(None).cast("double") for c in ("base_price", "original_price")}
    return df.withColumns(extra).withColumn("snapshot_date_key", F.date_format("snapshot_date", "yyyyMMdd").cast("bigint"))


def test_price_history(spark):
    df = snapshots(spark, [("I1", D10, 100.0, 5, 2), ("I1", D11, 90.0, 4, 3), ("I2", D10, 0.0, 1, None), ("I2", D11, 5.0, None, 1)])
    got = {(r["item_id"], r["snapshot_date_key"]): r for r in rows(gold.gold_price_history(df))}
    r = got[("I1", 20260911)]
    assert (r["price_change_abs"], r["price_change_pct"], r["stock_change"], r["sold_change"]) == (-10.0, -10.0, -1, 1)
    assert got[("I1", 20260910)]["price_change_abs"] is None
    assert got[("I2", 20260911)]["price_change_pct"] is None and got[("I2", 20260911)]["stock_change"] is None


def full_star(spark):
    cats = categories(spark, [("C1", "Notebooks", 10, 1, "Informatica > Notebooks", D10)]).withColumns(
        {"attribute_types": F.lit("x"), "settings_adult_content": F.lit(False)}
    )
    doms = domains(spark, [("D1", "C1", "Notebooks", "Notebooks", "q", "D1__C1", D10)], "domain_id string, category_id string, domain_name string, category_name string, search_query string, domain_category_id string, ts string").withColumn("ingested_at", F.to_timestamp("ts"))
    its = items(spark, [("I1", "123", "C1", None, 10.0, 1, 0, D10)]).withColumns({c: F.lit(c) for c in ("title", "condition", "listing_type_id", "permalink")})
    metrics, overview = gold.gold_category_metrics(cats, doms), gold.gold_marketplace_overview(cats, doms)
    return star.build_star(cats, doms, its, metrics, overview)


def test_star_and_marts(spark, folder):
    built = full_star(spark)
    assert tables.publish(built, folder) == {name: 1 for name in built}
    stored = {name: tables.read_table(spark, f"{folder}/{name}") for name in built}
    assert rows(stored["dim_date"])[0] == {"date_key": 20260910, "date": "2026-09-10", "year": 2026, "month": 9, "day": 10}
    assert rows(stored["fact_seller_item_snapshot"])[0]["snapshot_date_key"] == 20260910
    m = marts.build_marts(stored)
    assert rows(m["mart_category_metrics"])[0]["coverage_band"] == "high_coverage"
    assert rows(m["mart_seller_items"])[0]["status"] == "unknown"
    assert rows(m["mart_seller_item_metrics"])[0]["latest_snapshot_date"] == "2026-09-10"
    for checks in (marts.key_checks({**stored, **m}), marts.reference_checks(stored)):
        assert all(r["passed"] for r in rows(checks))


def test_append_replaces_only_the_dates_given(spark, folder):
    ddl = "snapshot_date_key bigint, item_id string, price double"
    first = spark.createDataFrame([(20260910, "a", 1.0), (20260911, "a", 2.0)], ddl)
    tables.append_snapshots(first, folder, "item_id")
    tables.append_snapshots(spark.createDataFrame([(20260911, "b", 9.0)], ddl), folder, "item_id")
    got = sorted((r["snapshot_date_key"], r["item_id"]) for r in rows(tables.read_table(spark, folder)))
    assert got == [(20260910, "a"), (20260911, "b")]


def test_bronze_twins_and_partitions(spark, folder):
    df = spark.createDataFrame([('{"id":"M1","title":"Produto \\"real\\""}',), ('{"domain_id":"D1","category_id":"C1"}',), ('{"id":"","category_id":"C2"}',)], "payload string")
    records = bronze.envelope(df, "payload", "api", "/x", F.lit("2026-09-10T00:00:00+00:00"))
    assert bronze.write_bronze(records, folder, "products") == 3
    got = rows(bronze.scan_bronze(spark, folder, "products"))
    assert {r["record_id"] for r in got} == {"M1", "D1", "C2"}
    assert {(r["year"], r["month"], r["day"]) for r in got} == {("2026", "09", "10")}
    lines = rows(bronze.scan_jsonl(spark, folder, "products"))
    assert sorted(json.dumps(json.loads(r["payload"])) for r in lines) == sorted(json.dumps(json.loads(r["payload"])) for r in got)
    assert bronze.scan_bronze(spark, folder, "nothing").count() == 0


def test_optional_table_and_documents(spark, folder):
    assert tables.read_optional(spark, f"{folder}/none", "a int, b string").dtypes == [("a", "int"), ("b", "string")]
    df = spark.createDataFrame([(1, None)], "a int, b string")
    documents.write_document(df, f"{folder}/doc")
    assert rows(documents.read_documents(spark, f"{folder}/doc", "a int, b string")) == [{"a": 1, "b": None}]
    assert tables.query({"t": df}, "select a from {t} where a >= :low", low=1).count() == 1
    assert tables.table_or(spark, "no_such_table_here", df).count() == 1


def test_jdbc_options():
    got = tables.jdbc_options("jdbc:postgresql://db/x", "analytics.dim_item", user="u")
    assert got["truncate"] == "true" and got["dbtable"] == "analytics.dim_item" and "password" not in got


def bodies(spark, *values):
    return spark.createDataFrame([(v, 7) for v in values], "body string, seller int")


def test_response_shapes(spark):
    multi = json.dumps([{"code": 200, "body": {"id": "A"}}, {"code": 404, "body": {"id": "B"}}, {"code": 200, "body": "x"}, 3])
    assert [json.loads(r["payload"]) for r in rows(responses.unwrap_multiget(bodies(spark, multi), "body"))] == [{"id": "A"}]
    ids = json.dumps({"results": ["A", 5, None, "B"]})
    assert rows(responses.explode_listing_ids(bodies(spark, ids), "body", "seller")) == [{"id": "A", "seller_id": "7"}, {"id": "B", "seller_id": "7"}]
    found = json.dumps({"results": [{"id": "A"}, "x"], "paging": {"total": 1}})
    assert responses.explode_search_results(bodies(spark, found, "{}"), "body").count() == 1
    bare, wrapped = json.dumps([{"id": "A"}, 1]), json.dumps({"categories": [{"id": "B"}]})
    assert responses.explode_categories(bodies(spark, bare, wrapped, "5"), "body").count() == 2
    merged = spark.createDataFrame([('{"plain_text":"t"}', "R1"), ('{"id":"own"}', "R2")], "payload string, item string")
    assert [r["id"] for r in rows(responses.merge_id(merged, "payload", "item"))] == ["R1", "own"]
    details = spark.createDataFrame([('{"id":"A","price":5,"title":"t"}',), ('{"id":""}',), ("{}",)], "payload string")
    got = rows(responses.price_snapshot_payloads(details))
    assert len(got) == 1 and len(got[0]) == 13 and got[0]["item_id"] == "A"
