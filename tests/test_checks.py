"""A few registered queries against their check SQL; ``check.py`` compares all of them."""

import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from check import compare
from workload.inputs import TABLES

DATA = "/root/testdata/sf0.001"
KEYS = [
    "silver_item_details", "silver_categories", "gold_seller_item_metrics", "gold_price_history",
    "gold_public_query_metrics", "win_delta_stock_sold", "unwrap_multiget", "intent_classify",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    with duckdb.connect() as c:
        for table in TABLES:
            c.sql(f"create view {table} as select * from '{DATA}/{table}.parquet'")
        yield c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, connection, key):
    outcome, note = compare(spark, connection, DATA, key, queries()[key], oracle_sql()[key])
    assert outcome == "ok", note


def test_every_check_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
