import math
import random

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import dedup, paging, previous, quality, ranking, relational, stats
from tests.conftest import rows


def test_keep_last_null_time_wins_and_null_keys_group(spark):
    df = spark.createDataFrame(
        [("a", "2026-01-01", 1), ("a", None, 2), (None, "2026-01-01", 3), (None, "2026-01-02", 4), ("b", "2026-01-01", 5), ("b", "2026-01-01", 6)],
        "k string, ts string, v int",
    )
    got = {r["k"]: r["v"] for r in rows(dedup.keep_last(df, ["k"], "ts", ["v"]))}
    assert got == {"a": 2, None: 4, "b": 6}
    first = {r["k"]: r["v"] for r in rows(dedup.keep_first(df, ["k"], "ts", ["v"]))}
    assert first == {"a": 1, None: 3, "b": 5}


def test_keep_last_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = dedup.keep_last(df, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("hot_rows", [1, 3, 7, 50, 10_000])
def test_previous_matches_brute_force_for_any_slicing(spark, hot_rows):
    rng = random.Random(7)
    data, expected = [], {}
    sizes = {"hot": 200, "warm": 20, "one": 1, None: 30}
    for key, n in sizes.items():
        times = sorted(rng.sample(range(100_000), n))
        before = None
        for t in times:
            value = None if rng.random() < 0.1 else float(rng.randint(0, 9))
            data.append((key, t, value, t * 2))
            if key is not None:
                expected[(key, t)] = before
                before = (value, t * 2)
            else:
                expected[(key, t)] = None
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, t bigint, v double, w bigint").repartition(4)
    out = previous.with_previous(df, "k", "t", {"pv": "v", "pw": "w"}, position=F.col("t"), hot_rows=hot_rows)
    got = rows(out)
    assert len(got) == len(data)
    for r in got:
        assert (r["pv"], r["pw"]) == (expected[(r["k"], r["t"])] or (None, None))


def test_previous_with_one_null_time_last(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", None, 3.0)], "k string, t bigint, v double")
    for hot_rows in (1, 100):
        out = previous.with_previous(df, "k", "t", {"p": "v"}, position=F.col("t"), hot_rows=hot_rows)
        assert {r["t"]: r["p"] for r in rows(out)} == {1: None, 2: 1.0, None: 2.0}


def test_dense_rank_has_no_gaps_and_no_rank_for_null(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 7.0), ("c", 5.0), ("d", 1.0), ("e", None)], "k string, s double")
    got = {r["k"]: r["r"] for r in rows(ranking.dense_rank_desc(df, "s", "r"))}
    assert got == {"b": 1, "a": 2, "c": 2, "d": 3, "e": None}


def test_statistics_of_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    got = rows(df.select(stats.z_score(df, F.col("x")).alias("z"), stats.min_max_score(df, F.col("x")).alias("m")))
    assert got == [{"z": 0.0, "m": 50.0}] * 2
    zero = spark.createDataFrame([(0,), (0,)], "x int")
    assert rows(zero.select(stats.share_of_total(zero, F.col("x")).alias("s"), stats.relative_to_max(zero, F.col("x")).alias("r")))[0] == {"s": 0.0, "r": 0.0}
    none = df.filter("false")
    assert none.select(stats.z_score(none, F.col("x"))).collect() == []


def test_z_score_matches_definition(spark):
    values = [1.25, 2.5, 3.75, 90.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    mean = sum(values) / 4
    std = (sum((v - mean) ** 2 for v in values) / 4) ** 0.5
    got = {r["x"]: r["z"] for r in rows(df.select("x", stats.z_score(df, F.col("x")).alias("z")))}
    for v in values:
        assert got[v] == pytest.approx((v - mean) / std, abs=1e-12)


def test_no_join_or_global_window_for_statistics(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    plan = df.select(stats.z_score(df, F.col("x")))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_pages_and_keyset_agree(spark):
    df = spark.createDataFrame([(i // 3, f"k{i:02d}") for i in range(20)], "score int, k string")
    order = [F.col("score").desc(), F.col("k")]
    paged = [r["k"] for o in range(0, 20, 6) for r in rows(paging.page(df, order, 6, o))]
    walked, last = [], None
    while True:
        got = rows(paging.page_after(df, [("score", True), ("k", False)], last, 6))
        if not got:
            break
        walked += [r["k"] for r in got]
        last = got[-1]
    assert paged == walked and len(paged) == 20
    assert rows(paging.page(df, order, 3, 0))[0]["total"] == 20
    with pytest.raises(ValueError):
        paging.page(df, order, 101)
    with pytest.raises(ValueError):
        paging.page(df, order, 10, -1)


def test_quality_checks_and_gate(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3), (None, 4)], "k string, v int")
    got = {r["name"]: r for r in rows(quality.check_table(df, quality.TableRules("t", ["k", "x"], ["k", "v"], ["k", "y"])))}
    assert got["t_required_columns"]["details"] == "missing=x" and not got["t_required_columns"]["passed"]
    assert got["t_non_null"]["details"] == "{'k': 2, 'v': 1}"
    assert got["t_k_unique"]["details"] == "duplicate_count=2"
    assert got["t_y_unique"]["details"] == "duplicate_count=-1"
    with pytest.raises(ValueError, match="t_k_unique: duplicate_count=2"):
        quality.gate(quality.check_table(df, quality.TableRules("t", unique=["k"])))
    empty = df.filter("false")
    assert all(r["passed"] for r in rows(quality.check_table(empty, quality.TableRules("t", ["k"], ["k"], ["k"]))))


def test_references_ignore_null_children(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    rule = quality.References("child", "k", "parent", "k")
    got = rows(quality.check_references({"child": child, "parent": parent}, [rule]))
    assert got == [{"name": "child_k_in_parent", "passed": False, "details": "failures=2"}]


def test_filters_skip_empty_values(spark):
    df = spark.createDataFrame([("1", "A"), ("2", "A")], "seller_id string, status string")
    assert relational.equal_filters(df, seller_id=None, status="").count() == 2
    assert relational.equal_filters(df, seller_id="2", status="A").count() == 1


def test_dense_rank_by_ranges(spark):
    """Many distinct scores, ties, and cuts that fall anywhere give the ranks of plain sorting."""
    draw = random.Random(4)
    scores = [draw.choice([None, -0.0, 0.0, draw.random() ** 9, draw.randrange(50) / 7, 1e300, float("inf")]) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(scores)), "k long, s double")
    order = {s: i + 1 for i, s in enumerate(sorted({s for s in scores if s is not None}, reverse=True))}
    for ranges in (1, 7, 256):
        got = {r["k"]: r["r"] for r in rows(ranking.dense_rank_desc(df, "s", "r", ranges))}
        assert got == {k: order.get(s) for k, s in enumerate(scores)}
    assert rows(ranking.dense_rank_desc(df.limit(0), "s", "r")) == []
    nan = spark.createDataFrame([(1, float("nan")), (2, 1.0), (3, None), (4, float("nan"))], "k long, s double")
    assert {r["k"]: r["r"] for r in rows(ranking.dense_rank_desc(nan, "s", "r", 3))} == {1: 1, 2: 2, 3: None, 4: 1}


def test_exact_quantiles_by_refinement(spark):
    """Distinct doubles, heavy ties, tails and small tables against interpolation over the sorted values."""
    draw = random.Random(5)
    tables = {
        "distinct": [draw.gauss(0, 1) ** 3 for _ in range(20000)],
        "ties": [draw.choice([1.5, 1.5, 1.5, draw.random() * 3]) for _ in range(5000)],
        "tail": [2.0 ** draw.randrange(-900, 900) for _ in range(4000)],
        "two": [3.0, 8.0],
        "one": [7.0],
        "same": [2.5] * 300,
    }
    at = (0.0, 0.25, 0.75, 0.999)
    for name, values in tables.items():
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
        ordered = sorted(values)
        for counted, grid in ((10, 40), (10_000, 200)):
            got = stats.exact_quantiles(df, F.col("v"), at, counted, grid)
            for q, g in zip(at, got):
                place = q * (len(ordered) - 1)
                low, high = math.floor(place), math.ceil(place)
                want = ordered[low] if low == high else (high - place) * ordered[low] + (place - low) * ordered[high]
                assert g == pytest.approx(want, rel=1e-12), (name, q)
    empty = spark.createDataFrame([], "v double")
    assert rows(spark.range(1).select(stats.quartiles(empty, F.col("v")).alias("q")))[0]["q"] is None


def test_orphans_with_few_and_with_many_parents(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,), ("c",), ("c",)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "p string")
    for bound in (10, 1):
        got = {r["k"]: r["rows"] for r in rows(relational.orphans(child, "k", parent, "p", bound))}
        assert got == {"b": 2, "c": 3}
        assert rows(relational.orphans(child, "k", parent.limit(0), "p", bound)) != []
    plan = relational.orphans(child, "k", parent, "p")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
