"""Sizes of writes, and plans that must not grow faster than their input."""

import gc
import glob

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from bazaarlens.functions import payload
from bazaarlens.llm import near_duplicates, packing, pieces
from bazaarlens.operators import dedup, previous
from bazaarlens.plans import gold, marts, star
from bazaarlens.sources import bronze, tables
from bazaarlens.streaming import landing
from tests.conftest import rows
from workload import inputs
from workload.inputs import INPUT_SQL, WIDE_INPUTS, Lake


def _landed(spark, n, width=2000):
    """``n`` long payloads of one day."""
    payload = F.format_string('{"id":"I%d","plain_text":"%s"}', F.col("id"), F.repeat(F.lit("x"), width))
    return bronze.envelope(spark.range(n).withColumn("payload", payload), "payload", "api", "/items", F.lit("2026-09-10T10:00:00Z"))


def test_long_texts_of_one_day_are_cut_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(tables, "BYTES_PER_TASK", 20_000)
    dated = bronze.partitioned(_landed(spark, 100).unionByName(_landed(spark, 1).withColumn("payload", F.lit(None).cast("string"))))
    cut = tables.by_date(dated, bronze.PARTITIONS, F.xxhash64("payload"), "payload")
    sizes = rows(cut.groupBy(F.spark_partition_id().alias("task")).agg(F.sum(F.octet_length("payload")).alias("bytes")))
    assert cut.rdd.getNumPartitions() >= 10 and max(r["bytes"] or 0 for r in sizes) < 60_000
    assert cut.count() == 101
    assert tables.by_date(dated.filter("false"), bronze.PARTITIONS, F.xxhash64("payload"), "payload").count() == 0


def test_landed_batch_of_one_day_is_written_by_several_tasks(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "BYTES_PER_TASK", 20_000)
    found = _landed(spark, 100).select("endpoint", F.col("record_id").alias("requested"), F.col("ingested_at").alias("received_at"), F.col("payload").alias("body"))
    assert landing.land_batch(found, "descriptions", 0, folder) == {"item_descriptions": 100}
    assert len(glob.glob(f"{folder}/parquet/item_descriptions/*/*/*/*/*.parquet")) > 4
    assert bronze.scan_jsonl(spark, folder, "item_descriptions").select("record_id").distinct().count() == 100


def test_json_lines_are_compressed_and_read_back(spark, folder):
    assert bronze.write_bronze(_landed(spark, 50), folder, "items", many_days=True) == 50
    files = glob.glob(f"{folder}/jsonl/items/*/*/*/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    key = ["record_id", "payload"]
    back = bronze.scan_jsonl(spark, folder, "items").select(*key)
    assert back.exceptAll(bronze.scan_bronze(spark, folder, "items").select(*key)).count() == 0 and back.count() == 50


def _given(spark, folder):
    """Lines and parts with ties, nulls, repeated rows and repeated part keys."""
    day = "timestamp '2024-01-0{} 00:00:00'"
    spark.sql(
        "select * from values "
        + ", ".join(
            f"({o}, {p}, {s}, {n}, {q}, {o * 10.5 + n}, {d}, {t}, '{'ANR'[o % 3]}', '{'OF'[o % 2]}', {day.format(1 + o % 4)})"
            for o in range(12) for n in (1, 2) for p, s, q, d, t in [(o % 3, o % 2, o, 0.097 if o == 4 else 0.05, 0.01), (7, "null", 1, "null", 0.08)]
        )
        + ", (99, null, 1, 1, 1, 1.0, 0.0, 0.0, null, null, null), (98, 1, 1, 1, 1, 1.0, 0.0, 0.0, 'A', 'O', null), (98, 1, 1, 1, 1, 1.0, 0.0, 0.0, 'A', 'O', null)"
        + " as t(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)"
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.sql(
        "select * from values (0, 'red widget', 'Brand#1', 'PROMO', 3, 9.5), (1, 'blue widget', 'Brand#25', 'SMALL', 30, 8.5), (7, null, null, 'SMALL', null, null),"
        " (1, 'blue widget', 'Brand#25', 'SMALL', 30, 8.5) as t(p_partkey, p_name, p_brand, p_type, p_size, p_retailprice)"
    ).write.parquet(f"{folder}/part.parquet")
    return Lake(spark, folder)


def test_lines_ranked_before_their_part_is_joined_give_the_rows_of_the_sql(spark, folder):
    lake = _given(spark, folder)
    for name in ("item_details", "item_price_snapshots"):
        want = lake.sql(INPUT_SQL[name])
        got = lake.silver(name).select(*want.columns)
        assert got.dtypes == want.dtypes and want.count() > 5
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_lines_are_ranked_without_the_columns_of_their_part(spark, folder):
    plan = WIDE_INPUTS["item_details"](_given(spark, folder))._jdf.queryExecution().optimizedPlan().toString()
    ranked = plan[plan.index("Window [row_number()") :].split("+- Filter isnotnull(p_partkey")[0]
    assert "permalink" not in ranked and "p_name" not in ranked.split("p_partkey")[0]


def test_a_staging_table_builds_only_the_star_tables_it_reads(spark, folder, monkeypatch):
    lake, built = _given(spark, folder), []
    stored = Lake.stored
    monkeypatch.setattr(Lake, "stored", lambda self, name, build: built.append(name) or stored(self, name, build))
    assert marts.staging(lake.star, "stg_categories").count() == 3  # one without a name
    assert set(built) == {"categories", "dim_category"}
    assert list(lake.star) == list(star.STAR)


def test_rows_of_a_key_that_comes_once_are_not_sent(spark, folder, monkeypatch):
    once = spark.range(500).selectExpr("cast(id as string) as k", "1 as ts", "id as v")
    twice = once.unionAll(spark.sql("select '7' as k, 0 as ts, 9L as v union all select '7', null, 1L union all select null, 1, 2L union all select null, 0, 3L"))
    for n, df in enumerate((once, twice)):
        df.write.parquet(f"{folder}/{n}")
    once, twice = (spark.read.parquet(f"{folder}/{n}") for n in (0, 1))
    assert "Window" not in dedup.keep_first_of_rare(once, ["k"], "ts", ["v"])._jdf.queryExecution().optimizedPlan().toString()
    for limit in (dedup.RARE, 1):
        monkeypatch.setattr(dedup, "RARE", limit)
        got = {r["k"]: r["v"] for r in rows(dedup.keep_first_of_rare(twice, ["k"], "ts", ["v"]))}
        assert got["7"] == 9 and got[None] == 3 and got["8"] == 8 and len(got) == 501
        assert dedup.keep_first_of_rare(twice, ["k"], "ts", ["v"]).count() == 501


def _exchanged(df):
    """The plan as run: lines of exchanges that deal rows by hash."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in final.splitlines() if "Exchange hashpartitioning" in line]


def test_lines_are_dealt_by_part_before_they_are_ranked(spark, folder, monkeypatch):
    lake = _given(spark, folder)
    plan = WIDE_INPUTS["item_details"](lake)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [l_partkey") == 1
    monkeypatch.setattr(inputs, "HOT_PART", 3)  # each part has more
    for name in ("item_details", "item_price_snapshots"):
        got, want = WIDE_INPUTS[name](lake), lake.sql(INPUT_SQL[name])
        assert "RepartitionByExpression" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_groups_of_a_seller_are_counted_after_one_shuffle(spark, folder, monkeypatch):
    items = spark.sql(
        "select * from values ('a', 's', 'c', 'active', 1.5D, 1L, 2L), ('a', 's', 'c', 'active', 2.5D, 0L, 1L), ('b', 's', 'c', null, null, null, 0L),"
        " ('b', null, 'c', 'paused', 3.0D, 4L, 0L), (null, null, null, null, 1.0D, 1L, 1L)"
        " as t(item_id, seller_id, category_id, status, price, available_quantity, sold_quantity)"
    ).withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp"))
    items.write.parquet(f"{folder}/items")
    items = spark.read.parquet(f"{folder}/items")
    one = gold.gold_seller_item_metrics(items)
    got = sorted(map(str, rows(one)))
    assert len(_exchanged(one)) == 1 and len(got) == 4
    monkeypatch.setattr(gold, "HOT_SELLER", 1)
    assert sorted(map(str, rows(gold.gold_seller_item_metrics(items)))) == got


def test_rows_of_keys_that_are_not_hot_are_sent_once(spark, folder):
    spark.range(2000).selectExpr("cast(id % 50 as string) as k", "timestamp_seconds(id) as t", "id as v").write.parquet(f"{folder}/t")
    df = previous.with_previous(spark.read.parquet(f"{folder}/t"), "k", "t", {"p": "v"})
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rightHint=(strategy=broadcast)") >= 2
    assert all(r["p"] == (r["v"] - 50 if r["v"] >= 50 else None) for r in rows(df))


def test_broken_payloads_are_those_of_the_json_kind(spark):
    df = spark.sql("select * from values ('{\"a\":1}'), ('[1]'), ('3'), ('null'), ('{'), (''), ('x y'), (null) as t(payload)")
    kind = payload.json_kind(F.col("payload")) == "invalid"
    got = rows(df.select("payload", F.coalesce(kind, F.lit(False)).alias("old"), payload.is_broken(F.col("payload")).alias("new")))
    assert all(r["old"] == r["new"] for r in got) and sum(r["new"] for r in got) >= 2


def test_bronze_tables_stand_where_the_pipeline_reads_them(spark, folder):
    lake = _given(spark, folder)
    assert lake.bronze("item_details").inputFiles()[0].removeprefix("file:").replace("///", "/").startswith(f"{lake.bronze_root}/parquet/item_details/")
    twice = lake.bronze("item_price_snapshots").groupBy("payload", "record_id").count()
    assert twice.filter("count % 2 <> 0").count() == 0 and bronze.scan_bronze(spark, lake.bronze_root, "item_price_snapshots").count() == lake.bronze("item_price_snapshots").count() > 0


def test_substrings_that_are_no_pieces_are_told_without_a_search(monkeypatch):
    table = pieces.Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    other = np.random.default_rng(1).integers(0, 1 << 64, 100_000, np.uint64)
    hashes, searched, search = np.concatenate([table.keys, other]), [], np.searchsorted
    plain = {int(k): int(i) for k, i in zip(table.keys, table.ids)}
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *more: searched.append(len(v)) or search(a, v, *more))
    assert table.find(hashes).tolist() == [plain.get(h, -1) for h in hashes.tolist()]
    assert len(table.keys) <= sum(searched) < len(table.keys) + 10_000


def test_the_collector_waits_while_texts_are_encoded(monkeypatch):
    encoder, seen = pieces.Encoder(pieces.Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))), []
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda words: seen.append(gc.isenabled()) or learn(words))
    assert encoder.encode(["two words", ""])[1] == b"" and seen == [False] and gc.isenabled()
    monkeypatch.setattr(encoder, "learn", lambda words: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        encoder.encode(["more"])
    assert gc.isenabled()


def test_substrings_that_end_together_are_looked_up_at_once(monkeypatch):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    table, plain, looked = pieces.Pieces.load(path), pieces.Pieces.load(path), []
    monkeypatch.setattr(table, "find", lambda hashes: looked.append(len(hashes)) or plain.find(hashes))
    monkeypatch.setattr(table, "may_follow", plain.may_follow)
    words = ["information", "strengthens", "xqzjkvwpzzq", "wo\u00e9\U0001f600nderfu", "\U0001f600" * 11, "\u00e9" * 11]
    words = [pieces.MARK + w[:10].ljust(10, "x") for w in words]
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    want = [np.array(model.encode(w.removeprefix(pieces.MARK)), "<u4").tobytes() for w in words]
    assert [bytes(ids) for ids in table.segment(words)] == want
    assert len(looked) == 11  # one for each end


def test_packing_remembers_few_words_and_those_that_come_again(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 100)
    ids, made = packing.WordIds(public_tokenizers.path("word_bpe_49k.json")), []
    simple = ids._simple
    monkeypatch.setattr(ids, "_simple", lambda word: made.append(word) or simple(word))
    texts = [" ".join(["common", *(f"word{chr(97 + n)}{chr(97 + k)}" for k in range(25))]).encode() for n in range(26)]
    first = [ids.encode([t])[0] for t in texts]
    assert made.count(b"common") == 1 and len(ids.known) <= 200
    assert first == packing.WordIds(public_tokenizers.path("word_bpe_49k.json")).encode(texts)


def _drifting(n):
    """Copies of copies with a word changed each time, and a tenth as many texts that share a passage with them only."""
    rng = np.random.default_rng(5)
    texts = [[f"w{i}" for i in range(150)]]
    while len(texts) < n:
        words = list(texts[rng.integers(len(texts))])
        words[rng.integers(150)] = f"x{len(texts)}"
        texts.append(words)
    return texts + [texts[0][:90] + [f"y{i}_{k}" for k in range(60)] for i in range(n // 10)]


def test_near_copies_are_dealt_in_proportion_to_their_number(spark, monkeypatch):
    dealt, candidates = spark.sparkContext.accumulator(0), near_duplicates._candidates

    def counting(*options):
        def run(batches):
            def told():
                for batch in batches:
                    dealt.add(batch.num_rows)
                    yield batch

            yield from candidates(*options)(told())

        return run

    monkeypatch.setattr(near_duplicates, "_candidates", counting)
    counts = []
    for n in (150, 600):
        words = _drifting(n)
        sets = [{tuple(w[k : k + 5]) for k in range(146)} for w in words]
        least = list(range(len(sets)))
        for a, s in enumerate(sets):
            near = {least[b] for b in range(a) if len(s & sets[b]) >= 0.8 * len(s | sets[b])} | {a}
            least = [min(near) if x in near else x for x in least]
        docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], "doc_id long, text string")
        before = dealt.value
        kept = near_duplicates.drop_near_duplicates(docs, leaf=40)
        assert sorted(r["doc_id"] for r in rows(kept)) == sorted(set(least))
        counts.append(dealt.value - before)
    assert counts[1] <= 6 * counts[0], counts
