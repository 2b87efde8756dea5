"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import fractions
import math
import random

import pytest
from pyspark.sql import functions as F

from bazaarlens.llm.language_model import score_texts
from bazaarlens.llm.licenses import find_licenses
from bazaarlens.llm.near_duplicates import drop_near_duplicates, near_duplicates
from bazaarlens.llm.packing import pack_documents
from bazaarlens.llm.personal_data import find_personal_data, redact
from bazaarlens.llm.pieces import decode_ids, encode_texts
from bazaarlens.llm.quality_rules import judge
from bazaarlens.llm.repeats import remove_repeats
from bazaarlens.llm.top_k import search_top_k
from bazaarlens.llm.toxicity import score_toxicity

CLASH = "doc_id long, text string, lang string, score string, n_words string, spans string, batch string, bucket string, rep string, leaf string, row string, kept string"
rnd = random.Random(5)
LONG = " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 6) for _ in range(60_000))
PLAIN = "the cat and the dog went to the old mill by the river and slept there until noon came again"
TEXTS = [
    (1, PLAIN),
    (2, PLAIN),
    (2, PLAIN),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "word"),
    (7, LONG),
    (None, PLAIN),
    (None, None),
    (8, "é ▁ 漢字   x y 😀 no-break"),
    (9, "x" * 30_000),
    (10, PLAIN.replace("noon", "dusk")),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(i, t, "en", *"abcdefghi") for i, t in TEXTS], CLASH)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], CLASH)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (2, None), (7, 0), (8, 1), (99, 1), (None, 1), (10, 5)], "doc_id long, toxic int")


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_empty_tables(spark, nothing, labels):
    assert score_toxicity(nothing, labels).count() == 0
    assert near_duplicates(nothing).count() == 0
    assert drop_near_duplicates(nothing).columns == nothing.columns
    assert remove_repeats(nothing).count() == 0
    assert find_licenses(nothing).count() == 0
    assert pack_documents(nothing).count() == 0
    assert score_texts(nothing, F.lit(True)).count() == 0
    assert redact(find_personal_data(nothing)).count() == 0
    assert encode_texts(nothing).count() == 0
    assert judge(nothing).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert search_top_k(vectors, F.col("vec_id") % 20 == 0).count() == 0


def test_toxicity(edges, labels):
    out = score_toxicity(edges, labels, bound=100)
    assert set(edges.columns) - {"score"} <= set(out.columns)
    rows = out.collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    none = score_toxicity(edges, labels.filter("toxic = 0")).collect()
    assert all(r["score"] == 0 and r["predicted"] == 0 for r in none)


def test_near_duplicates(edges):
    rows = by_id(near_duplicates(edges))
    assert sum(map(len, rows.values())) == len(TEXTS)
    assert [(r.class_id, r.n_links) for i in (1, 2) for r in rows[i]] == [(1, 2)] * 3
    assert all(r.class_id is None and r.n_links == 0 for r in rows[None])
    assert all((rows[i][0].class_id, rows[i][0].n_links) == (i, 0) for i in (3, 4, 5, 6, 7, 8, 9, 10))
    kept = drop_near_duplicates(edges)
    assert kept.columns == edges.columns
    assert kept.count() == len(TEXTS) - 2


def test_substring_dedup(edges):
    rows = by_id(remove_repeats(edges, batch_bytes=1000))
    assert all((r.n_words, r.n_removed, r.text) == (20, 20, "") for r in rows[2])
    assert [(r.n_removed, r.removed) for r in rows[1]] == [(0, [])]
    cut = rows[10][0]
    assert (cut.n_removed, cut.text, cut.lang) == (17, "dusk came again", "en")
    assert [(r.n_words, r.n_removed) for r in rows[None]] == [(20, 0), (0, 0)] or [(r.n_words, r.n_removed) for r in rows[None]] == [(0, 0), (20, 0)]
    assert rows[3][0].text is None and rows[4][0].text == "" and rows[7][0].n_words == 60_000
    assert rows[5][0].text == " \n\t "


def test_licenses(spark, edges):
    assert find_licenses(edges).count() == 0
    notice = "x y z\nThis work is licensed under the GNU General Public License, version 3. " + PLAIN
    df = spark.createDataFrame([(1, notice), (1, notice), (None, notice), (2, PLAIN + " " + PLAIN + " Released under the MIT License")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.license, r.containment) for r in find_licenses(df).collect()) == [
        (0, "gpl-3.0", 1.0), (1, "gpl-3.0", 1.0), (1, "gpl-3.0", 1.0), (2, "mit", 1.0),
    ]


def test_packing(edges):
    rows = pack_documents(edges, shard=4).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in TEXTS}
    assert all(r.length == 1 for r in rows if r.doc_id in (3, 4, 5))
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_language_model(edges):
    rows = by_id(score_texts(edges, F.col("doc_id") != 1, batch_bytes=1000))
    assert sum(map(len, rows.values())) == len(TEXTS)
    assert all(r.n_tokens == 1 for i in (3, 4, 5) for r in rows[i])
    assert all(r.score < 0 and r.base_score < 0 for v in rows.values() for r in v)
    assert rows[1][0].held_out and not rows[None][0].held_out
    unknown = score_texts(edges, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and abs(r.score) < 1e-9 * r.n_tokens + 1e-6 for r in unknown)


def test_personal_data(spark, edges):
    assert all(r.spans == [] for r in find_personal_data(edges).collect())
    text = "Mail a.b@c.example.org, a@b.c_x@d.ee; IBAN GB82 WEST 1234 5698 7654 32 or 4111-1111 1111 1111 é 010.1.2.255 +49 (30) 1234-567"
    out = redact(find_personal_data(spark.createDataFrame([(1, text, "q")], "doc_id long, text string, `__s` string"), out="found"), spans="found").first()
    kinds = [(s["kind"], text[s["start"] : s["end"]]) for s in out["found"]]
    assert kinds == [
        ("email", "a.b@c.example.org"), ("email", "a@b.c"), ("email", "_x@d.ee"), ("ip", "010.1.2.255"),
        ("card", "4111-1111 1111 1111"), ("phone", "+49 (30) 1234-567"), ("iban", "GB82 WEST 1234 5698 7654 32"),
    ]
    assert out["text"] == "Mail <EMAIL>, <EMAIL><EMAIL>; IBAN <IBAN> or <CARD> é <IP> <PHONE>"


def spans_of(spark, texts, kind):
    found = find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [[t[s["start"] : s["end"]] for s in r["spans"] if s["kind"] == kind] for r, t in zip(sorted(found, key=lambda r: r["doc_id"]), texts)]


def test_an_account_number_ends_where_its_country_says(spark):
    numbers = [
        "ES91 2100 0418 4502 0005 1332", "AT611904300234573201", "BE68 5390 0754 7034", "GB82 WEST 1234 5698 7654 32", "NO9386011117947",
        "DE89 3704 0044 0532 0130 00", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "FR14 2004 1010 0505 0001 3M02 606", "PL61109010140000071219812874",
    ]
    after = ["", " BIC CAIXESBB", " BIC BKAUATWW", " KBC bank", " Please pay", " ABCDEFGHIJKLMNOPQRSTUVWXYZ", " 12", ", and é"]
    texts = [f"é IBAN {n}{a}" for n in numbers for a in after] + [" ".join(numbers), "DE12 3456 " + numbers[0], "IBAN ES91 2100 0418 4502 0005 1333 BIC", numbers[1] + "X"]
    want = [[n] for n in numbers for _ in after] + [numbers, [numbers[0]], [], []]
    assert spans_of(spark, texts, "iban") == want


def test_a_local_phone_needs_no_hyphen(spark):
    texts = ["call 555.123.4567", "call (555) 123.4567 now", "call 555-123-4567", "call 555 123 4567"]
    assert spans_of(spark, texts, "local_phone") == [["555.123.4567"], ["(555) 123.4567"], ["555-123-4567"], []]


def test_pieces(edges):
    rows = decode_ids(encode_texts(edges.withColumn("id", F.monotonically_increasing_id())), out="again").collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r["again"] == (r["text"] or "").replace("▁", " ")
        assert bool(r["piece_ids"]) == bool(r["text"])


def test_quality(edges):
    rows = by_id(judge(edges))
    assert [r.kept for r in rows[1]] == [True]
    assert all(not r.kept and r.base_failed and r.n_words < 10 for i in (3, 4, 5, 6, 9) for r in rows[i])
    assert all(isinstance(r.n_words, int) for v in rows.values() for r in v)


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20, [1.0, 1.0]), (20, [1.0, 1.0]), (3, [1.0, 1.0]), (4, [1.0, 1.0]), (5, None), (6, []), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (9, [None, 1.0]), (None, [1.0, 1.0]), (10, [1.0]), (40, [-1.0, 0.5])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, score string, rank string")
    out = [(r.query_id, r["rank"], r.vec_id, r.score) for r in search_top_k(df, F.col("vec_id") % 20 == 0, k=3, group=2, block=1).collect()]
    first = [x for x in out if x[0] == 20]
    assert sorted({x[2:] for x in first}) == [(3, 8192), (4, 8192), (10, 4096)]
    # an empty vector is neither null nor holds a null: it counts as all zeros
    assert [x[2:] for x in sorted(x for x in out if x[0] == 40)][:2] == [(6, 0), (3, -2048)]
    none = spark.createDataFrame([(20, []), (1, []), (2, [])], "vec_id long, embedding array<float>")
    out = search_top_k(none, F.col("vec_id") % 20 == 0, k=3).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in out) == [(1, 1, 0), (2, 2, 0)]


def test_top_k_keeps_long_vectors(spark):
    draw = random.Random(8)
    sizes = [1.0, 2.0**21, 2.0**24, 2.0**26]
    vectors = [[0.0, *(draw.uniform(-1, 1) * sizes[i % 4] for _ in range(5))] for i in range(200)]
    vectors[0], vectors[20] = [2.0**70, 0.0, 0.0, 0.0, 0.0, 0.0], [0.0, 3e6, 1.0, 0.0, 0.0, 0.0]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    whole = [[math.floor(fractions.Fraction(x) * 64) for x in v] for v in vectors]
    got = {}
    for r in search_top_k(df, F.col("vec_id") % 20 == 0, k=7, group=32, block=4).collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    for q in range(0, 200, 20):
        want = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in enumerate(whole) if i != q)[:7]
        assert sorted(got[q]) == want
    far = spark.createDataFrame([(20, [2.0**30]), (3, [2.0**30]), (4, [-(2.0**30)])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="a score beyond a long"):
        search_top_k(far, F.col("vec_id") == 20, k=1).collect()
    least = spark.createDataFrame([(20, [2.0**30]), (3, [1.0]), (4, [-(2.0**30)])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.score) for r in search_top_k(least, F.col("vec_id") == 20, k=1).collect()] == [(3, 2**42)]


def test_near_duplicates_go_by_row(spark):
    long = " ".join(f"w{i}" for i in range(60))
    near = long.replace("w59", "x")
    other = " ".join(f"v{i}" for i in range(60))
    rows = [
        (1, long, "kept"), (1, long, "repeat"), (1, other, "clean, by the same id"),
        (2, near, "near copy"), (2, "five words that stay here", "clean"), (2, None, "null"), (2, "", "empty"), (2, "", "empty"),
        (3, near + " y", "near copy"), (None, long, "no id"), (4, other, "copy of the clean one"), (5, "alone", "clean"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held string").withColumnRenamed("held", "n")
    for leaf in (500, 2):
        kept = drop_near_duplicates(docs, leaf=leaf)
        assert kept.columns == ["doc_id", "text", "n"]
        got = sorted((r.doc_id or 0, r.text or "", r.n if r.doc_id != 1 else "") for r in kept.collect())
        assert got == sorted(
            [(1, long, ""), (1, other, ""), (2, "five words that stay here", "clean"), (2, "", "null"), (2, "", "empty"), (2, "", "empty"),
             (0, long, "no id"), (5, "alone", "clean")]
        )
