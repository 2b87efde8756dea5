"""The forest, spelling variants and fill-in-middle against plain versions, and their edge cases."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import spellings
from bazaarlens.llm.forest import near_duplicate_components
from bazaarlens.llm.middle import fill_in_middle, restored, token_ends
from bazaarlens.llm.registry import QUERIES
from bazaarlens.llm.spellings import spelling_variants

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DATA = "/root/testdata/sf0.001"
CLASH = "doc_id long, text string, n string, form string, word string, rep string, region string, cut string, tile string"
TEXTS = [(1, "Some Words here"), (1, "Some Words here"), (2, None), (3, ""), (4, " \n\t"), (5, "word"), (5, "other"), (None, "some words HERE"), (None, None)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(i, t, *"abcdefg") for i, t in TEXTS], CLASH)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()


# near duplicates


def components_of(rows):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
        sets.append(frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset(words))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None:
                common = len(sets[a] & sets[b])
                if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return sorted((str(i), len(sets[a]), str(None if i is None else least[find(a)]), i is None or least[find(a)] == i) for a, (i, _) in enumerate(rows))


def got_components(df, **options):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_duplicate_components(df, **options).collect())


def test_forest_equals_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents]
    found = QUERIES["op12_lsh_forest"](spark, DATA).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in found) == components_of(rows)


def test_a_dense_region_is_sliced_and_loses_no_component(spark):
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in rnd.sample(range(60), i % 5):
            words[at] = f"x{i}_{at}"
        rows.append((1000 - i, " ".join(words)))
    # a chain: each is near to the one before only
    chain = list(base)
    for i in range(8):
        chain = chain[4:] + [f"c{i}_{k}" for k in range(4)]
        rows.append((2000 + i, " ".join(chain)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = components_of(rows)
    assert 1 < len({c for _, _, c, _ in want}) < 150
    assert got_components(df, region=12) == want
    assert got_components(df) == want


def test_forest_edges(spark, edges):
    assert got_components(edges) == components_of(TEXTS)
    assert near_duplicate_components(edges.limit(0)).count() == 0
    assert near_duplicate_components(edges).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rnd = random.Random(1)
    long = " ".join("abcdefgh"[rnd.randrange(8)] * rnd.randint(1, 9) + str(rnd.randrange(999)) for _ in range(40_000))
    rows = [(1, long), (2, long + " end"), (3, "x" * 50_000), (4, "x" * 50_000)]
    assert got_components(spark.createDataFrame(rows, "doc_id long, text string")) == components_of(rows)


# spelling variants


def variants_of(rows):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        short, long = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))

    nears = {w: [v for v in n if near(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in nears.items() if v}
    form = {w: b for w, b in best.items() if n[b] >= 10 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n[w], len(nears[w]), n.get(form.get(w))) for w in n)


def key(rows):
    return sorted(rows, key=lambda r: r[0])


def got_variants(df, **options):
    return key((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(df, **options).collect())


def test_variants_equal_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents if r.doc_id % 4 == 0]
    got = got_variants(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == key(variants_of(rows))
    assert any(r[4] for r in got)


def test_chains_ties_accents_and_very_long_words(spark, monkeypatch):
    def many(word, n):
        return [(7, " ".join([word] * n))]

    long = "ab" * 70
    rows = many("abcdefg", 2) + many("abcdefgh", 40) + many("abcdefghi", 900) + many("bbcdefg", 2) + many("cbcdefg", 2) + many("ÀÉÎÕÜçñ", 3)
    rows += many("àÉÎÕÜçñ", 30) + many("ÀÉÎÕÜçñ×", 30) + many(long, 2) + many(long[:50] + "x" + long[51:], 50) + many(long[:-1], 3) + many("x" + long, 2)
    rows += many("Straße-Straßen", 3) + many("aaaaaaa", 2) + many("aaaaaaaa", 2) + many("aaaaaaaaa", 21)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = key(variants_of(rows))
    assert any(r[1] and r[2] != r[1] for r in want)
    assert got_variants(df) == want
    assert got_variants(df, block=2) == want
    monkeypatch.setattr(spellings, "SMALL", 1)
    monkeypatch.setattr(spellings, "TILE", 40)
    assert got_variants(df, block=3) == want


def test_variants_edges(spark, edges):
    assert got_variants(edges) == key(variants_of(TEXTS))
    assert spelling_variants(edges.limit(0)).collect() == []
    repeated = [(1, "repeated letters"), (1, "repeated letters"), (None, "repeated lettters repeated"), (2, None)]
    assert got_variants(spark.createDataFrame(repeated, "doc_id long, text string")) == key(variants_of(repeated))


# fill in middle


def transformed(i, text):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    one, two, three = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(tokens), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(tokens), "spm", len(one), len(two), f"<S>{three}<P>{one}<M>{two}"
    return len(tokens), "psm", len(one), len(two), f"<P>{one}<S>{three}<M>{two}"


def test_middle_equals_brute_force_and_restores(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents] + TEXTS
    rows += [(i, t) for i in range(60) for t in ("a<P>b", "x<S", "<", "<M<S<P", "é😀漢 z\n\r\x00 end", "ab" * 30, "P>S>M>", "<<SS>")]
    found = fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"))
    found = found.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(str, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found))) == sorted(
        map(str, ((i, *transformed(i, t)) for i, t in rows))
    )
    assert collections.Counter(r.back for r in found) == collections.Counter(t or "" for _, t in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_middle_edges(spark, edges):
    found = fill_in_middle(edges)
    assert found.columns == ["doc_id", "text", "word", "rep", "region", "cut", "tile", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert found.count() == len(TEXTS) and {r.cut for r in found.collect()} == {"f"}
    assert fill_in_middle(edges.limit(0)).count() == 0


def test_long_texts_are_matched_in_parts():
    rnd = random.Random(2)
    for text in ("", "a", "abc" * 40, "".join(rnd.choice("ab C1é\n") for _ in range(900)), "x" * 50 + "1" + "y" * 70):
        want = [m.end() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", text)]
        for part in (1, 2, 7, 64, 1 << 20):
            assert token_ends(text, part).tolist() == want


def test_middle_query_runs_over_the_whole_table(spark, documents):
    assert QUERIES["op11_fill_in_middle"](spark, DATA).count() == len(documents)
