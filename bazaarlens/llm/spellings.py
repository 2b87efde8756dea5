"""Spelling variants: words one insertion, deletion or replacement apart, grouped under the commoner form.

Words are counted over all documents in Spark. Of two words whose longer one has ``M`` code points, one
edit leaves a common prefix and suffix of together ``M - 1`` or more. ``M`` is cut into segments of two;
the edit lies in one of them, and both words have the same code points before and after it. Each word goes
to the tile of every segment, for its own length and the next. Within a tile padded code-point matrices of
two blocks of words are compared densely: prefix plus suffix tell a near pair, and the segment that the
common prefix ends in tells the one tile that counts it, so no pair is listed or counted twice. A tile
holds no more words than two letters allow; where words of over 64 code points have longer segments, a
tile of more than ``BLOCK`` words is cut into blocks, every pair of blocks a cell of its own.

Edge cases: a null text has no words; a row without id is numbered by the empty text; words of two rows
with one id are counted like any others; a word with two equally common near words takes the smaller; an
empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.registry import query, table
from bazaarlens.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_LENGTH = 7
LEAST_COUNT = 2
DELETE_IN = 31  # one in so many runs loses a code point
MARGIN = 10  # a form is at least so many times as common as its variant
SEGMENT = 2  # code points among which the edit is sought; all others agree in a tile
SEGMENTS = 32  # at most, so that very long words do not go to ever more tiles
BLOCK = 2048  # words of a block
TILE = 1 << 22  # code points compared at once
SMALL = 64  # words of a tile compared together with other tiles
CHUNK = 40_000  # rows held by a task
CELL = ("longer", "tile", "i", "j")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): every run of letters of enough length, as the draw of its document leaves it, and how often it occurs."""
    runs = df.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"),
    ).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    drawn = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = drawn.select(F.when(F.col("h") % DELETE_IN == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def _tiles(words: DataFrame) -> DataFrame:
    """(word, n, longer, first, last, tile): a row for each segment a word may be edited in, as the longer or shorter of a pair."""
    longer = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longer")
    parts = F.least(F.ceil(F.col("longer") / SEGMENT), F.lit(SEGMENTS)).cast("int")
    rows = words.select("word", "n", longer).select("*", parts.alias("parts"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("k"))
    first, last = (F.floor(x * F.col("longer") / F.col("parts")).cast("int") for x in (F.col("k"), F.col("k") + 1))
    rows = rows.select("word", "n", "longer", first.alias("first"), last.alias("last"))
    before = F.substr("word", F.lit(1), F.col("first"))
    after = F.substr("word", F.length("word") - F.col("longer") + F.col("last") + 1)
    return rows.select("*", F.xxhash64("longer", "first", before, after).alias("tile"))


def _cells(tiles: DataFrame, block: int) -> DataFrame:
    """Deal the words of each tile to pairs of blocks.

    Segments of two code points bound a tile by the alphabet; only the longer segments of very long words
    leave tiles whose size has to be looked up.
    """
    one, bounded = F.lit(0), F.col("longer") <= SEGMENT * SEGMENTS
    short = tiles.filter(bounded).select("*", one.alias("block"), one.alias("i"), one.alias("j"))
    long = tiles.filter(~bounded)
    sizes = long.groupBy("tile").agg(F.count("*").alias("m")).filter("m > 1")
    blocks = F.ceil(F.col("m") / block).cast("int")
    long = long.join(sizes, "tile").withColumn("block", F.pmod(F.xxhash64("word"), blocks).cast("int"))
    long = long.withColumn("other", F.explode(F.sequence(one, blocks - 1)))
    long = long.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    return short.unionByName(long.select(short.columns))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole cells, some ten thousand rows at a time, from rows sorted by cell."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= CHUNK:
            rows = pa.Table.from_batches(held)
            key = np.column_stack([rows[c].to_numpy() for c in CELL])
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(1))
            if len(cuts):
                stop = int(cuts[-1]) + 1
                yield rows.slice(0, stop)
                held = rows.slice(stop).to_batches()
                n = len(rows) - stop
    if n:
        yield pa.Table.from_batches(held)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as rows of code points, padded at the end and padded at the start, and their lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    width = int(lengths.max(initial=0))
    left, right = np.zeros((2, len(words), width), np.uint32)
    left[row, column] = points
    right[row, width - lengths[row] + column] = points
    return left, right, lengths


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many leading columns ``a`` and ``b`` agree."""
    apart = a != b
    return np.where(apart.any(-1), apart.argmax(-1), apart.shape[-1])


class Rows:
    """The rows of some cells, and the pairs among them that are one edit apart and settled here."""

    def __init__(self, rows: pa.Table):
        self.left, self.right, self.lengths = code_points(rows["word"].to_pylist())
        self.longer, self.first, self.last, self.block = (rows[c].to_numpy() for c in ("longer", "first", "last", "block"))
        self.across = rows["i"].to_numpy() != rows["j"].to_numpy()

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the rows ``a`` are near the rows ``b``, arrays of one shape or shapes that broadcast."""
        start = _agreeing(self.left[a], self.left[b])
        end = _agreeing(self.right[a][..., ::-1], self.right[b][..., ::-1])
        longer = np.maximum(self.lengths[a], self.lengths[b])
        ok = (longer == self.longer[a]) & (longer == self.longer[b]) & (start + end >= longer - 1)
        return ok & (self.first[a] <= start) & (start < self.last[a]) & (~self.across[a] | (self.block[a] != self.block[b]))

    def small(self, begins: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs in many small cells at once: every row with the one so many places further, while the cell lasts."""
        rows = np.repeat(begins, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left = np.repeat(begins + sizes, sizes) - rows  # rows from here to the end of the cell
        for step in range(1, int(sizes.max(initial=0))):
            a = rows[left > step]
            ok = self.near(a, a + step)
            yield a[ok], a[ok] + step

    def large(self, begin: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs in one large cell, block of rows against block of rows."""
        rows, side = np.arange(begin, begin + size), max(1, int((TILE / max(1, self.left.shape[1])) ** 0.5))
        for lo in range(0, size, side):
            for at in range(lo, size, side):
                a, b = rows[lo : lo + side, None], rows[None, at : at + side]
                x, y = np.nonzero(self.near(a, b) & (a < b))
                yield rows[lo + x], rows[at + y]

    def pairs(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cuts = np.cumsum(sizes) - sizes
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)), *self.small(cuts[sizes <= SMALL], sizes[sizes <= SMALL])]
        for begin, size in zip(cuts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
            found += self.large(begin, size)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word with near words in a cell: how many, and the commonest, smallest first."""
    for rows in _chunks(batches):
        key = np.column_stack([rows[c].to_numpy() for c in CELL])
        cuts = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1))
        sizes = np.diff(np.append(cuts, len(key)))
        rows, sizes = rows.filter(pa.array(np.repeat(sizes > 1, sizes))).combine_chunks(), sizes[sizes > 1]
        a, b = Rows(rows).pairs(sizes)
        if not len(a):
            continue
        own, other = np.concatenate((a, b)), np.concatenate((b, a))
        n, words = rows["n"].to_numpy()[other], rows["word"].take(pa.array(other)).to_pylist()
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))  # Python compares by code point
        order = np.lexsort((rank, -n, own))
        begins = np.flatnonzero(np.diff(own[order], prepend=-1))
        best = order[begins]
        yield pa.RecordBatch.from_arrays(
            [
                rows["word"].take(pa.array(own[best])).combine_chunks(),
                pa.array(np.diff(np.append(begins, len(order))).astype(np.int64)),
                pa.array([words[x] for x in best.tolist()]),
                pa.array(n[best]),
            ],
            ["word", "n_near", "best", "best_n"],
        )


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best, best_n) for every word with near ones among ``words`` (word, n)."""
    cells = _cells(_tiles(words), block).repartition(*CELL).sortWithinPartitions(*CELL)
    told = cells.mapInArrow(_compare, "word string, n_near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return told.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.best").alias("best"), (-F.col("b.less")).alias("best_n")
    )


def _roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root) for every word with a form. Each round doubles the steps taken; counts grow tenfold a step, so rounds are few."""
    spark, schema = forms.sparkSession, "word string, root string"
    forms.select("word", F.col("form").alias("root")).write.parquet(f"{folder}/0")
    turn = 0
    while True:
        roots = spark.read.schema(schema).parquet(f"{folder}/{turn}")
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if not roots.join(further, "root", "left_semi").head(1):
            return roots
        turn += 1
        roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")).write.parquet(f"{folder}/{turn}")


def spelling_variants(df: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every counted word."""
    spark, folder = df.sparkSession, scratch_path(df.sparkSession, "spellings")
    count_words(df, key, text).write.parquet(f"{folder}/words")
    words = spark.read.schema("word string, n long").parquet(f"{folder}/words")
    common = F.col("best_n") >= MARGIN * F.col("n")
    told = words.join(near_words(words, block), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(common, F.col("best")).alias("form"),
        F.when(common, F.col("best_n")).alias("form_n"),
    )
    told.write.parquet(f"{folder}/forms")
    told = spark.read.schema("word string, n long, n_near long, form string, form_n long").parquet(f"{folder}/forms")
    roots = _roots(told.filter("form is not null"), f"{folder}/roots")
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query("op13_spelling_variants")
def spelling_variants_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form and root."""
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))
