"""Near duplicates by a MinHash LSH forest: sorted signature orders, neighbours with the longest common prefix.

A text's set holds the hashes of its distinct shingles; texts with equal sets form a class, and classes
are compared. A class has a signature of least hashes. Each tree orders the classes by a part of the
signature; classes next to one another in that order with a common prefix are a region. A region's depth
adapts to its density: the least depth at which it holds at most ``REGION`` classes, or else the deepest.
Two sets of similarity ``s`` share a tree's prefix of depth ``d`` with probability ``s ** d``, and trees
are added until the deepest prefix alone gives the target recall at the least similarity.

Signatures tell which pairs of a region are plausible; those are confirmed on full sets, a few trees
before the others, and only between components not yet connected. Denser regions
are first dealt to slices, each compared within itself. Then only their classes that are not yet connected
with the region's largest component are compared with the others, block by block, so that a large group of
near copies costs rows in proportion to its size, and no pair of different components goes unseen.

Edge cases: with fewer words than a shingle, the whole sequence is the only shingle; null and blank texts
have an empty set, are linked with nothing and are kept; repeated rows are copies of one another, and rows
that share the least id of a component are all kept; a row without id has a null component and is kept;
an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.components import components
from bazaarlens.llm.hashing import WORD_BASE, give_back, mix, slices, spans_hash, utf8, windows, word_hashes
from bazaarlens.llm.registry import query, table
from bazaarlens.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 2
SIMILARITY = 80  # percent
RECALL = 0.999
SHALLOW, DEEP = 2, 4  # least and greatest depth of a region
REGION = 1000  # classes compared with each other; also the size of a slice and of a block
EARLY = 3  # trees searched first; what they connect is not compared again in the others
ALIKE = 0.5  # share of a signature in common from which a pair is confirmed on full sets
HELD = 2 << 20  # words hashed at once
CELL = ("region", "i", "j")


def trees_for(recall: float, similarity: float, deep: int = DEEP) -> int:
    """Trees after which a pair of this similarity shares a region of the greatest depth with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**deep))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z folded."""
    for a, b in slices(offsets, HELD):
        hashes, firsts = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower=True)
        found = windows(hashes, firsts, SHINGLE)[0]
        begin = np.concatenate(([0], np.cumsum(np.maximum(np.diff(firsts) - SHINGLE + 1, 0))))
        for i, (lo, hi) in enumerate(zip(firsts[:-1], firsts[1:])):
            if 0 < hi - lo < SHINGLE:
                yield spans_hash(hashes[lo:hi], np.array([0]), np.array([hi - lo]), WORD_BASE)
            else:
                yield np.unique(found[begin[i] : begin[i + 1]])


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """For each of ``size`` hash functions the least value over a set, as 32 bits; zeros for an empty set."""
    seeds = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    odd, least = mix(seeds) | np.uint64(1), np.full(size, 2**64 - 1, np.uint64)
    if not len(shingles):
        return np.zeros(size, np.uint32)
    for lo in range(0, len(shingles), 1024):  # multiply, add, fold: a new order of the set for each function
        h = (shingles[lo : lo + 1024, None] + seeds) * odd
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(least, h.min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _orders(signatures: np.ndarray, trees: int, deep: int, shallow: int) -> np.ndarray:
    """For each set and tree, a hash of every prefix from the shallowest to the deepest."""
    label = signatures.reshape(len(signatures), trees, deep).astype(np.uint64)
    h = np.broadcast_to(mix(np.arange(1, trees + 1, dtype=np.uint64)), label.shape[:2])
    prefixes = []
    for depth in range(deep):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) ^ label[:, :, depth])
        prefixes.append(h)
    return np.stack(prefixes[shallow - 1 :], 2).view(np.int64)


def _key(s: np.ndarray) -> tuple[int, int, int]:
    """Two sums over a set that do not depend on order, and its size."""
    return (int(mix(s).sum().view(np.int64)), int(np.bitwise_xor.reduce(s).view(np.int64)), len(s)) if len(s) else (0, 0, 0)


def _describe(trees: int, deep: int, shallow: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            keys, signatures = [], []
            for s in shingle_sets(*utf8(batch["text"])):
                keys.append(_key(s))
                signatures.append(signature(s, trees * deep))
            n, depths = len(keys), deep - shallow + 1
            of = np.array(signatures, np.uint32).reshape(n, trees * deep)
            prefixes = pa.ListArray.from_arrays(np.arange(0, n * trees * depths + 1, depths, dtype=np.int32), pa.array(_orders(of, trees, deep, shallow).ravel()))
            orders = pa.ListArray.from_arrays(np.arange(0, n * trees + 1, trees, dtype=np.int32), prefixes)
            numbers = np.array(keys, np.int64).reshape(n, 3)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(np.arange(place, place + n)), *(pa.array(c) for c in np.ascontiguousarray(numbers.T)), pa.array([x.tobytes() for x in of], pa.binary()), orders],
                ["doc_id", "place", "k1", "k2", "n", "signature", "orders"],
            )
            place += n
        give_back()

    return describe


DESCRIBED = "doc_id long, place long, k1 long, k2 long, n long, signature binary, orders array<array<long>>"


def _regions(classes: DataFrame, depths: int, most: int, folder: str) -> DataFrame:
    """(rep, tree, region, m): the regions of two classes or more that each class is in, and their sizes; one for each tree at most.

    A class goes deeper in a tree only where its region there is too dense.
    """
    spark, found = classes.sparkSession, None
    here = classes.select("rep", F.posexplode("orders").alias("tree", "prefixes"))
    for d in range(1, depths + 1):
        here = here.withColumn("region", F.element_at("prefixes", d))
        here.groupBy("region").agg(F.count("*").alias("m")).filter("m > 1").write.parquet(f"{folder}/sizes{d}")
        sizes = spark.read.schema("region long, m long").parquet(f"{folder}/sizes{d}")
        here.join(sizes, "region").write.parquet(f"{folder}/depth{d}")
        here = spark.read.schema("region long, rep long, tree int, prefixes array<long>, m long").parquet(f"{folder}/depth{d}")
        settled = here.filter(F.col("m") <= most) if d < depths else here
        settled = settled.select("rep", "tree", "region", "m")
        found = settled if found is None else found.unionByName(settled)
        here = here.filter(F.col("m") > most).select("rep", "tree", "prefixes")
    return found


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one cell after another, from rows sorted by cell; cells of a single row are left out."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
        key = np.column_stack([rows[c].to_numpy() for c in CELL])
        begin = 0
        for stop in (np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist():
            if stop - begin > 1:
                yield rows.slice(begin, stop - begin)
            begin = stop
        rest = rows.slice(begin)
    if rest is not None and len(rest) > 1:
        yield rest


def _plausible(cell: pa.Table, trees: int, deep: int, similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a cell that may be linked and have no common region of the greatest depth in an earlier tree."""
    n, block, component = (cell[c].to_numpy() for c in ("n", "block", "component"))
    of = np.frombuffer(b"".join(cell["signature"].to_pylist()), np.uint32).reshape(len(cell), trees * deep)
    across, size = cell["i"][0].as_py() != cell["j"][0].as_py(), of.shape[1]
    tree = int(cell["tree"][0].as_py())
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for a in range(len(cell) - 1):
        b = np.arange(a + 1, len(cell))
        ok = (component[b] != component[a]) & (100 * np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b]))
        b = b[ok & (block[b] != block[a])] if across else b[ok]
        same = of[b] == of[a]
        ok = same.sum(1) >= ALIKE * size
        if tree:
            ok &= ~same[:, : tree * deep].reshape(len(b), tree, deep).all(2).any(1)
        found.append((np.full(int(ok.sum()), a), b[ok]))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _candidates(trees: int, deep: int, similarity: int):
    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The classes of each cell that have a plausible partner in it."""
        for cell in _cells(batches):
            a, b = _plausible(cell, trees, deep, similarity)
            if len(a):
                yield from cell.take(pa.array(np.union1d(a, b))).combine_chunks().to_batches()

    return candidates


class Sets:
    """Classes connected so far, by place; each connection found is kept once."""

    def __init__(self, n: int):
        self.root, self.links = np.arange(n), []

    def link(self, a: int, others: np.ndarray) -> None:
        joined = np.isin(self.root, np.append(self.root[others], self.root[a]))
        self.links += [(a, int(b)) for b in others]
        self.root[joined] = self.root[joined].min()


def _confirm(trees: int, deep: int, similarity: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of each cell that connect its classes; pairs connected already are not compared."""
        for cell in _cells(batches):
            a, b = _plausible(cell, trees, deep, similarity)
            sets = [np.frombuffer(s, np.uint64) for s in cell["shingles"].to_pylist()]
            known, rep = Sets(len(cell)), cell["rep"].to_numpy()
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            begins = np.flatnonzero(np.diff(a, prepend=-1))
            for lo, hi in zip(begins, np.append(begins[1:], len(a))):
                own = int(a[lo])
                others = b[lo:hi][known.root[b[lo:hi]] != known.root[own]]
                while len(others):  # one of each component at a time is enough
                    first = np.unique(known.root[others], return_index=True)[1]
                    tried = others[first]
                    common = np.array([len(np.intersect1d(sets[own], sets[x], assume_unique=True)) for x in tried])
                    both = np.array([len(sets[x]) for x in tried]) + len(sets[own]) - common
                    linked = tried[100 * common >= similarity * both]
                    if len(linked):
                        known.link(own, linked)
                    others = np.delete(others, first)
                    others = others[known.root[others] != known.root[own]]
            if known.links:
                u, v = np.array(known.links).T
                yield pa.RecordBatch.from_arrays([pa.array(rep[u]), pa.array(rep[v])], ["u", "v"])

    return confirm


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(*utf8(batch["text"])))
        keys = np.array([_key(s) for s in sets], np.int64).reshape(len(sets), 3)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(c) for c in np.ascontiguousarray(keys.T)), pa.array([s.tobytes() for s in sets], pa.binary())],
            ["doc_id", "k1", "k2", "n", "shingles"],
        )


class Forest:
    """The written tables of one run over ``rows`` (doc_id, text)."""

    def __init__(self, rows: DataFrame, similarity: int, recall: float, region: int, shallow: int, deep: int):
        self.rows, self.spark, self.folder = rows, rows.sparkSession, scratch_path(rows.sparkSession, "forest")
        self.similarity, self.region, self.shallow, self.deep = similarity, region, shallow, deep
        self.trees = trees_for(recall, similarity / 100, deep)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path, schema = f"{self.folder}/{name}", df.schema
        df.write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def beside(self, df: DataFrame) -> DataFrame:
        """A written table, sent to every task where it has few rows; else Spark shuffles."""
        return F.broadcast(df) if df.count() <= 1_000_000 else df

    def links(self, cells: DataFrame, name: str) -> DataFrame:
        """(u, v): confirmed links among the rows (rep, component, region, tree, i, j, block) of each cell."""
        cells = cells.join(self.classes.select("rep", "n", "signature"), "rep").repartition(*CELL).sortWithinPartitions(*CELL)
        found = cells.mapInArrow(_candidates(self.trees, self.deep, self.similarity), cells.schema)
        found = self.written(found, f"{name}/candidates")
        wanted = found.select("rep").distinct().join(self.classes.select("rep", "doc_id", "k1", "k2", "n"), "rep")
        wanted = self.written(wanted, f"{name}/wanted")
        texts = self.rows.join(self.beside(wanted.select("doc_id").distinct()), "doc_id", "left_semi")
        sets = texts.mapInArrow(_whole_sets, "doc_id long, k1 long, k2 long, n long, shingles binary")
        sets = sets.join(self.beside(wanted), ["doc_id", "k1", "k2", "n"]).select("rep", "shingles").dropDuplicates(["rep"])
        pairs = found.join(sets, "rep").repartition(*CELL).sortWithinPartitions(*CELL)
        return self.written(pairs.mapInArrow(_confirm(self.trees, self.deep, self.similarity), "u long, v long"), f"{name}/links")

    def named(self, *links: DataFrame) -> DataFrame:
        """(rep, component) of every class that a link connects with another."""
        edges = links[0]
        for more in links[1:]:
            edges = edges.unionByName(more)
        return components(edges).withColumnRenamed("node", "rep")

    def sliced(self, regions: DataFrame) -> DataFrame:
        """Every class in one slice of each of its regions; a region that is not dense is one slice."""
        part = F.pmod(F.xxhash64("rep", "region"), F.ceil(F.col("m") / self.region).cast("int")).cast("int")
        return regions.select("rep", "component", "region", "tree", part.alias("i"), part.alias("j"), F.lit(0).alias("block"))

    def between(self, regions: DataFrame, named: DataFrame) -> DataFrame:
        """Pairs of blocks of dense regions that hold several components. The largest component's classes meet only the others."""
        dense = with_component(regions.filter(F.col("m") > self.region), named)
        dense = self.written(dense.select("rep", "region", "tree", "component"), "dense")
        sizes = dense.groupBy("region", "component").agg(F.count("*").alias("size"))
        sizes = sizes.groupBy("region").agg(F.max(F.struct("size", "component")).alias("main"), F.sum("size").alias("m"))
        sizes = sizes.filter(F.col("main.size") < F.col("m")).select("region", "main", (F.col("m") - F.col("main.size")).alias("others"))
        rows = dense.join(self.written(sizes, "mixed"), "region")
        inner, outer = (F.ceil(x / self.region).cast("int") for x in (F.col("main.size"), F.col("others")))
        own = F.col("component") == F.col("main.component")
        draw = F.xxhash64("rep", "region")
        rows = rows.withColumn("block", F.when(own, F.pmod(draw, inner)).otherwise(inner + F.pmod(draw, outer)).cast("int"))
        meets = F.when(own, F.sequence(inner, inner + outer - 1)).otherwise(F.sequence(F.lit(0), inner + outer - 1))
        rows = rows.withColumn("other", F.explode(meets))
        return rows.select("rep", "component", "region", "tree", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block")

    def run(self) -> DataFrame:
        keys = ["k1", "k2", "n"]
        described = self.written(self.rows.mapInArrow(_describe(self.trees, self.deep, self.shallow), DESCRIBED), "described")
        least = described.filter("n > 0 and doc_id is not null").groupBy(*keys).agg(F.min(F.struct("doc_id", "place")).alias("r"))
        least = self.written(least.select(F.col("r.place").alias("rep")), "least")
        # a class is known by the place of its least row, and described by that row
        first = described.withColumnRenamed("place", "rep").join(self.beside(least), "rep")
        self.classes = self.written(first.select("rep", "doc_id", *keys, "signature", "orders"), "classes")

        regions = _regions(self.classes.select("rep", "orders"), self.deep - self.shallow + 1, self.region, self.folder)
        early = F.col("tree") < EARLY
        one = self.links(self.sliced(regions.filter(early).withColumn("component", F.col("rep"))), "early")
        two = self.links(self.sliced(with_component(regions.filter(~early), self.named(one))), "late")
        three = self.links(self.between(regions, self.named(one, two)), "dense")

        classes, named = self.classes.select("rep", "doc_id", *keys), self.named(one, two, three)
        told = classes.join(named, "rep")
        told = told.groupBy("component").agg(F.min("doc_id").alias("component_id")).join(told.select("component", *keys), "component")
        told = classes.select(F.col("doc_id").alias("copy_of"), *keys).join(told.drop("component"), keys, "left")
        told = told.select(*keys, F.coalesce("component_id", "copy_of").alias("component_id"))
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        found = described.select("doc_id", *keys).join(told, keys, "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
        return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def with_component(regions: DataFrame, named: DataFrame) -> DataFrame:
    return regions.join(named, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def near_duplicate_components(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: int = SIMILARITY,
    recall: float = RECALL,
    region: int = REGION,
    shallow: int = SHALLOW,
    deep: int = DEEP,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row; ``similarity`` in percent, ``recall`` at that similarity."""
    rows = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return Forest(rows, similarity, recall, region, shallow, deep).run()


@query("op12_lsh_forest")
def lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near duplicates, and whether it is the one that stays."""
    return near_duplicate_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
