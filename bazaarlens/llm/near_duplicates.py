"""Similarity join of word shingle sets by chosen paths.

Texts with the same shingles form a class, and classes are joined. In each of several runs a set
samples about 1.6 of its shingles by a hash that all sets share and goes to the node of each; a node
of more than ``LEAF`` sets splits again on shingles sampled anew, up to three levels. Two sets of
similarity ``s`` meet in a run with a probability that follows from ``s`` and the sampling rate alone;
runs repeat until the target recall. Within a leaf all pairs are compared: by bottom-k sketches first,
then exactly on whole sets. A pair that meets in several leaves is settled in the least of them, so links
are counted once without listing pairs. To count links, large leaves are cut into blocks, and every pair of
blocks is a cell of its own. Where only classes are asked for, large leaves are dealt to slices, each compared
within itself; then only their sets not yet connected with the leaf's largest component are compared with the
others, so that a large group of near copies costs rows in proportion to its size, and no pair of different
components goes unseen. No bucket, partner or candidate is capped.

Edge cases: texts of fewer than five words have one shingle, all their words; null and blank texts
have none and stay alone without links; repeated rows are copies and link to each other; rows that
share an id are compared like any others; rows without id get a null class and no links; an empty table gives an
empty result. Other columns are kept by ``drop_near_duplicates``; ``near_duplicates`` returns its own.
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

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
RATE = 1.3  # shared shingles that two sets of the least similarity sample alike, in expectation
LEVELS = 3
LEAF = 500  # sets compared with each other without a further split; also the size of a block
SKETCH = 32  # least hashes of a set kept as its sketch
ALIKE = 0.55  # share of sketch hashes in common from which a pair is compared exactly
CHUNK = 2 << 20
BROADCAST_ROWS = 1_000_000  # of a written table of ids; some tens of MB


def runs_for(recall: float, rate: float = RATE, levels: int = LEVELS) -> int:
    """Runs after which a pair of the least similarity has met with probability ``recall`` even if every level splits."""
    meet = 1.0
    for _ in range(levels):
        meet = 1 - math.exp(-rate * meet)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for a, b in slices(offsets, CHUNK):
        hashes, firsts = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        found = windows(hashes, firsts, SHINGLE)[0]
        sizes = np.maximum(np.diff(firsts) - SHINGLE + 1, 0)
        begin = np.concatenate(([0], np.cumsum(sizes)))
        for i, (lo, hi) in enumerate(zip(firsts[:-1], firsts[1:])):
            if 0 < hi - lo < SHINGLE:
                yield spans_hash(hashes[lo:hi], np.array([0]), np.array([hi - lo]), WORD_BASE)
            else:
                yield np.unique(found[begin[i] : begin[i + 1]])


def _extend(shingles: np.ndarray, parents: np.ndarray, limit: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """For every node a set is in, the children it goes on to: place of the parent, and child."""
    h = mix(shingles[None, :] ^ parents[:, None])
    parent, at = np.nonzero(h <= limit)
    return parent, mix(h[parent, at] + parents[parent] * np.uint64(0x9E3779B97F4A7C15))


def tree(shingles: np.ndarray, seeds: np.ndarray, similarity: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """The nodes of a set level by level, each with the place of its parent, in the order of parents."""
    limit = np.uint64(min(2**64 - 1, int(RATE / (similarity * len(shingles)) * 2.0**64))) if len(shingles) else np.uint64(0)
    levels, nodes = [], seeds
    for _ in range(LEVELS):
        parent, nodes = _extend(shingles, nodes, limit)
        levels.append((parent, nodes))
    return levels


def _flat(trees: list[list[tuple[np.ndarray, np.ndarray]]]) -> pa.Array:
    """Each tree as one list of (node, above, level); ``above`` is the place of the parent in the list, -1 at the first level."""
    nodes, above, levels, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], []
    for t in trees:
        start = 0  # of the level before
        for level, (parent, own) in enumerate(t, 1):
            nodes.append(own)
            above.append((parent + start).astype(np.int32) if level > 1 else np.full(len(own), -1, np.int32))
            levels.append(np.full(len(own), level, np.int32))
            start += len(t[level - 2][1]) if level > 1 else 0
        sizes.append(sum(len(own) for _, own in t))
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    fields = [pa.array(np.concatenate(nodes).view(np.int64)), pa.array(np.concatenate(above)), pa.array(np.concatenate(levels))]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["node", "above", "level"]))


NODES = "array<struct<node:long,above:int,level:int>>"
DESCRIBED = f"doc_id long, place long, k1 long, k2 long, n long, sketch binary, nodes {NODES}"


def _key(s: np.ndarray) -> tuple[int, int, int]:
    """Two sums over a set that do not depend on order, and its size."""
    return int(mix(s).sum().view(np.int64)) if len(s) else 0, int(np.bitwise_xor.reduce(s).view(np.int64)) if len(s) else 0, len(s)


def _columns(sets: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array(c, pa.int64()) for c in zip(*map(_key, sets))] if sets else [pa.array([], pa.int64())] * 3


def _describe(runs: int, similarity: float):
    seeds = mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            sets, sketches, trees = [], [], []
            for s in shingle_sets(*utf8(batch["text"])):
                sets.append(s)
                sketches.append((s[:SKETCH] >> np.uint64(32)).astype("<u4").tobytes())
                trees.append(tree(s, seeds, similarity))
            places = pa.array(np.arange(place, place + len(sets)))
            place += len(sets)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], places, *_columns(sets), pa.array(sketches, pa.binary()), _flat(trees)],
                ["doc_id", "place", "k1", "k2", "n", "sketch", "nodes"],
            )
        give_back()

    return describe


def _beside(df: DataFrame) -> DataFrame:
    """A written table, sent to every task if it has at most ``BROADCAST_ROWS`` rows; else Spark shuffles."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _leaves(classes: DataFrame, leaf: int, folder: str) -> DataFrame:
    """(rep, leaf, m): the leaves of all paths that hold two sets or more, and how many they hold.

    Every set lists its nodes of all levels, so the rows do not depend on how sets cluster. A node counts
    if its parent was too large for a leaf, and is a leaf if it is small enough or of the last level.
    """
    spark = classes.sparkSession
    # no parent at the first level: a value that is no node, and not the same for all
    parent = lambda o: F.when(o.above >= 0, F.get("nodes", o.above).node).otherwise(F.bitwise_not(o.node))
    listed = F.transform("nodes", lambda o: F.struct(o.node.alias("node"), parent(o).alias("parent"), o.level.alias("level")))
    members = classes.select("rep", F.explode(listed).alias("o")).select("rep", "o.*")
    classes.select(F.explode("nodes.node").alias("node")).groupBy("node").agg(F.count("*").alias("m")).filter("m > 1").write.parquet(
        folder + "/sizes"
    )
    sizes = spark.read.schema("node long, m long").parquet(folder + "/sizes")
    large = sizes.filter(F.col("m") > leaf).select(F.col("node").alias("parent"), F.lit(True).alias("split"))
    paths = members.join(_beside(large), "parent", "left").filter("level = 1 or split").select("rep", "node", "level")
    ends = (F.col("m") <= leaf) | (F.col("level") == LEVELS)
    return paths.join(sizes, "node").filter(ends).select("rep", F.col("node").alias("leaf"), "m")


def _cells(rows: DataFrame, leaf: int) -> DataFrame:
    """Deal each leaf's sets to pairs of blocks; a leaf of one block is one cell."""
    blocks = F.ceil(F.col("m") / leaf).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep", "leaf"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")


def _sliced(rows: DataFrame, leaf: int) -> DataFrame:
    """Deal each leaf's sets to slices, every set to one; a leaf that is not large is one slice.

    Only leaves of one slice settle a pair for others, so that large ones connect as much as their slices hold.
    """
    rows = rows.withColumn("leaves", F.expr(f"transform(filter(own, o -> o.m <= {leaf}), o -> o.leaf)"))
    part = F.pmod(F.xxhash64("rep", "leaf"), F.ceil(F.col("m") / leaf).cast("int")).cast("int")
    return rows.withColumn("block", F.lit(0)).withColumn("i", part).withColumn("j", part)


def _between(rows: DataFrame, named: DataFrame, leaf: int, folder: str) -> DataFrame | None:
    """Pairs of blocks of large leaves that hold several components; None if no leaf does.

    The sets of a leaf's largest component meet only the others, which also meet each other.
    """
    spark = rows.sparkSession
    large = rows.filter(F.col("m") > leaf).join(named, "rep", "left")
    large.select("rep", "leaf", F.coalesce("component", "rep").alias("component")).write.parquet(folder + "/large")
    large = spark.read.schema("rep long, leaf long, component long").parquet(folder + "/large")
    sizes = large.groupBy("leaf", "component").agg(F.count("*").alias("size"))
    sizes = sizes.groupBy("leaf").agg(F.max(F.struct("size", "component")).alias("most"), F.sum("size").alias("m"))
    sizes.filter("most.size < m").select("leaf", "most.size", F.col("most.component").alias("main"), F.expr("m - most.size").alias("others")).write.parquet(
        folder + "/mixed"
    )
    mixed = spark.read.schema("leaf long, size long, main long, others long").parquet(folder + "/mixed")
    if mixed.isEmpty():
        return None
    inner, outer = (F.ceil(F.col(x) / leaf).cast("int") for x in ("size", "others"))
    own, draw = F.col("component") == F.col("main"), F.xxhash64("rep", "leaf")
    block = F.when(own, F.pmod(draw, inner)).otherwise(inner + F.pmod(draw, outer)).cast("int")
    meets = F.sequence(F.when(own, inner).otherwise(F.lit(0)), inner + outer - 1)
    cells = large.join(mixed, "leaf").withColumn("block", block).withColumn("other", F.explode(meets))
    return cells.select("rep", "component", "leaf", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one cell after another, from rows sorted by cell."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
        key = np.column_stack([rows[c].to_numpy() for c in ("leaf", "i", "j")])
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        start = 0
        for stop in cuts.tolist():
            if stop - start > 1:
                yield rows.slice(start, stop - start)
            start = stop
        rest = rows.slice(start)
    if rest is not None and len(rest) > 1:
        yield rest


def _unsettled(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that this cell has to settle: of this pair of blocks, of different components, and in no smaller leaf together."""
    leaf, i, j = (cell[c][0].as_py() for c in ("leaf", "i", "j"))
    block, component, n = cell["block"].to_numpy(), cell["component"].to_numpy(), len(cell)
    earlier = [{x for x in leaves if x < leaf} for leaves in cell["leaves"].to_pylist()]
    if n <= 24:
        apart = lambda a, b: component[a] != component[b] and (i == j or block[a] != block[b]) and earlier[a].isdisjoint(earlier[b])
        ok = [(a, b) for a in range(n) for b in range(a + 1, n) if apart(a, b)]
        pairs = np.array(ok, np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]
    names = {x: k for k, x in enumerate(sorted(set().union(*earlier)))}
    inside = np.zeros((n, len(names)), np.float32)
    for a, own in enumerate(earlier):
        inside[a, [names[x] for x in own]] = 1
    apart = np.triu(inside @ inside.T == 0, 1) & (component[:, None] != component)
    if i != j:
        apart &= block[:, None] != block[None, :]
    return np.nonzero(apart)


def _overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Elements in common of each pair of sorted sets; all pairs at once where there are many."""
    if len(a) < 8 * len(sets):
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a.tolist(), b.tolist())], np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = uses[place] > 1
    columns = np.cumsum(uses > 1) - 1
    owner, place = owner[shared], columns[place[shared]]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(columns[-1]) + 1 if len(columns) else 0, 4096):
        here = (place >= lo) & (place < lo + 4096)
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[here], place[here] - lo] = 1
        total += part @ part.T
    return total[a, b].astype(np.int64)


def _plausible(sketches: list[np.ndarray], n: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float):
    """Pairs whose sizes and sketches allow the similarity."""
    near = np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b])
    a, b = a[near], b[near]
    if not len(a):
        return a, b
    enough = _overlaps(sketches, a, b) >= ALIKE * np.minimum(SKETCH, np.maximum(n[a], n[b]))
    return a[enough], b[enough]


CELL = ["leaf", "i", "j"]
CANDIDATE = [*CELL, "block", "rep", "component", "leaves", "copies"]
CANDIDATES = "leaf long, i int, j int, block int, rep long, component long, leaves array<long>, copies long"


def _candidates(similarity: float):
    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sets of each cell that have a plausible partner in it."""
        for cell in _groups(batches):
            a, b = _unsettled(cell)
            if len(a):
                sketches = [np.frombuffer(s, "<u4") for s in cell["sketch"].to_pylist()]
                a, b = _plausible(sketches, cell["n"].to_numpy(), a, b, similarity)
            if len(a):
                rows = cell.take(pa.array(np.union1d(a, b))).combine_chunks()
                yield from rows.select(CANDIDATE).to_batches()
        give_back()

    return candidates


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place connected to each place."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verify(similarity: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each set with a link in a cell: the rows it links to, and a set it is connected with."""
        for cell in _groups(batches):
            sets = [np.frombuffer(s, "<u8") for s in cell["shingles"].to_pylist()]
            n = np.array([len(s) for s in sets])
            a, b = _unsettled(cell)
            a, b = _plausible([(s[:SKETCH] >> np.uint64(32)).astype("<u4") for s in sets], n, a, b, similarity)
            if not len(a):
                continue
            common = _overlaps(sets, a, b)
            linked = common >= similarity * (n[a] + n[b] - common) - 1e-9
            a, b = a[linked], b[linked]
            if not len(a):
                continue
            copies, rep = cell["copies"].to_numpy(), cell["rep"].to_numpy()
            links = np.bincount(a, copies[b], len(n)) + np.bincount(b, copies[a], len(n))
            root, own = _spanning(len(n), a, b), np.union1d(a, b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep[own]), pa.array(links[own].astype(np.int64)), pa.array(rep[root[own]])], ["rep", "links", "root"]
            )
        give_back()

    return verify


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(*utf8(batch["text"])))
        shingles = pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *_columns(sets), shingles], ["doc_id", "k1", "k2", "n", "shingles"])


def _links(cells: DataFrame, rows: DataFrame, classes: DataFrame, similarity: float, folder: str) -> DataFrame:
    """(rep, links, root): for each set with a link in a cell, the rows it links to and a set it is connected with."""
    spark, keys = cells.sparkSession, ["k1", "k2", "n"]
    cells = cells.select(*CELL, "block", "rep", "component", "leaves", "copies", "n", "sketch").repartition(*CELL).sortWithinPartitions(*CELL)
    cells.mapInArrow(_candidates(similarity), CANDIDATES).write.parquet(folder + "/candidates")
    candidates = spark.read.schema(CANDIDATES).parquet(folder + "/candidates")

    candidates.select("rep").distinct().join(classes.select("rep", "doc_id", *keys), "rep").write.parquet(folder + "/wanted")
    wanted = spark.read.schema("rep long, doc_id long, k1 long, k2 long, n long").parquet(folder + "/wanted")
    texts = rows.join(_beside(wanted.select("doc_id")), "doc_id", "left_semi")
    sets = texts.mapInArrow(_whole_sets, "doc_id long, k1 long, k2 long, n long, shingles binary")
    sets = sets.join(_beside(wanted), ["doc_id", *keys]).select("rep", "shingles").dropDuplicates(["rep"])
    pairs = candidates.join(sets, "rep").repartition(*CELL).sortWithinPartitions(*CELL)
    pairs.mapInArrow(_verify(similarity), "rep long, links long, root long").write.parquet(folder + "/links")
    return spark.read.schema("rep long, links long, root long").parquet(folder + "/links")


def _named_components(links: DataFrame) -> DataFrame:
    return components(links.select(F.col("rep").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "rep")


def _classified(rows: DataFrame, similarity: float, recall: float, leaf: int, counted: bool) -> DataFrame:
    """Rows (doc_id, text) that have an id, as (doc_id, k1, k2, n, class_id, copy_of, n_links, leads).

    ``leads`` tells the set that stands for its class: of the sets with the least id the one read first.
    Without ``counted``, ``n_links`` is null: sets that are connected already are not compared.
    """
    spark = rows.sparkSession
    folder = scratch_path(spark, "near")
    described = rows.filter("doc_id is not null").mapInArrow(_describe(runs_for(recall), similarity), DESCRIBED)
    described.write.parquet(folder + "/described")
    described = spark.read.schema(DESCRIBED).parquet(folder + "/described")
    keys = ["k1", "k2", "n"]
    light = described.filter("n > 0").groupBy(*keys).agg(F.min(F.struct("doc_id", "place")).alias("r"), F.count("*").alias("copies"))
    light.select(F.col("r.place").alias("rep"), "r.doc_id", *keys, "copies").write.parquet(folder + "/classes")
    classes = spark.read.schema("rep long, doc_id long, k1 long, k2 long, n long, copies long").parquet(folder + "/classes")
    # a class is known by the place of its least row, and described by that row
    first = described.select(F.col("place").alias("rep"), "sketch", "nodes").join(_beside(classes.select("rep", "n", "copies")), "rep")

    # a set's leaves travel with it, to tell where a pair is settled
    lists = _leaves(first.select("rep", "nodes"), leaf, folder)
    lists = lists.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("leaf", "m"))).alias("own"))
    lists.write.parquet(folder + "/lists")
    lists = spark.read.schema("rep long, own array<struct<leaf:long,m:long>>").parquet(folder + "/lists")
    sets = lists.withColumn("leaves", F.col("own.leaf")).join(first.select("rep", "n", "copies", "sketch"), "rep")
    members = sets.select("*", F.col("rep").alias("component"), F.explode("own").alias("o")).select("*", "o.*")
    if counted:
        links = _links(_cells(members, leaf), rows, classes, similarity, folder + "/all")
    else:
        links = _links(_sliced(members, leaf), rows, classes, similarity, folder + "/slices")
        spread = lists.select("rep", F.explode("own").alias("o")).select("rep", "o.*")
        cells = _between(spread, _named_components(links), leaf, folder)
        if cells is not None:
            links = links.unionByName(_links(cells.join(sets, "rep"), rows, classes, similarity, folder + "/between"))

    named = _named_components(links)
    grouped = classes.join(named, "rep")
    grouped = grouped.groupBy("component").agg(F.min(F.struct("doc_id", "rep")).alias("lead")).join(named, "component").select("rep", "lead")
    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    told = classes.join(counted, "rep", "left").join(grouped, "rep", "left").select(
        *keys,
        F.col("doc_id").alias("copy_of"),
        F.coalesce("lead.doc_id", "doc_id").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0)) if counted else F.lit(None).cast("long")).alias("n_links"),
        F.coalesce(F.col("lead.rep") == F.col("rep"), F.lit(True)).alias("leads"),
    )
    return described.select("doc_id", *keys).join(told, keys, "left").select(
        "doc_id",
        *keys,
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("copy_of", "doc_id").alias("copy_of"),
        (F.coalesce("n_links", F.lit(0)) if counted else F.col("n_links")).alias("n_links"),
        F.coalesce("leads", F.lit(True)).alias("leads"),
    )


def _named(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL, leaf: int = LEAF
) -> DataFrame:
    """One row for each row: ``doc_id``, ``class_id``, ``copy_of`` and ``n_links``.

    ``class_id`` is the least id connected by links, ``copy_of`` the least id with the same shingles,
    ``n_links`` the number of other rows of the least similarity or more. Descriptions of all rows,
    classes, links and component rounds are tables in the shared folder.
    """
    rows = _named(df, key, text)
    out = _classified(rows, similarity, recall, leaf, True).select("doc_id", "class_id", "copy_of", "n_links")
    none = F.lit(None).cast("long")
    lost = rows.filter("doc_id is null").select("doc_id", none.alias("class_id"), none.alias("copy_of"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(lost)


def _text_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(*utf8(batch["text"])))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text"], *_columns(sets)], ["doc_id", "text", "k1", "k2", "n"])


def drop_near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL, leaf: int = LEAF
) -> DataFrame:
    """One row of each class, the one of least id, with all its columns. Rows without id or without words stay.

    An id that only one row has is decided by a join on the id. Rows that share an id are decided one by
    one, by their shingles; of rows that share id and shingles one stays.
    """
    folder = scratch_path(df.sparkSession, "later")
    rows, keys = _named(df, key, text), ["k1", "k2", "n"]
    found = _classified(rows, similarity, recall, leaf, False).select("doc_id", *keys, (F.col("leads") & (F.col("doc_id") == F.col("class_id"))).alias("stays"))
    found.write.parquet(folder + "/found")
    found = df.sparkSession.read.parquet(folder + "/found")
    found.groupBy("doc_id").agg(F.count("*").alias("held"), F.bool_or("stays").alias("any")).filter("held > 1 or not any").write.parquet(
        folder + "/ids"
    )
    ids = df.sparkSession.read.parquet(folder + "/ids")
    plain = df.join(_beside(ids.select(F.col("doc_id").alias(key))), key, "left_anti").select(*(f"`{c}`" for c in df.columns))

    shared = _beside(ids.filter("held > 1").select("doc_id"))
    texts = rows.join(shared, "doc_id", "left_semi").distinct().mapInArrow(_text_keys, "doc_id long, text string, k1 long, k2 long, n long")
    good = texts.filter("n > 0").join(found.filter("stays"), ["doc_id", *keys], "left_semi").groupBy("doc_id", *keys).agg(F.min("text").alias("text"))
    again = df.join(shared.withColumnRenamed("doc_id", key), key, "left_semi").select(*(f"`{c}`" for c in df.columns))
    words = F.coalesce(F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    one = again.filter(words).dropDuplicates([key, text]).join(good.select(F.col("doc_id").alias(key), F.col("text").alias(text)), [key, text], "left_semi")
    return plain.unionByName(again.filter(~words)).unionByName(one.select(*(f"`{c}`" for c in df.columns)))


@query("op2_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near duplicates and its number of links."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
