"""Best-fit packing of tokenised documents into sequences of fixed length.

Documents become pieces of at most one sequence; only longer documents are cut. Pieces are dealt into
shards of bounded size, and each shard is packed best-fit decreasing: a segment tree over remaining
capacities finds the tightest open sequence for a piece in logarithmic time. Sequences that stay
poorly filled are opened again, and the pieces in them are packed once more across shards.

Edge cases: a null or blank text is a piece that holds the end token alone; repeated rows are packed
one by one; rows without id keep a null id; an empty table gives an empty result; columns of the input
that are not the result's are dropped, since the result has a row for each piece, not each document.
"""

from __future__ import annotations

import math
import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.hashing import give_back, slices, utf8
from bazaarlens.llm.registry import query, table
from bazaarlens.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 4096
END = 1
SHARD = 200_000  # pieces packed by one task
POOR = 0.98  # sequences less full than this are packed again in the second round
CACHE_WORDS = 100_000  # distinct words after which a task keeps, of those before, only what comes again
CHUNK = 2 << 20  # bytes of text split into words at once
TRAILING = b".,;:!?*#$%&|\"()"  # symbols that the tokenizer always splits from a preceding letter

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, place long"


class WordIds:
    """Token ids of white-space separated words, as little-endian unsigned 32-bit integers.

    The tokenizer drops white space and lower-cases, so the ids of a text are those of its words in
    order. Each distinct lower-cased word is tokenised once.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        # byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.symbols = {**{b: chr(b) for b in printable}, **{b: chr(256 + n) for n, b in enumerate(rest)}}
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        give_back()

    def _tokenise(self, words: list[bytes]) -> None:
        """Several words as one text; the place of a token tells its word."""
        texts = [w.decode() for w in words]
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        encoded = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(encoded.ids, "<u4")
        word = np.searchsorted(begins, np.array([a for a, _ in encoded.offsets], np.int64), "right") - 1
        cuts = np.searchsorted(word, np.arange(len(words) + 1)) * 4
        blob = ids.tobytes()
        for w, a, b in zip(words, cuts[:-1].tolist(), cuts[1:].tolist()):
            self.known[w] = blob[a:b]

    def _simple(self, word: bytes) -> bool:
        """Tokenise a word of lower-case Latin letters by the merges alone: normalising and splitting leave it whole."""
        text = word.decode()
        if not (text.isalpha() and max(text) < "\u0250" and text == text.lower()):
            return False
        if not text.isascii():
            text = "".join([self.symbols[b] for b in word])
        ids = [t.id for t in self.merges.tokenize(text)]
        self.known[word] = struct.pack(f"<{len(ids)}I", *ids)
        return True

    def learn(self, words: set[bytes]) -> None:
        if len(self.known) > CACHE_WORDS:
            self.before, self.known = self.known, {}
        again = words.difference(self.known).intersection(self.before)
        self.known.update((w, self.before[w]) for w in again)
        new = words.difference(self.known)
        split = {}
        for w in new:
            stem = w.rstrip(TRAILING)
            if stem and len(stem) < len(w) and stem[-1:].isalpha():
                split[w] = (stem, w[len(stem) :])
        parts = {p for pair in split.values() for p in pair}.difference(self.known)
        todo = [w for w in parts.union(new.difference(split)) if not self._simple(w)]
        for i in range(0, len(todo), 2000):
            self._tokenise(todo[i : i + 2000])
        for w, (stem, rest) in split.items():
            self.known[w] = self.known[stem] + self.known[rest]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        # a lower-cased word must not turn into the string of a special token
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        self.learn(set().union(*split))
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]


def _pieces(path: str, key: str, text: str, length: int, end: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, tail = WordIds(path), int(end).to_bytes(4, "little")
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            _, offsets = utf8(batch[text])
            for a, b in slices(offsets, CHUNK):  # a few texts at a time, so that only rows pile up
                docs, blobs = (batch[c].slice(a, b - a) for c in (key, text))
                blobs = [t or b"" for t in blobs.cast(pa.large_binary()).to_pylist()]
                for doc, tokens in zip(docs.to_pylist(), ids.encode(blobs)):
                    tokens += tail
                    for n, at in enumerate(range(0, len(tokens), 4 * length)):
                        body = tokens[at : at + 4 * length]
                        out.append((doc, n, at // 4, len(body) // 4, zlib.crc32(body), place))
                        place += 1
            columns = list(zip(*out)) or [[]] * 6
            kinds = (batch.schema.field(key).type, pa.int32(), *[pa.int64()] * 4)
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "place")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        ids.known.clear()
        ids.before.clear()
        give_back()

    return pieces


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each length, and what is left in each bin; ``lengths`` must be decreasing.

    Leaf ``c`` of the tree counts the open bins with exactly ``c`` left; the first leaf at or above
    a length that is not empty holds the tightest bins.
    """
    size = 1 << capacity.bit_length()
    tree, open_bins = [0] * (2 * size), [[] for _ in range(capacity + 1)]
    bins, offsets, left = [], [], []

    def count(leaf: int, by: int) -> None:
        node = leaf + size
        while node:
            tree[node] += by
            node >>= 1

    def tightest(least: int) -> int:
        node = least + size
        while not tree[node]:  # up to the first subtree on the right that has bins
            while node & 1:
                node >>= 1
            if not node:
                return -1
            node += 1
        while node < size:  # down to its first leaf
            node *= 2
            node += not tree[node]
        return node - size

    for n in lengths:
        room = tightest(n)
        if room < 0:
            bin_, room = len(left), capacity
            left.append(capacity)
        else:
            bin_ = open_bins[room].pop()
            count(room, -1)
        bins.append(bin_)
        offsets.append(capacity - room)
        left[bin_] = room - n
        if room > n:
            open_bins[room - n].append(bin_)
            count(room - n, 1)
    return bins, offsets, left


def _pack(capacity: int, first_round: bool):
    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("place", "ascending")])
        bins, offsets, left = best_fit(rows["length"].to_pylist(), capacity)
        shard = rows["shard"][0].as_py()
        sequence = pa.array(np.array(bins, np.int64) + (shard << 40) + (0 if first_round else 1 << 62), pa.int64())
        left = np.array(left)[bins] if bins else np.zeros(0)
        again = pa.array(left > (1 - POOR) * capacity if first_round else np.zeros(len(bins), bool))
        return rows.append_column("sequence_id", sequence).append_column("offset", pa.array(offsets, pa.int64())).append_column("again", again)

    return pack


def pack_documents(
    df: DataFrame,
    tokenizer: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end: int = END,
    shard: int = SHARD,
) -> DataFrame:
    """A row for each piece: its place in its document, its sequence, and its offset there.

    The piece table is written to the shared folder once, so that both rounds read the same rows.
    """
    spark = df.sparkSession
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    pieces = df.select(F.col(f"`{key}`").cast("long").alias(key), F.col(f"`{text}`")).mapInArrow(_pieces(path, key, text, length, end), PIECES)
    folder = scratch_path(spark, "pieces")
    pieces.write.parquet(folder + "/pieces")
    pieces = spark.read.schema(PIECES).parquet(folder + "/pieces")
    shards = max(1, math.ceil(pieces.count() / shard))
    fields = PIECES + ", shard long, sequence_id long, offset long, again boolean"
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(shards)).cast("long"))
    dealt.groupBy("shard").applyInArrow(_pack(length, True), fields).write.parquet(folder + "/packed")
    packed = spark.read.schema(fields).parquet(folder + "/packed")
    poor = packed.filter("again").drop("sequence_id", "offset", "again")
    parts = max(1, math.ceil(packed.filter("again").count() / shard))
    poor = poor.withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(parts)).cast("long"))
    repacked = poor.groupBy("shard").applyInArrow(_pack(length, False), fields)
    return packed.filter("not again").unionByName(repacked).drop("place", "shard", "again")


@query("op5_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of 4096 tokens."""
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
