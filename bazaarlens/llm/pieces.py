"""SentencePiece encoding and decoding with a byte-pair model, as batched Viterbi in numpy.

A text becomes words that start at white space, and each distinct word is encoded once. Words of equal
length advance together: for every end, hashes of all substrings ending there are looked up among the
sorted hashes of the pieces, and maxima over admissible pieces leave back pointers. A byte-pair
model's segmentation is not the one of the largest sum of scores, so an edge of the lattice counts as
admissible only if its piece may follow the one before it: unwinding the merges of both, latest first,
no merge across their boundary may come before one that has consumed its parts. With that, one path
is left, which is the library's.

Edge cases: a null or empty text has no pieces and decodes to the empty text; characters without a
piece become their bytes; a literal U+2581 decodes to a space, as in the library; repeated rows are
encoded one by one; an empty table gives an empty result. Columns of the input that are not the
result's are kept.
"""

from __future__ import annotations

import gc
import heapq
import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.llm.registry import query, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARK = "▁"  # stands for a space
BASE = np.uint64(0x9E3779B97F4A7C15)
WORD = f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n"
NEVER = np.inf
CACHE_WORDS = 1_000_000
CHUNK = 2 << 20
LEADING = 20  # bits of a hash
FIELD = 1 << 22  # characters of words of one length that advance together


def merge(symbols: list[str], rank: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Byte-pair merging of few symbols: the best ranked pair first, the leftmost of equals; and the last merge."""
    after, alive = list(range(1, len(symbols) + 1)), [True] * len(symbols)
    before = list(range(-1, len(symbols) - 1))
    queue: list[tuple[float, int, int, str]] = []

    def offer(a: int, b: int) -> None:
        if 0 <= a and b < len(symbols):
            both = symbols[a] + symbols[b]
            if both in rank:
                heapq.heappush(queue, (rank[both], a, b, both))

    for a in range(len(symbols) - 1):
        offer(a, a + 1)
    last = None
    while queue:
        _, a, b, both = heapq.heappop(queue)
        if not (alive[a] and alive[b]) or after[a] != b or symbols[a] + symbols[b] != both:
            continue
        last = (symbols[a], symbols[b])
        symbols[a], alive[b] = both, False
        after[a] = after[b]
        if after[a] < len(symbols):
            before[after[a]] = a
        offer(before[a], a)
        offer(a, after[a])
    return [s for s, keep in zip(symbols, alive) if keep], last


def _hash(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(BASE) + ord(c) + 1) & (2**64 - 1)
    return h


@dataclass
class Pieces:
    """A piece table as arrays by id, and its mergeable pieces as sorted hashes; its size is the vocabulary's."""

    keys: np.ndarray
    ids: np.ndarray
    hashes: np.ndarray
    powers: np.ndarray
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    longest: int
    byte_ids: list[int]
    texts: list[bytes]
    ranks: dict[str, float]
    by_text: dict[str, int]

    def __post_init__(self) -> None:
        # which leading bits of a hash any piece has: most substrings are told from pieces without a search
        self.leading = np.zeros(1 << LEADING, bool)
        self.leading[(self.keys >> np.uint64(64 - LEADING)).astype(np.int64)] = True

    @classmethod
    def load(cls, path: str) -> Pieces:
        """Read the vocabulary and how each piece comes about; the model file is read where this runs."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        byte_ids, texts, ranks, by_text = [0] * 256, [b""] * size, {}, {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
                texts[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i)):
                texts[i] = piece.replace(MARK, " ").encode()
                by_text[piece] = i
                ranks[piece] = -model.get_score(i)
        hashes, powers = np.zeros(size, np.uint64), np.ones(size, np.uint64)
        rank, left, right = np.full(size, -1.0), np.full(size, -1), np.full(size, -1)
        keep = []
        for piece, i in by_text.items():
            hashes[i], powers[i] = _hash(piece), pow(int(BASE), len(piece), 1 << 64)
            if len(piece) > 1:
                made, parts = merge(list(piece), ranks)
                if len(made) > 1:
                    continue  # merging its characters never yields it
                rank[i] = ranks[piece]
                left[i], right[i] = (by_text.get(p, -1) for p in parts)
            keep.append(i)
        keep = np.array(keep)
        order = np.argsort(hashes[keep])
        longest = max(map(len, by_text))
        return cls(hashes[keep][order], keep[order], hashes, powers, rank, left, right, longest, byte_ids, texts, ranks, by_text)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of pieces by hash; -1 where there is none."""
        found = np.full(len(hashes), -1)
        maybe = np.flatnonzero(self.leading[(hashes >> np.uint64(64 - LEADING)).view(np.int64)])
        wanted = hashes[maybe]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        found[maybe] = np.where(self.keys[at] == wanted, self.ids[at], -1)
        return found

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of both pieces leaves exactly these two; -1 is a character without a piece."""
        ok, limit = np.ones(len(a), bool), np.full(len(a), NEVER)
        a, b, at = a.copy(), b.copy(), np.flatnonzero((a >= 0) & (b >= 0))
        while len(at):
            x, y = a[at], b[at]
            across = self.find(self.hashes[x] * self.powers[y] + self.hashes[y])
            cost = np.where(across >= 0, self.rank[across], NEVER)
            wrong = cost < limit[at]
            ok[at[wrong]] = False
            rx, ry = self.rank[x], self.rank[y]
            first = rx > ry  # the later merge is undone first; of equal ones the right one came later
            limit[at] = np.where(first, rx, np.nextafter(ry, NEVER))
            a[at] = np.where(first, self.right[x], x)
            b[at] = np.where(first, y, self.left[y])
            at = at[~wrong & (np.maximum(rx, ry) >= 0)]
            at = at[(a[at] >= 0) & (b[at] >= 0)]
        return ok

    def segment(self, words: list[str]) -> list[bytes]:
        """Piece ids of words of one length with at most one leading mark; a character without a piece is its bytes."""
        n, length = len(words), len(words[0])
        points = np.array(words, f"<U{length}").view(np.uint32).reshape(n, length).astype(np.uint64)
        prefix = np.zeros((length + 1, n), np.uint64)
        for j in range(length):
            prefix[j + 1] = prefix[j] * BASE + points[:, j] + np.uint64(1)
        power = np.full(min(length, self.longest) + 1, BASE)
        power[0] = 1
        power = np.cumprod(power)
        last, back = np.full((length + 1, n), -1), np.zeros((length + 1, n), np.int64)
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0.0
        for j in range(1, length + 1):
            low = max(0, j - self.longest)
            piece = self.find((prefix[j] - prefix[low:j] * power[j - low : 0 : -1, None]).ravel())  # from the longest substring on
            kept = np.append(np.flatnonzero(piece[:-n] >= 0), np.arange(len(piece) - n, len(piece)))
            start, row, piece = kept // n + low, kept % n, piece[kept]
            pair, at = np.unique((last[start, row] + 1) * (1 << 32) + piece + 1, return_inverse=True)
            fits = self.may_follow((pair >> 32) - 1, (pair & 0xFFFFFFFF) - 1)[at] | (start == 0)
            # one admissible path is left; longer pieces win while it is open
            value = np.where(fits, best[start, row] + (j - start) ** 2, -np.inf)
            order = np.lexsort((value, row))
            ends = np.flatnonzero(np.append(row[order][1:] != row[order][:-1], True))
            top = order[ends]
            best[j, row[top]], back[j, row[top]], last[j, row[top]] = value[top], start[top], piece[top]
        return self._traced(words, back, last)

    def _traced(self, words: list[str], back: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The ids along the back pointers of all words at once, from their ends."""
        at, rows = np.full(len(words), len(words[0])), np.arange(len(words))
        steps, sizes, plain = [], np.zeros(len(words), np.int64), np.ones(len(words), bool)
        while len(rows):
            piece = last[at, rows]
            step = np.zeros(len(words), "<u4")
            step[rows] = np.maximum(piece, 0)
            steps.append(step)
            sizes[rows] += 1
            plain[rows[piece < 0]] = False
            at = back[at, rows]
            rows, at = rows[at > 0], at[at > 0]
        blob = np.column_stack(steps[::-1]).tobytes()
        ends = np.arange(1, len(words) + 1) * 4 * len(steps)
        out = [blob[a:b] for a, b in zip((ends - 4 * sizes).tolist(), ends.tolist())]
        for n in np.flatnonzero(~plain).tolist():
            word, found, j = words[n], [], len(words[0])
            while j:
                i, piece = int(back[j, n]), int(last[j, n])
                found.extend([piece] if piece >= 0 else [self.byte_ids[x] for x in reversed(word[i:j].encode())])
                j = i
            out[n] = np.array(found[::-1], "<u4").tobytes()
        return out


class Encoder:
    """Encodes texts word by word and remembers distinct words."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.known, self.runs = pieces, {}, {}
        self.word = re.compile(WORD)

    def _run(self, n: int) -> bytes:
        """The ids of a run of marks on its own; its merges come after all others."""
        if n not in self.runs:
            made, _ = merge([MARK] * n, self.pieces.ranks)
            self.runs[n] = np.array([self.pieces.by_text[p] for p in made], "<u4").tobytes()
        return self.runs[n]

    def learn(self, words: set[str]) -> None:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        by_length: dict[int, list[tuple[str, int, str]]] = {}
        for w in words.difference(self.known):
            rest = w.lstrip(MARK)
            marks = len(w) - len(rest)
            core = MARK[:marks] + rest
            if rest:
                by_length.setdefault(len(core), []).append((w, marks, core))
            else:
                self.known[w] = self._run(marks)
        for length, group in by_length.items():
            step = max(1, FIELD // (length * 16))
            for a in range(0, len(group), step):
                part = group[a : a + step]
                for (w, marks, _), ids in zip(part, self.pieces.segment([c for _, _, c in part])):
                    if marks > 1:  # the last mark joins the run before it unless it has merged with the word
                        alone = self.pieces.texts[int.from_bytes(ids[:4], "little")] == b" "
                        ids = self._run(marks) + ids[4:] if alone else self._run(marks - 1) + ids
                    self.known[w] = ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Piece ids of each text. Nothing here refers to itself, so the collector, which would walk the lists of all
        words over and over, waits until the texts are done."""
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [self.word.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn(set().union(*split))
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]


def decode(ids: bytes, texts: list[bytes]) -> bytes:
    """The text of little-endian 32-bit ids, without the space put before it."""
    return b"".join(map(texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))[1:]


def _code(pieces, text: str, out: str, schema: pa.Schema, digest: bool):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces.value)
        for batch in batches:
            texts = [t or "" for t in batch[text].to_pylist()]
            coded, size = [], 0
            part: list[str] = []
            for n, t in enumerate(texts):
                part.append(t)
                size += len(t)
                if size > CHUNK or n == len(texts) - 1:
                    coded += encoder.encode(part)
                    part, size = [], 0
            if digest:
                same = [decode(c, pieces.value.texts) == t.replace(MARK, " ").encode() for c, t in zip(coded, texts)]
                own = [pa.array([len(c) // 4 for c in coded], pa.int64()), pa.array([zlib.crc32(c) for c in coded], pa.int64()), pa.array(same, pa.bool_())]
            else:
                values = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
                offsets = np.concatenate(([0], np.cumsum([len(c) // 4 for c in coded]))).astype(np.int32)
                own = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in schema.names[: len(schema) - len(own)]), *own], schema=schema)

    return code


def encode_texts(df: DataFrame, model: str | None = None, text: str = "text", out: str = "piece_ids", digest: bool = False) -> DataFrame:
    """Add the piece ids of ``text`` as ``out``; or, with ``digest``, ``n_pieces``, ``ids_crc32`` and ``round_trip``.

    ``ids_crc32`` is that of the ids as little-endian unsigned 32-bit integers, ``round_trip`` whether
    decoding gives the text again.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    pieces = df.sparkSession.sparkContext.broadcast(Pieces.load(model or public_tokenizers.path("piece_bpe_32k.model")))
    if digest:
        own = [T.StructField("n_pieces", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("round_trip", T.BooleanType())]
    else:
        own = [T.StructField(out, T.ArrayType(T.IntegerType()))]
    df = df.drop(*[f.name for f in own])
    keep = [f for f in df.schema.fields if not digest or f.name != text]
    schema = T.StructType(keep + own)
    return df.mapInArrow(_code(pieces, text, out, to_arrow_schema(schema), digest), schema)


def decode_ids(df: DataFrame, model: str | None = None, ids: str = "piece_ids", out: str = "text") -> DataFrame:
    """Add the text of an array of piece ids; null ids give an empty text, bytes that are no UTF-8 the replacement character."""
    pieces = df.sparkSession.sparkContext.broadcast(Pieces.load(model or public_tokenizers.path("piece_bpe_32k.model")))

    @F.pandas_udf("string")
    def text_of(column):
        import pandas as pd

        return pd.Series([decode(np.asarray([] if x is None else x, "<u4").tobytes(), pieces.value.texts).decode(errors="replace") for x in column])

    return df.withColumn(out, text_of(F.col(f"`{ids}`")))


@query("op9_sentencepiece")
def sentencepiece_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, as count and checksum, and whether they decode to its text."""
    return encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)
