"""Language model scores by deleted interpolation.

The probability of a token mixes the maximum-likelihood estimates of n-grams of every order and a
uniform one. The mixture weights depend on how often the context was seen, in powers of two, and are
learned by expectation-maximisation on held-out counts: every training token is predicted from the
counts without itself. Counts come from the whole training part, exchanged by hash range; tokens with
their counts are written to the shared folder once, and learning and scoring read them there.

Edge cases: a null or blank text is the end token alone; repeated rows count and score each; rows
without id belong to the training part; without training rows every token is unknown and scores
uniformly; an empty table gives an empty result. Columns of the input beside the id are dropped.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.exchange import (
    BATCH,
    BATCH_BYTES,
    bucket_bounds,
    grouped,
    pack_counts,
    pack_sorted,
    unpack_counts,
    unpack_sorted,
    with_batches,
)
from bazaarlens.llm.hashing import utf8, windows, word_hashes
from bazaarlens.llm.registry import query, table
from bazaarlens.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 2
START, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
TRAIN = "__train"
SHORT = 8  # low bits not sent of hashes of two or more tokens
STEPS = 2  # quantised estimates per factor of two, for learning the weights
BUCKETS = 20  # of context counts: 0, 1, 2-3, 4-7, ...
ROUNDS = 50


def _ngrams(hashes: np.ndarray, firsts: np.ndarray, n: int) -> np.ndarray:
    """For every token, the end included, the hash of the n-gram that ends in it."""
    sizes = np.diff(firsts) + n
    begin = np.concatenate(([0], np.cumsum(sizes)))
    padded = np.full(begin[-1], START, np.uint64)
    padded[np.arange(len(hashes)) + np.repeat(begin[:-1] + n - 1 - firsts[:-1], np.diff(firsts))] = hashes
    padded[begin[1:] - 1] = END
    found = windows(padded, begin, n)[0]
    return found if n == 1 else found >> np.uint64(SHORT) << np.uint64(SHORT)


def _ask(order: int, bits: int, text: str):
    def ask(rows: pa.Table) -> pa.Table:
        hashes, firsts = word_hashes(*utf8(rows[text]), lower=True)
        train = np.repeat(rows[TRAIN].to_numpy().astype(np.int64), np.diff(firsts) + 1)
        buckets, blobs, counts = [], [], []
        for n in range(1, order + 1):
            distinct, by_hash, begins = grouped(_ngrams(hashes, firsts, n))
            seen = np.add.reduceat(train[by_hash], begins) if len(begins) else begins
            bounds = bucket_bounds(distinct, bits)
            for b in np.flatnonzero(np.diff(bounds)):
                part = slice(bounds[b], bounds[b + 1])
                buckets.append((n << bits) + int(b))
                blobs.append(pack_sorted(distinct[part], SHORT if n > 1 else 0))
                counts.append(pack_counts(seen[part]))
        batch = pa.array([rows[BATCH][0].as_py()] * len(blobs), pa.int64())
        return pa.table({"bucket": pa.array(buckets, pa.int64()), "batch": batch, "blob": pa.array(blobs, pa.binary()), "counts": pa.array(counts, pa.binary())})

    return ask


def _answer(bits: int):
    def answer(rows: pa.Table) -> pa.Table:
        """The sum over batches for each hash asked for; the first batch also hears how many were counted."""
        bucket = rows["bucket"][0].as_py()
        single = bucket >> bits == 1
        parts = [unpack_sorted(b, 0 if single else SHORT) for b in rows["blob"].to_pylist()]
        counts = np.concatenate([unpack_counts(c) for c in rows["counts"].to_pylist()])
        distinct, by_hash, begins = grouped(np.concatenate(parts))
        sums = np.add.reduceat(counts[by_hash], begins)
        totals = np.empty(len(counts), np.int64)
        totals[by_hash] = np.repeat(sums, np.diff(np.append(begins, len(counts))))
        ends = np.cumsum([len(p) for p in parts])
        known = np.zeros(len(parts), np.int64)
        known[0] = np.count_nonzero(sums) if single else 0
        return pa.table(
            {
                "batch": rows["batch"],
                "bucket": rows["bucket"],
                "counts": pa.array([pack_counts(totals[e - len(p) : e]) for e, p in zip(ends, parts)], pa.binary()),
                "known": pa.array(known, pa.int64()),
            }
        )

    return answer


def _tell(order: int, bits: int, key: str, text: str):
    def tell(rows: pa.Table, answers: pa.Table) -> pa.Table:
        """Each document with the counts of its n-grams, token by token; ``known`` sums to the vocabulary."""
        hashes, firsts = word_hashes(*utf8(rows[text]), lower=True)
        ends = np.cumsum(np.diff(firsts) + 1)
        told = dict(zip(answers["bucket"].to_pylist(), answers["counts"].to_pylist()))
        columns = {}
        for n in range(1, order + 1):
            distinct, by_hash, begins = grouped(_ngrams(hashes, firsts, n))
            totals = np.concatenate([np.zeros(0, np.int64), *(unpack_counts(told[b]) for b in sorted(told) if b >> bits == n)])
            counts = np.empty(len(by_hash), np.int64)
            counts[by_hash] = np.repeat(totals, np.diff(np.append(begins, len(by_hash))))
            columns[f"c{n}"] = pa.array([pack_counts(c) for c in np.split(counts, ends[:-1])], pa.binary())
        known = np.zeros(len(rows), np.int64)
        known[:1] = sum(answers["known"].to_pylist())
        return pa.table({"doc_id": rows[key], "train": rows[TRAIN], "n_tokens": np.diff(firsts) + 1, "known": known, **columns})

    return tell


def _estimates(batch: pa.RecordBatch, order: int, total: int, documents: int, left_out: int):
    """Estimates of each order and the context's bucket, token by token, from counts less ``left_out``; and c1, firsts."""
    counts = []
    for n in range(1, order + 1):
        counts.append(np.concatenate([unpack_counts(b) for b in batch[f"c{n}"].to_pylist()]))
    firsts = np.concatenate(([0], np.cumsum(batch["n_tokens"].to_numpy())))
    estimates = [(counts[0] - left_out) / max(1, total - left_out)]
    context = np.full(len(counts[0]), max(0, total - left_out))
    for n in range(2, order + 1):
        context = np.empty(len(counts[0]), np.int64)
        context[1:] = counts[n - 2][:-1]
        context[firsts[:-1]] = documents
        context = np.maximum(context - left_out, 0)
        estimates.append(np.divide(counts[n - 1] - left_out, context, out=np.zeros(len(context)), where=context > 0))
    bucket = np.minimum(np.ceil(np.log2(context + 1)).astype(np.int64), BUCKETS - 1)
    return estimates, bucket, counts[0], firsts


def _cells(order: int, total: int, documents: int):
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many training tokens have which quantised estimates, each predicted without itself."""
        wide = 64 * STEPS
        for batch in batches:
            if not len(batch):
                continue
            estimates, cell, _, _ = _estimates(batch, order, total, documents, 1)
            for e in estimates:
                level = np.full(len(e), wide - 1)
                level[e > 0] = np.round(-STEPS * np.log2(e[e > 0])).astype(np.int64)
                cell = cell * wide + np.minimum(level, wide - 1)
            distinct, n = np.unique(cell, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct, pa.int64()), pa.array(n, pa.int64())], ["cell", "n"])

    return cells


def learn_weights(cells: list[tuple[int, int]], order: int, vocabulary: int, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights by context bucket, uniform first, by expectation-maximisation over quantised estimates."""
    weights = np.full((BUCKETS, order + 1), 1 / (order + 1))
    if not cells:
        return np.eye(1, order + 1).repeat(BUCKETS, 0)
    wide = 64 * STEPS
    cell, n = np.array(cells, np.int64).T
    parts = np.empty((len(cell), order + 1))
    parts[:, 0] = 1 / (vocabulary + 1)
    for k in range(order, 0, -1):
        level = cell % wide
        parts[:, k] = np.where(level == wide - 1, 0.0, 2.0 ** (-level / STEPS))
        cell = cell // wide
    for _ in range(rounds):
        share = weights[cell] * parts
        share *= (n / share.sum(1))[:, None]
        sums = np.zeros_like(weights)
        np.add.at(sums, cell, share)
        mass = sums.sum(1, keepdims=True)
        weights = np.where(mass > 0, sums / np.maximum(mass, 1e-300), weights)
        weights = np.maximum(weights, 1e-6)
        weights /= weights.sum(1, keepdims=True)
    return weights


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(order: int, total: int, documents: int, vocabulary: int, weights: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            estimates, bucket, c1, firsts = _estimates(batch, order, total, documents, 0)
            w = weights[bucket]
            p = w[:, 0] / (vocabulary + 1)
            for k, e in enumerate(estimates, 1):
                p += w[:, k] * e
            begins = firsts[:-1]
            base = np.log10((c1 + 1) / (total + vocabulary + 1))
            out = (
                batch["doc_id"],
                pa.array(~batch["train"].to_numpy(zero_copy_only=False)),
                batch["n_tokens"],
                pa.array(np.add.reduceat((c1 > 0).astype(np.int64), begins)),
                pa.array(np.full(len(batch), total, np.int64)),
                pa.array(np.add.reduceat(base, begins)),
                pa.array(np.add.reduceat(np.log10(p), begins)),
            )
            yield pa.RecordBatch.from_arrays(list(out), SCORES.replace(" boolean", "").replace(" double", "").replace(" long", "").split(", "))

    return score


def score_texts(
    df: DataFrame, train: Column, key: str = "doc_id", text: str = "text", order: int = ORDER, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Score every row's text by a model learned from the rows where ``train`` holds.

    A row for each row: its tokens and how many of them the training part has, the size of that part,
    the log10 probability under add-one unigrams, and under the interpolated model.
    """
    spark = df.sparkSession
    df = df.select(F.col(f"`{key}`").cast("long").alias(key), F.col(f"`{text}`"), F.coalesce(train, F.lit(True)).alias(TRAIN))
    batched, plan = with_batches(df, key, text, batch_bytes)
    documents = batched.groupBy(BATCH)
    asked = documents.applyInArrow(_ask(order, plan.bits, text), "bucket long, batch long, blob binary, counts binary")
    answers = asked.groupBy("bucket").applyInArrow(_answer(plan.bits), "batch long, bucket long, counts binary, known long")
    counts = ", ".join(f"c{n} binary" for n in range(1, order + 1))
    schema = f"doc_id long, train boolean, n_tokens long, known long, {counts}"
    told = documents.cogroup(answers.groupBy("batch")).applyInArrow(_tell(order, plan.bits, key, text), schema)
    folder = scratch_path(spark, "token_counts")
    told.write.parquet(folder)
    told = spark.read.schema(schema).parquet(folder)

    size = told.agg(
        F.sum(F.when(F.col("train"), F.col("n_tokens"))).alias("tokens"),
        F.count(F.when(F.col("train"), 1)).alias("documents"),
        F.sum("known").alias("vocabulary"),
    ).first()
    total, vocabulary = size["tokens"] or 0, size["vocabulary"] or 0
    # at most BUCKETS * (64 * STEPS) ** order cells, whatever the corpus; most are empty
    cells = told.filter("train").mapInArrow(_cells(order, total, size["documents"]), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    weights = learn_weights([(r["cell"], r["n"]) for r in cells.collect()], order, vocabulary)
    return told.mapInArrow(_score(order, total, size["documents"], vocabulary, weights), SCORES)


@query("op6_language_model")
def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability, learned from those whose crc32 modulo 7 is not 2."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    return score_texts(documents, train)
