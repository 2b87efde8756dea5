"""Ask the whole corpus about hashes: each batch of documents sends its distinct hashes, each gets answers.

Documents go to batches, consecutive ranges of the id of about equal size. A batch sends its distinct
hashes once, cut into buckets by their leading bits; the task of a bucket sees every batch's hashes in
it. Answers keep the order of the question, so they carry no hashes. A hash held by a third of all
documents costs one entry a batch, and no group grows beyond its share of the hash space.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_BYTES = 8 << 20
CUTS = 64  # quantiles of the id; within each, batches have equal widths
BATCH = "__batch"


@dataclass(frozen=True)
class Plan:
    """How many batches there are, and the leading bits of a hash that choose its bucket."""

    batches: int
    bits: int


def with_batches(df: DataFrame, key: str, text: str, batch_bytes: int = BATCH_BYTES) -> tuple[DataFrame, Plan]:
    """Add the batch of each row: a larger batch number means larger ids; rows without id go to negative ones."""
    k = F.col(f"`{key}`")
    seen = df.agg(
        F.sum(F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long")).alias("bytes"),
        F.percentile_approx(k, [i / CUTS for i in range(CUTS + 1)], 2000).alias("cuts"),
        F.min(k).alias("low"),
        F.max(k).alias("high"),
    ).first()
    total = max(1, math.ceil((seen["bytes"] or 0) / batch_bytes))
    spare = -1 - F.pmod(F.xxhash64(F.col(f"`{text}`")), F.lit(total))
    plan = Plan(total, max(0, math.ceil(math.log2(total))))
    if seen["low"] is None:
        return df.withColumn(BATCH, spare), plan
    cuts = sorted({seen["low"], *seen["cuts"], seen["high"] + 1})
    if len(cuts) > total:  # a small table: fewer ranges than quantiles
        cuts = [cuts[0], *cuts[1:-1][:: math.ceil(len(cuts) / total)], cuts[-1]] if total > 1 else [cuts[0], cuts[-1]]
    each = math.ceil(total / (len(cuts) - 1))
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    at = F.size(F.filter(bounds, lambda c: c <= k))  # from 1
    low, high = F.element_at(bounds, at), F.element_at(bounds, at + 1)
    inner = F.least(F.floor((k.cast("double") - low) / (high.cast("double") - low) * each).cast("long"), F.lit(each - 1))
    return df.withColumn(BATCH, F.when(k.isNull(), spare).otherwise((at - 1) * each + inner)), plan


def bucket_bounds(distinct: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket of sorted hashes begins, and the end of the last."""
    if not bits:
        return np.array([0, len(distinct)])
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate(([0], np.searchsorted(distinct, edges), [len(distinct)]))


def pack_sorted(values: np.ndarray, drop: int = 0) -> bytes:
    """Sorted distinct 64-bit values as differences in as few whole bytes as hold the largest; ``drop`` low bits are zero."""
    steps = np.diff(values >> np.uint64(drop), prepend=np.uint64(0))
    first, steps = int(steps[0]) if len(steps) else 0, steps[1:]
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    body = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    return bytes([width]) + first.to_bytes(8, "little") + body


def unpack_sorted(blob: bytes, drop: int = 0) -> np.ndarray:
    width, body = blob[0], np.frombuffer(blob, np.uint8, offset=9)
    steps = np.zeros((len(body) // width + 1, 8), np.uint8)
    steps[1:, :width] = body.reshape(-1, width)
    steps = steps.reshape(-1).view("<u8").astype(np.uint64)
    steps[0] = int.from_bytes(blob[1:9], "little")
    return np.cumsum(steps) << np.uint64(drop)


def pack_counts(values: np.ndarray) -> bytes:
    """Non-negative integers in as few bytes each as hold the largest, byte by byte place, compressed."""
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 256 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width]) + len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack_counts(blob: bytes) -> np.ndarray:
    width, n = blob[0], int.from_bytes(blob[1:9], "little")
    planes = np.frombuffer(pa.decompress(blob[9:], n * width, "zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(f"<u{width}").reshape(n).astype(np.int64)


def grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order; the order that sorts all; where each distinct one begins in it."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    begins = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(ranked) else np.zeros(0, np.int64)
    return ranked[begins], order, begins
