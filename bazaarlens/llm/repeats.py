"""Exact substring removal: windows of words that also occur in an earlier document.

Rabin-Karp hashes of every window are exchanged by hash range; a batch learns for each of its distinct
windows whether a batch of smaller ids holds it too, and settles order within itself. Neighbouring
removed windows merge into maximal intervals of words. Equality is that of 64-bit hashes.

Edge cases: a null or blank text has no words and nothing is removed; texts shorter than a window stay
whole; rows that share an id are not earlier than one another; rows without id neither remove nor are
removed; repeated rows give repeated results; an empty table gives an empty result. Other columns are
kept unless a result column has their name.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.llm.exchange import BATCH, BATCH_BYTES, bucket_bounds, pack_sorted, unpack_sorted, with_batches
from bazaarlens.llm.hashing import give_back, utf8, windows, word_hashes, words
from bazaarlens.llm.registry import query, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
RESULTS = ("n_words", "n_removed", "kept_sha256", "removed")


def _ask(size: int, bits: int, text: str):
    def ask(rows: pa.Table) -> pa.Table:
        batch = rows[BATCH][0].as_py()
        blobs, buckets = [], []
        if batch >= 0:
            found = np.unique(windows(*word_hashes(*utf8(rows[text])), size)[0])
            bounds = bucket_bounds(found, bits)
            for b in np.flatnonzero(np.diff(bounds)):
                buckets.append(int(b))
                blobs.append(pack_sorted(found[bounds[b] : bounds[b + 1]]))
        found = None
        give_back()
        return pa.table({"bucket": pa.array(buckets, pa.int64()), "batch": pa.array([batch] * len(blobs), pa.int64()), "blob": pa.array(blobs, pa.binary())})

    return ask


def _answer(rows: pa.Table) -> pa.Table:
    """For each batch's windows in a bucket, a bit: does an earlier batch hold it?"""
    batch = rows["batch"].to_numpy()
    order = np.argsort(batch, kind="stable")
    blobs = rows["blob"].to_pylist()
    parts = [unpack_sorted(blobs[i]) for i in order]
    ends = np.cumsum([len(p) for p in parts])
    hashes = np.concatenate(parts)
    by_hash = np.argsort(hashes, kind="stable")
    hashes = hashes[by_hash]
    earlier = np.zeros(len(hashes), bool)
    earlier[by_hash[1:]] = hashes[1:] == hashes[:-1]
    bits = [earlier[e - len(p) : e] for e, p in zip(ends, parts)]
    told = [j for j, x in enumerate(bits) if x.any()]
    return pa.table(
        {
            "batch": pa.array([int(batch[order[j]]) for j in told], pa.int64()),
            "bucket": pa.array([rows["bucket"][0].as_py()] * len(told), pa.int64()),
            "bits": pa.array([np.packbits(bits[j]).tobytes() for j in told], pa.binary()),
        }
    )


def _intervals(covered: np.ndarray) -> np.ndarray:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
    return edge.reshape(-1, 2)


def _cut(size: int, bits: int, key: str, text: str, whole: bool, schema: pa.Schema):
    def cut(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(rows):
            return schema.empty_table()
        rows = rows.sort_by(key)
        data, offsets = utf8(rows[text])
        hashes, firsts = word_hashes(data, offsets)
        found, at, row = windows(hashes, firsts, size)
        repeated = np.zeros(len(found), bool)
        if len(found) and rows[BATCH][0].as_py() >= 0:
            distinct, first, place = np.unique(found, return_index=True, return_inverse=True)
            earlier, bounds = np.zeros(len(distinct), bool), bucket_bounds(distinct, bits)
            for bucket, packed in zip(answers["bucket"].to_pylist(), answers["bits"].to_pylist()):
                lo, hi = bounds[bucket], bounds[bucket + 1]
                earlier[lo:hi] = np.unpackbits(np.frombuffer(packed, np.uint8), count=hi - lo)
            ids = rows[key].to_numpy()
            repeated = earlier[place] | (ids[row] > ids[row[first]][place])
        steps = np.zeros(firsts[-1] + 1, np.int32)
        np.add.at(steps, at[repeated], 1)
        np.add.at(steps, at[repeated] + size, -1)
        covered = np.cumsum(steps[:-1]) > 0
        gone = np.concatenate(([0], np.cumsum(covered)))
        removed = gone[firsts[1:]] - gone[firsts[:-1]]
        del found, at, row, repeated, steps, gone, hashes
        give_back()
        shas, texts, intervals = [], [], []
        for i in range(len(rows)):
            body, kept = data[offsets[i] : offsets[i + 1]], ~covered[firsts[i] : firsts[i + 1]]
            spans = []
            if not removed[i]:
                plain = body.tobytes()
                left = plain.split()
            elif whole or kept.any():
                plain = body.tobytes()
                left = [w for w, k in zip(plain.split(), kept.tolist()) if k]
                if whole:
                    starts, _, _ = words(body, np.array([0, len(body)]))
                    starts = np.append(starts, len(body))
                    spans = _intervals(~kept).tolist()
                    last, pieces = 0, []
                    for a, b in spans:
                        pieces.append(plain[last : starts[a]])
                        last = starts[b]
                    plain = b"".join([*pieces, plain[last:]])
            else:
                left = []
            shas.append(hashlib.sha256(b" ".join(left)).hexdigest())
            if whole:
                texts.append(plain.decode())
                intervals.append([{"start": a, "end": b} for a, b in spans])
        out = {name: rows[name] for name in rows.column_names if name in schema.names}
        out |= {"n_words": np.diff(firsts), "n_removed": removed, "kept_sha256": shas}
        if whole:
            null = rows[text].is_null().to_pylist()
            out |= {text: [None if n else t for n, t in zip(null, texts)], "removed": intervals}
        return pa.table([pa.array(out[f.name], f.type) if not isinstance(out[f.name], pa.ChunkedArray) else out[f.name].cast(f.type) for f in schema], schema=schema)

    return cut


def remove_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW, whole: bool = True, batch_bytes: int = BATCH_BYTES // 2
) -> DataFrame:
    """Cut from ``text`` all words in a window of ``size`` words that also starts in a row with a smaller ``key``.

    Adds the number of words, the number removed, the hash of the kept words joined by one space, and
    the removed intervals in words. White space between kept words stays. Without ``whole`` the texts
    and intervals are left out, for callers that need counts and hashes only.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    df = df.drop(*RESULTS)
    batched, plan = with_batches(df, key, text, batch_bytes)
    fields = [f for f in df.schema.fields if whole or f.name != text]
    fields += [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    if whole:
        interval = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
        fields.append(T.StructField("removed", T.ArrayType(interval)))
    schema = T.StructType(fields)
    documents = batched.groupBy(BATCH)
    asked = documents.applyInArrow(_ask(size, plan.bits, text), "bucket long, batch long, blob binary")
    answers = asked.groupBy("bucket").applyInArrow(_answer, "batch long, bucket long, bits binary")
    cut = _cut(size, plan.bits, key, text, whole, to_arrow_schema(schema))
    return documents.cogroup(answers.groupBy("batch")).applyInArrow(cut, schema)


CHECK_SQL = f"""with d as (select row_number() over () row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') words from documents),
w as (select row_id, doc_id, i, words[i:i + {WINDOW - 1}] win from (
    select row_id, doc_id, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) i from d)),
r as (select row_id, i from (select *, min(doc_id) over (partition by win) first from w) where first < doc_id),
gone as (select distinct row_id, i + k i from r, (select unnest(range(0, {WINDOW})) k)),
p as (select row_id, unnest(words) word, unnest(generate_series(1, len(words))) i from d),
k as (select row_id, count(*) n_kept, string_agg(word, ' ' order by i) kept from p anti join gone using (row_id, i) group by row_id)
select doc_id, len(words)::bigint n_words, (len(words) - coalesce(n_kept, 0))::bigint n_removed, sha256(coalesce(kept, '')) kept_sha256
from d left join k using (row_id)"""


@query("op3_substring_dedup", CHECK_SQL)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document once windows seen in earlier documents are cut."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(documents, whole=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
