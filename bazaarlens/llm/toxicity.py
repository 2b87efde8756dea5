"""Toxicity by class-conditional Kneser-Ney models.

Each class has a distribution of expressions from its continuation counts, the number of different
words an expression follows: absolute discounting gives the mass of rare expressions to continuation
counts shared by both classes, so those weigh little either way, and copies of a text count once. A
text's log-likelihoods under both models, divided by length, are compared over the whole text and over
its most telling expressions; a logistic curve, fitted on the sample with each row left out of the
models in turn, makes the differences a probability. Expressions are single words: pairs of words, tried on the given labels,
ranked held-out rows worse (0.985 against 1.000 area under the curve).

The models are fitted on a bounded sample of labelled rows (``bound`` rows a class in expectation);
every row is scored. Words are runs of letters, A-Z folded.

Edge cases: a null or wordless text gets the curve's value at differences of 0; repeated rows score
alike; labels that are null or not 0 or 1, or whose row is missing, teach nothing; conflicting labels
of one id both count; without rows of both classes every score is 0; an empty table gives an empty
result. Other columns are kept unless a result column has their name.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.llm.hashing import NOT_LETTERS, slices, utf8, word_hashes
from bazaarlens.llm.registry import query, table
from bazaarlens.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BOUND = 10_000  # labelled rows of a class that the models learn from, in expectation
DISCOUNT = 2.0
TELLING = 3  # expressions of a text that speak most for the toxic class
THRESHOLD = 0.3
CHUNK = 2 << 20  # bytes of text in work at once
START = np.uint64(0x452821E638D01377)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of a word and the one before it, with the classes that use them."""
    for batch in batches:
        data, offsets = utf8(batch["text"])
        toxic = batch["toxic"].to_numpy() == 1
        for a, b in slices(offsets, CHUNK):
            words, firsts = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], True, NOT_LETTERS)
            before = np.concatenate(([START], words[:-1])) if len(words) else words
            before[firsts[:-1][np.diff(firsts) > 0]] = START
            for y in (False, True):
                mine = np.repeat(toxic[a:b] == y, np.diff(firsts))
                pairs = np.unique(np.column_stack((before[mine], words[mine])).view(np.int64), axis=0)
                flags = [pa.array(np.full(len(pairs), int(y == z))) for z in (True, False)]
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), *flags], ["v", "w", "t", "o"])


@dataclass
class Model:
    """Continuation counts of known words by sorted hash: toxic, ordinary, either; its size is bounded by the sample."""

    words: np.ndarray
    counts: np.ndarray
    totals: np.ndarray
    back: np.ndarray  # mass that discounting leaves to the shared counts, by class

    def ratios(self, counts: np.ndarray) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary); a word with one context in all counts as unseen."""
        own = np.maximum(counts[:, :2] - DISCOUNT, 0) / self.totals[:2]
        p = own + self.back * np.maximum(counts[:, 2:], 1) / self.totals[2]
        return np.where(counts[:, 2] > 1, np.log(p[:, 0] / p[:, 1]), np.log(self.back[0] / self.back[1]))

    def seen(self, words: np.ndarray) -> np.ndarray:
        """The counts of each word, as numbers with a fraction part to come off."""
        if not len(self.words):
            return np.zeros((len(words), 3))
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where((self.words[at] == words)[:, None], self.counts[at], 0).astype(float)

    def log_ratios(self, words: np.ndarray) -> np.ndarray:
        distinct, place = np.unique(words, return_inverse=True)
        return self.ratios(self.seen(distinct))[place]

    def left_out(self, words: np.ndarray, toxic: bool) -> np.ndarray:
        """The same for a text of the sample, as if it had not been learned from: less its own contexts."""
        distinct, place = np.unique(words, return_inverse=True)
        pairs = np.unique(np.column_stack((np.concatenate(([START], words[:-1])), words)), axis=0)[:, 1]
        own = np.bincount(np.searchsorted(distinct, pairs), minlength=len(distinct))
        counts = self.seen(distinct)
        counts[:, 0 if toxic else 1] -= own
        counts[:, 2] -= own
        return self.ratios(np.maximum(counts, 0))[place]


def fit(labelled: DataFrame) -> Model:
    """Kneser-Ney models of the rows (text, toxic); word counts are written to the shared folder once."""
    spark, folder = labelled.sparkSession, scratch_path(labelled.sparkSession, "contexts")
    pairs = labelled.select("text", "toxic").mapInArrow(_contexts, "v long, w long, t long, o long")
    pairs = pairs.groupBy("v", "w").agg(F.max("t").alias("t"), F.max("o").alias("o"))
    words = pairs.groupBy("w").agg(*[F.sum(c).cast("int").alias(c) for c in "to"], F.count("*").cast("int").alias("n"))
    words.write.parquet(folder)
    words = spark.read.schema("w long, t int, o int, n int").parquet(folder)
    sums = words.agg(*[F.sum(c) for c in "ton"], *[F.sum(F.least(F.col(c), F.lit(DISCOUNT))) for c in "to"]).first()
    totals = np.maximum(np.array([x or 0 for x in sums[:3]], float), 1)
    back = np.maximum(np.array([x or 0 for x in sums[3:]], float), 1e-9) / totals[:2]
    known = words.filter("n > 1").toPandas()
    keys = known["w"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Model(keys[order], known[["t", "o", "n"]].to_numpy(np.int32)[order], totals, back)


def _compare(model, text: str, schema: pa.Schema, label: str | None):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            data, offsets = utf8(batch[text])
            mean, top, size = np.zeros(len(batch)), np.zeros(len(batch)), np.zeros(len(batch), np.int64)
            for a, b in slices(offsets, CHUNK):
                words, firsts = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], True, NOT_LETTERS)
                n = np.diff(firsts)
                size[a:b] = n
                if label:
                    toxic = batch[label].to_pylist()
                    parts = [known.left_out(words[firsts[i] : firsts[i + 1]], toxic[a + i] == 1) for i in range(b - a) if n[i]]
                    ratios = np.concatenate([np.zeros(0), *parts])
                else:
                    ratios = known.log_ratios(words)
                mean[a:b] = np.diff(np.concatenate(([0.0], np.cumsum(ratios)))[firsts]) / np.maximum(n, 1)
                ranked = np.sort(np.repeat(np.arange(b - a) * 1e3, n) + ratios)  # by row, then by ratio
                for k in range(1, TELLING + 1):
                    row = np.flatnonzero(n >= k)
                    top[a + row] += (ranked[firsts[row + 1] - k] - row * 1e3) / TELLING
            kept = [batch[n] for n in schema.names[:-3]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(mean), pa.array(top), pa.array(size)], schema=schema)

    return compare


def compare_models(df: DataFrame, model, text: str, keep: list[str], label: str | None = None) -> DataFrame:
    """The columns ``keep`` and the difference of both log-likelihoods: over the text, over its telling words; and its words.

    With ``label``, rows are those of the sample, and each is compared as if it had been left out of it.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    own = [T.StructField("__mean", T.DoubleType()), T.StructField("__top", T.DoubleType()), T.StructField("__n", T.LongType())]
    schema = T.StructType([df.schema[c] for c in keep] + own)
    columns = [F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])]
    return df.select(*columns).mapInArrow(_compare(model, text, to_arrow_schema(schema), label), schema)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.1, rounds: int = 60) -> np.ndarray:
    """Intercept and weights of a logistic curve of weighted rows by Newton's method, with a small ridge on the weights."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(x.shape[1]), penalty * np.eye(x.shape[1])
    ridge[0, 0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T * (weight * p * (1 - p)) @ x + ridge, x.T @ (weight * (y - p)) - ridge @ beta)
        beta += np.clip(step, -5, 5)
    return beta


def score_toxicity(
    df: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    bound: int = BOUND,
) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.3 on) to every row of ``df``.

    ``learn`` is a condition on ``key`` that says which labelled rows may be learned from.
    """
    spark = df.sparkSession
    df = df.drop("score", "predicted")
    k = F.col(f"`{key}`")
    taught = labels.select(k, F.col(f"`{label}`").cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1) & k.isNotNull()).distinct()
    if learn is not None:
        taught = taught.filter(learn)
    # draws follow a hash of the id
    draw = F.pmod(F.xxhash64(k, F.lit("draw")), F.lit(1_000_000)) / 1_000_000
    sizes = {r["toxic"]: r["n"] for r in taught.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return df.withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))
    share = {y: min(1.0, bound / n) for y, n in sizes.items()}
    sample = taught.filter(draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])).select(k, "toxic")
    folder = scratch_path(spark, "taught")
    # the sample's ids are bounded by ``bound``, so the texts stay where they are
    df.select(k, F.col(f"`{text}`").alias("text")).join(F.broadcast(sample), key).select("text", "toxic").write.parquet(folder)
    sample = spark.read.schema("text string, toxic int").parquet(folder)

    model = spark.sparkContext.broadcast(fit(sample))
    seen = compare_models(sample, model, "text", ["toxic"], "toxic").toPandas()
    if seen["toxic"].nunique() < 2:
        return df.withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))
    x = np.column_stack([seen["__mean"], seen["__top"], np.log(seen["__n"] + 1)])
    y = seen["toxic"].to_numpy(float)
    beta = [float(b) for b in logistic(x, y, np.where(y == 1, 1 / share[1], 1 / share[0]))]
    z = beta[0] + beta[1] * F.col("__mean") + beta[2] * F.col("__top") + beta[3] * F.log(F.col("__n") + 1)
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    scored = compare_models(df, model, text, df.columns).withColumn("score", score)
    return scored.drop("__mean", "__top", "__n").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def in_training(key: str = "doc_id") -> Column:
    """The rows whose labels may be learned."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 != 2


@query("op1_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels outside the held-out quarter."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = score_toxicity(documents, labels, in_training())
    return scored.select("doc_id", F.coalesce(~in_training(), F.lit(False)).alias("held_out"), "score", "predicted")
