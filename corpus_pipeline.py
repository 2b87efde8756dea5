"""Corpus pipeline: drop toxic documents and near duplicates, cut repeated passages, mask personal data, pack.

Each stage works on all that the one before kept; ``run`` writes a stage's rows to the shared folder
and reads them again for the next. All stages but the last return the columns of ``documents``, with
``n_chars`` following the text; the last returns a row for each packed piece.

Edge cases: null texts pass every stage as they are, count as empty when packed, and are neither
duplicates nor toxic unless an empty text scores so; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.near_duplicates import drop_near_duplicates
from bazaarlens.llm.packing import pack_documents
from bazaarlens.llm.personal_data import find_personal_data, redact
from bazaarlens.llm.registry import table
from bazaarlens.llm.repeats import remove_repeats
from bazaarlens.llm.toxicity import in_training, score_toxicity
from bazaarlens.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of the table, with the length of the text as it is now."""
    return df.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; learned from the labels of documents still here."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return _documents(score_toxicity(docs, labels, in_training()).filter("predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least id."""
    return _documents(drop_near_duplicates(docs))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document holds; what has lost all its words goes."""
    cut = remove_repeats(docs)
    return _documents(cut.filter("n_removed = 0 or n_removed < n_words"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a tag in place of each span of personal data."""
    return _documents(redact(find_personal_data(docs, out="__spans"), spans="__spans"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of 4096 tokens."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

# No stage's learned scores, sampled joins or tokens can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = scratch_path(spark, f"stage_{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
