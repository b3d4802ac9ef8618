"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns
of ``documents``; rows with NULL or empty texts pass through, and tables without any
row give tables without any row. Columns beyond those of ``documents`` are kept.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellgauge.llm import bpe, decontaminate, secrets, simhash, toxicity
from wellgauge.llm.common import SLICE_BYTES, columns_of, free_name, staged
from wellgauge.llm.queries import RANKS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _in_small_batches(stage: Stage) -> Stage:
    """Rows go to Python workers some megabytes at a time, unless the session says
    otherwise. Spark's own bound, 64 MB, is held several times over by each task: as it
    is filled, sent, read, and in what is made of it."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(_BATCH_BYTES, None) is None:
            spark.conf.set(_BATCH_BYTES, SLICE_BYTES)
        return stage(spark, docs, sf_dir)

    return run_stage


@_in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic than not go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, "toxic", split_yes=True)
    return toxicity.without_toxic(docs, model)


@_in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id."""
    return simhash.representatives(docs, shingle=3, radius=2)


@_in_small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, benchmark)


@_in_small_batches
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by marks, and ``n_chars`` follows the text."""
    before = free_name(docs, "before")
    marked = secrets.redact(docs.withColumn(before, F.xxhash64("text")))
    changed = F.xxhash64("text") != F.col(before)
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return marked.withColumn("n_chars", n_chars).select(*columns_of(docs))


@_in_small_batches
def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with the byte offset at which each token ends."""
    return bpe.encode(docs, RANKS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("byte_bpe", encode_texts),
]

# Hashes, fitted weights and merges are beyond SQL: tests hold each stage against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
