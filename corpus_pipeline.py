"""Training-data pipeline: STAGES applied to documents one after another, each written as Parquet and read again.

Defined results. Null and empty texts are kept by the quality classifier, are copies of each other, hold no benchmark
item and no secret, and have no ids. Rows without a doc_id are no copies of others and stay. Rows that repeat a doc_id
are judged each by its own text; equal rows are copies, of which one stays. Columns that the stages do not know pass
through, whatever their names, up to the last stage, which returns doc_id, n_tokens and ids. An empty table gives an
empty result. Long texts are processed whole.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import decontamination, pieces, quality, secrets, simhash
from sedimenta.llm.base import scratch, shared_dir, table
from sedimenta.llm.queries import public_tokenizer
from sedimenta.plans.durable import relieve, remove


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly trained scorer rejects go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the document with the smallest doc_id stays.

    SimHash covering finds the pairs within its radius, prefixes of ordered shingles all others: no link is left out.
    """
    return simhash.one_of_each(docs, width=5, similarity=0.8)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text give way to a mark; n_chars follows the text."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the ids of the text."""
    encoded = pieces.encode(docs.select("doc_id", "text"), public_tokenizer("piece_bpe_32k.model"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


#: Rows of an Arrow batch between Spark and Python: texts are long, and executors and workers hold whole batches.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _small_batches(stage: Callable) -> Callable:
    """The stage, with small Arrow batches in the session: its rows are computed only when they are written. run() restores the setting."""

    @functools.wraps(stage)
    def small(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return small


STAGES = [(f.__name__, _small_batches(f)) for f in (quality_classifier, near_duplicates, benchmark_decontamination, secret_scan, piece_ids)]

#: SQL cannot express these stages; tests/llm holds them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's result is written; what the stage itself has written, and its input, are removed."""
    docs, before = table(spark, sf_dir, "documents"), None
    own = spark.conf.get(_BATCH)
    try:
        for _, stage in STAGES:
            target = shared_dir(spark)
            with scratch(spark):
                made = stage(spark, docs, sf_dir)
                made.write.option("compression", "zstd").parquet(target)
            docs = spark.read.schema(made.schema).parquet(target)
            if before:
                remove(spark, before)
            before = target
            relieve(spark)
    finally:
        spark.conf.set(_BATCH, own)
    return docs
