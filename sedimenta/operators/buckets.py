"""An output in buckets by source: patches and new documents rewrite only the buckets that they touch.

A bucket is a folder (bucket=N) of a table in Parquet, named by a hash of the source. What is touched is found from the
changes alone; other buckets are neither read nor written, and their files keep their names. The new rows of the touched buckets are
written apart first and then put in their place (dynamic partition overwrite), so a run that fails before leaves the table as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.durable import exists, materialize
from .corpus import patch, resume

BUCKETS = 256
_BUCKET = "bucket"


def bucket_of(source: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(source), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, mode: str) -> None:
    """A task writes one bucket; a large one is dealt to several tasks by Spark."""
    dealt = rows.hint("rebalance", _BUCKET)
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(path)


def write_buckets(documents: DataFrame, path: str, buckets: int = BUCKETS, key: str = "fuente") -> None:
    """The documents as a new table; what was there goes."""
    rows = documents.withColumn(_BUCKET, bucket_of(F.col(key), buckets))
    rows.hint("rebalance", _BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(_BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str, schema) -> DataFrame:
    """The documents. schema: theirs, without the bucket."""
    return spark.read.schema(_with_bucket(spark, schema)).parquet(path).drop(_BUCKET)


def _with_bucket(spark: SparkSession, schema):
    return spark.createDataFrame([], schema).withColumn(_BUCKET, F.lit(0)).schema


def patch_in_place(spark: SparkSession, path: str, schema, changes: DataFrame, buckets: int = BUCKETS, key: str = "fuente") -> int:
    """corpus.patch() of the table at path, in the buckets of the changes without error; returns how many were rewritten.

    A change whose source the table doesn't hold makes its bucket be read, but a bucket without any hit isn't written.
    """
    made = materialize(changes.where("error is null").withColumn(_BUCKET, bucket_of(F.col(key), buckets)))
    touched = [r[_BUCKET] for r in made.select(_BUCKET).distinct().collect()]  # numbers of buckets, as many as there are at most
    if not touched or not exists(spark, path):
        return 0
    table = spark.read.schema(_with_bucket(spark, schema)).parquet(path)
    own = table.where(F.col(_BUCKET).isin(touched))
    hit = own.select(key, _BUCKET).join(made.select(key), key, "left_semi").select(_BUCKET).distinct().collect()
    hit = [r[_BUCKET] for r in hit]
    if hit:
        _write(materialize(patch(own.where(F.col(_BUCKET).isin(hit)), made.drop(_BUCKET), key)), path, "overwrite")
    return len(hit)


def append_new(spark: SparkSession, path: str, documents: DataFrame, buckets: int = BUCKETS, key: str = "fuente") -> DataFrame:
    """Adds the documents whose source the table doesn't hold, as files of their buckets; returns them. Only sources of their buckets are read."""
    rows = documents.withColumn(_BUCKET, bucket_of(F.col(key), buckets))
    if exists(spark, path):
        touched = [r[_BUCKET] for r in rows.select(_BUCKET).distinct().collect()]
        table = spark.read.schema(_with_bucket(spark, documents.select(key).schema)).parquet(path)
        rows = resume(rows, table.where(F.col(_BUCKET).isin(touched)), key)
    new = materialize(rows)
    _write(new, path, "append")
    return new.drop(_BUCKET)
