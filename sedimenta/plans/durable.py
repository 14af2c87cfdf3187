"""Results that survive lost executors: Parquet below the folder that spark.checkpoint.dir names, and tables in versions."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


#: Folders that shared_dir has named within scratch() in this thread.
_named: ContextVar[list[str] | None] = ContextVar("named", default=None)


def shared_dir(spark: SparkSession) -> str:
    """A fresh path below spark.checkpoint.dir; a local folder stands in only where that is unset and Spark runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sedimenta-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    if (named := _named.get()) is not None:
        named.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate results that are written inside are removed at the end: what is to stay must have been written elsewhere by then."""
    token = _named.set(named := [])
    try:
        yield
    finally:
        _named.reset(token)
        for path in named:
            remove(spark, path)


def _path(spark: SparkSession, path: str):
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()), name


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, that of the cluster where it names none."""
    fs, name = _path(spark, path)
    return re.sub("^file:/+", "file:///", fs.makeQualified(name).toString())


def exists(spark: SparkSession, path: str) -> bool:
    fs, name = _path(spark, path)
    return fs.exists(name)


def remove(spark: SparkSession, path: str) -> None:
    fs, name = _path(spark, path)
    fs.delete(name, True)


def materialize(df: DataFrame) -> DataFrame:
    """Writes df below the shared folder and reads it back; lineage ends there."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def relieve(spark: SparkSession) -> None:
    """Lets Spark clear what large finished jobs have left: broadcasts in the executors' memory, their shuffle files on disk.

    Spark clears these only once the driver's collector has found their plans unused, by itself perhaps half an hour
    later, and offers no other call for it. For use after jobs that shuffle a multiple of their input, not within loops.
    """
    spark._jvm.System.gc()


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the whole versions of a table, oldest first."""
    fs, name = _path(spark, path)
    found = [x.getPath().getName() for x in fs.listStatus(name)] if fs.exists(name) else []
    return sorted(int(x[2:]) for x in found if re.fullmatch(r"v=\d+", x) and exists(spark, f"{path}/{x}/_SUCCESS"))


def write_version(df: DataFrame, path: str, keep: int = 2) -> str:
    """Writes a table as its next version, v=N below path, and then removes all but the last `keep`. One that fails is never read."""
    spark = df.sparkSession
    before = versions(spark, path)
    target = f"{path}/v={before[-1] + 1 if before else 1}"
    df.write.mode("overwrite").parquet(target)  # what a failed attempt has left goes
    for old in before[: len(before) + 1 - keep]:
        remove(spark, f"{path}/v={old}")
    return target


def read_version(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame | None:
    """The last whole version of a table; None if there is none."""
    known = versions(spark, path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{path}/v={known[-1]}") if known else None


@contextmanager
def settings(spark: SparkSession, **own: str) -> Iterator[None]:
    """The session with settings of its own (dots as __), for jobs and streams that start inside."""
    keys = {k.replace("__", "."): v for k, v in own.items()}
    before = {k: spark.conf.getAll.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def spread(df: DataFrame) -> DataFrame:
    """df dealt out to all cores if it comes in fewer pieces than there are; a table of some size stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
