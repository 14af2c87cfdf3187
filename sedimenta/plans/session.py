"""Makes the package importable for Python workers on executors."""

from __future__ import annotations

import functools
import importlib.util
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(importlib.util.find_spec("sedimenta").origin).parent
    handle, target = tempfile.mkstemp(prefix="sedimenta-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


#: Bytes of an Arrow batch between Spark and Python. Spark's own 64 MB are held several times over by each worker (as Arrow, as
#: objects, as results), so a worker's memory grew with its partition until a batch was full.
BATCH_BYTES = "4194304b"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def batches(spark: SparkSession, small: bool) -> None:
    """Small batches in the session, or Spark's own again; a limit that was set by others stays.

    Rows are computed only when a query's result is written, so the setting stays when the query returns.
    """
    own = spark.conf.getAll.get(_BATCH)
    if small and own is None:
        spark.conf.set(_BATCH, BATCH_BYTES)
    elif not small and own == BATCH_BYTES:
        spark.conf.unset(_BATCH)


def shipped(query: Callable[[SparkSession, str], DataFrame], small: bool = True) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with the package on the executors. small: in small batches; the operators for training data, which gain by
    large ones, set their own."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        batches(spark, small)
        return query(spark, sf_dir)

    return run
