"""Dense vectors that carry meaning, learned from the corpus itself: latent semantic analysis.

Tokens are hashed to BUCKETS columns and weighted by (1 + log n) * idf; rows have unit length. The leading right singular
vectors of that matrix come from a randomised range finder with power rounds (Halko, Martinsson and Tropp, 2011). Tokens
are counted once; each pass over the counts adds up A'(AQ) in every task, and these small matrices are added by chunks
in two steps, so that no task holds many of them. Only BUCKETS x (dimension + OVER) numbers reach the driver, whatever the corpus's size.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.durable import materialize, read_version, scratch, write_version

BUCKETS, DIMENSION = 4096, 64
#: Directions beside those wanted, and passes that sharpen them.
OVER, ROUNDS = 16, 3
#: Buckets of a chunk of a matrix; tasks whose matrices are added in the first step.
_CHUNK, _FAN = 256, 256
_TOKEN = re.compile(r"\w+")


def bucket(token: str, buckets: int = BUCKETS) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % buckets


def counted(texts, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, n) of the tokens of texts, by row; null counts as empty."""
    found = [Counter(bucket(t, buckets) for t in _TOKEN.findall(text.lower())) if isinstance(text, str) else {} for text in texts]
    row = np.repeat(np.arange(len(found)), [len(c) for c in found])
    return row, np.array([b for c in found for b in c], np.int64), np.array([n for c in found for n in c.values()], np.float64)


@dataclass
class LatentModel:
    """An encoder with both heads: projected vectors of unit length, and the weights of the buckets. idf: of each bucket; projection: (buckets, dimension)."""

    idf: np.ndarray
    projection: np.ndarray

    def weighted(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, bucket, weight), each row at unit length."""
        row, column, n = counted(texts, len(self.idf))
        return row, column, self.weights(len(texts), row, column, n)

    def weights(self, texts: int, row: np.ndarray, column: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The weights of so many texts' counts."""
        value = (1 + np.log(n)) * self.idf[column] if len(n) else n
        norm = np.sqrt(np.bincount(row, value * value, minlength=texts))
        return value / np.where(norm > 0, norm, 1)[row]

    def count_tokens(self, text: str) -> int:
        return len(_TOKEN.findall(text))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[dict[int, float]]]:
        row, column, value = self.weighted(texts)
        dense = matrix(len(texts), row, column, value, len(self.idf)) @ self.projection
        norms = np.linalg.norm(dense, axis=1, keepdims=True)
        sparse: list[dict[int, float]] = [{} for _ in texts]
        for r, c, v in zip(row.tolist(), column.tolist(), value.tolist(), strict=True):
            if v > 0:
                sparse[r][c] = v
        return (dense / np.where(norms == 0, 1, norms)).astype(np.float32), sparse


def matrix(texts: int, row: np.ndarray, column: np.ndarray, value: np.ndarray, buckets: int) -> np.ndarray:
    """The weights of so many texts with their zeros: a few MB for a block of texts, however long these are."""
    out = np.zeros((texts, buckets))
    out[row, column] = value
    return out


def _added(chunks: DataFrame, *keys: str) -> DataFrame:
    """Matrices of (chunk, part, m) added by the keys."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(m) for m in rows["m"]], axis=0)
        return pd.DataFrame({"chunk": rows["chunk"][:1], "part": rows["part"][:1], "m": [total.tobytes()]})

    return chunks.groupBy(*keys).applyInPandas(add, chunks.schema)


#: Texts of a block whose tokens are counted together.
_TEXTS = 256


def _blocks(texts: DataFrame, buckets: int) -> DataFrame:
    """The token counts of all texts, a row for up to _TEXTS of them: how many buckets each text has, these, and their counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            held = rows["text"].tolist()
            for at in range(0, len(held), _TEXTS):
                own = held[at : at + _TEXTS]
                row, column, n = counted(own, buckets)
                arrays = np.bincount(row, minlength=len(own)), column, n
                yield pd.DataFrame([[x.astype(np.int32).tobytes() for x in arrays]], columns=["widths", "columns", "n"])

    return texts.mapInPandas(run, "widths binary, columns binary, n binary")


def _opened(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(texts, row, bucket, n) of each block."""
    for rows in batches:
        for block in zip(rows["widths"], rows["columns"], rows["n"], strict=True):
            widths, column, n = (np.frombuffer(x, np.int32) for x in block)
            yield len(widths), np.repeat(np.arange(len(widths)), widths), column.astype(np.int64), n.astype(np.float64)


def _gram(blocks: DataFrame, model: LatentModel, basis: np.ndarray) -> np.ndarray:
    """A'(A basis), where A has the weighted texts as its rows."""
    width = basis.shape[1]
    shared = blocks.sparkSession.sparkContext.broadcast((model, basis))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, q = shared.value
        total, part = np.zeros((len(q), width)), TaskContext.get().partitionId() % _FAN
        for texts, row, column, n in _opened(batches):
            if len(row):
                a = matrix(texts, row, column, own.weights(texts, row, column, n), len(q))
                total += a.T @ (a @ q)
        cut = [total[k : k + _CHUNK].tobytes() for k in range(0, len(total), _CHUNK)]
        yield pd.DataFrame({"chunk": np.arange(len(cut)), "part": part, "m": cut})

    parts = blocks.mapInPandas(run, "chunk long, part long, m binary")
    found = _added(_added(parts, "chunk", "part"), "chunk").collect()
    shared.destroy()
    out = np.zeros_like(basis)
    for r in found:
        m = np.frombuffer(r["m"]).reshape(-1, width)
        out[r["chunk"] * _CHUNK : r["chunk"] * _CHUNK + len(m)] = m
    return out


def fit(documents: DataFrame, dimension: int = DIMENSION, buckets: int = BUCKETS, rounds: int = ROUNDS, text: str = "text", seed: int = 42) -> LatentModel:
    """The model of all texts. Buckets that no text has stay zero; a corpus of few directions gives zeros for the rest.

    Texts are read once: each pass works on their counts, which are written by blocks and removed at the end.
    """
    with scratch(documents.sparkSession):
        texts = documents.select(F.col(text).alias("text")).where("text is not null")
        return _fitted(materialize(_blocks(texts, buckets)), dimension, buckets, rounds, seed)


def _fitted(blocks: DataFrame, dimension: int, buckets: int, rounds: int, seed: int) -> LatentModel:
    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(buckets, np.int64), 0
        for texts, _, column, _ in _opened(batches):
            total += np.bincount(column, minlength=buckets)
            n += texts
        yield pd.DataFrame({"bucket": np.r_[-1, np.flatnonzero(total)], "n": np.r_[n, total[total > 0]]})

    found = {r["bucket"]: r["n"] for r in blocks.mapInPandas(seen, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    n = found.pop(-1, 0)
    idf = np.zeros(buckets)
    for b, df in found.items():
        idf[b] = np.log((1 + n) / (1 + df)) + 1
    model = LatentModel(idf, np.zeros((buckets, dimension)))
    if not n:
        return model
    width = min(dimension + OVER, buckets)
    basis = np.random.default_rng(seed).standard_normal((buckets, width))
    for _ in range(rounds):
        basis = np.linalg.qr(_gram(blocks, model, basis))[0]
    values, turned = np.linalg.eigh(basis.T @ _gram(blocks, model, basis))
    best = np.argsort(-values, kind="stable")[:dimension]
    projection = basis @ turned[:, best] * (values[best] > 1e-9 * max(values.max(), 1e-300))
    sign = np.sign(projection[np.abs(projection).argmax(axis=0), np.arange(projection.shape[1])])
    model.projection[:, : len(best)] = projection * np.where(sign == 0, 1, sign)
    return model


def save(model: LatentModel, spark: SparkSession, path: str) -> None:
    """The model as a table in versions: (bucket, idf, row)."""
    rows = [(k, float(i), p.tolist()) for k, (i, p) in enumerate(zip(model.idf, model.projection, strict=True))]
    write_version(spark.createDataFrame(rows, "bucket long, idf double, row array<double>").coalesce(1), path)


def load(spark: SparkSession, path: str) -> LatentModel:
    found = read_version(spark, path)
    if found is None:
        raise FileNotFoundError(path)
    rows = sorted(found.collect(), key=lambda r: r["bucket"])
    return LatentModel(np.array([r["idf"] for r in rows]), np.array([r["row"] for r in rows]))


def encoded(documents: DataFrame, model: LatentModel, text: str = "text") -> DataFrame:
    """documents with dense, sparse and n_tokens; written, so that searches read it more than once."""
    from ..functions.vectors import encode_texts

    return materialize(documents.withColumn("e", encode_texts(F.col(text), model, None)).select(*documents.columns, "e.*"))
