"""Dense vectors (arrays) and sparse ones (maps of token id to weight) as column expressions, and encoders."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.durable import materialize

QUERY_PREFIX, PASSAGE_PREFIX = "query: ", "passage: "
MAX_TOKENS, DIMENSION, BATCH = 512, 1024, 8


def _double(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(_double(a), _double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance, which a flat L2 index ranks by."""
    return F.aggregate(F.zip_with(_double(a), _double(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(_double(v), F.lit(0.0), lambda s, x: s + x * x))


def l2_normalize(v: Column) -> Column:
    """v at unit length; a zero vector stays."""
    n = l2_norm(v)
    return F.when(n == 0, _double(v)).otherwise(F.transform(_double(v), lambda x: x / n))


def sparse_dot(a: Column, b: Column) -> Column:
    """Sum of products over the token ids that both maps hold; the keys of the smaller one are walked."""

    def over(small: Column, large: Column) -> Column:
        return F.aggregate(F.map_entries(small), F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.try_element_at(large, e["key"]), F.lit(0.0)))

    return F.when(F.size(a) <= F.size(b), over(a, b)).otherwise(over(b, a))


def sparse_positive(v: Column) -> Column:
    """Only positive weights, with integer token ids."""
    return F.transform_keys(F.map_filter(v, lambda k, w: w > 0), lambda k, w: k.cast("int"))


#: Rows and bytes of a block of vectors at most; cells of the grid for each shuffle partition.
BLOCK_ROWS, BLOCK_BYTES, CELLS = 1024, 8 << 20, 2
#: Where every pair is a row: pairs of a task on average at most, and how many of its first rows are put in order.
TASK_PAIRS, HEAD_ROWS = 1 << 24, 1 << 16
_BLOCK = "d int, place long, n int, ids binary, vectors binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of (id, v) of one length."""
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        lists = batch.column("v")
        lengths, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)
        start = np.cumsum(lengths) - lengths
        ids = batch.column("id").to_numpy().astype(np.int64)
        for d in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == d)
            step = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(d, 1))))
            for at in range(0, len(rows), step):
                own = rows[at : at + step]
                vectors = flat[start[own][:, None] + np.arange(d)]
                columns = {
                    "d": pa.array([d], pa.int32()),
                    "place": pa.array([part << 32 | n]),
                    "n": pa.array([len(own)], pa.int32()),
                    "ids": pa.array([ids[own].tobytes()], pa.binary()),
                    "vectors": pa.array([vectors.tobytes()], pa.binary())
                }
                n += 1
                yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])


def _packed(rows: DataFrame, name: str, vector: str) -> DataFrame:
    v = F.col(vector)
    whole = rows.where(F.col(name).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull()))
    return whole.select(F.col(name).cast("long").alias("id"), _double(v).alias("v")).mapInArrow(_pack, _BLOCK)


def _meet(queries: DataFrame, vectors: DataFrame, most: int | None = None) -> DataFrame:
    """Each block of queries beside each block of vectors of the same length.

    Vectors are dealt into rows and queries into columns of a grid, and a cell is joined in one place: nothing passes
    through the driver, and plan and passes stay the same however many queries there are. most: pairs of a task on
    average, beyond which there are more tasks than the session's.
    """
    spark = vectors.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    q, v = materialize(_packed(queries, "query_id", "q")), _packed(vectors, "vec_id", "embedding")
    n_queries, n_vectors = q.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], vectors.count()
    if most:
        parts = max(parts, -(-n_queries * n_vectors // most))
    columns = max(1, round((CELLS * parts * n_queries / max(n_vectors, 1)) ** 0.5))
    rows = max(1, CELLS * parts // columns)
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = q.select(
        "d",
        F.col("ids").alias("q_ids"),
        F.col("vectors").alias("q_vectors"),
        F.pmod(F.xxhash64("place"), F.lit(columns)).alias("column"),
        numbers(rows).alias("row")
    )
    right = v.select("d", "ids", "vectors", F.pmod(F.xxhash64("place"), F.lit(rows)).alias("row"), numbers(columns).alias("column"))
    cell = ["d", "row", "column"]
    return left.repartition(parts, *cell).join(right.repartition(parts, *cell).hint("merge"), cell)


def _arrays(row: dict, ids: str, vectors: str) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(row[ids], np.int64)
    return names, np.frombuffer(row[vectors], np.float64).reshape(len(names), row["d"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


def _head_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, about the first HEAD_ROWS of a task by score, so that equal scores meet."""
    head, n = [], 0
    while n < HEAD_ROWS and (batch := next(batches, None)) is not None:
        head.append(batch)
        n += batch.num_rows
    if head:
        yield from pa.Table.from_batches(head).sort_by("score").to_batches(max_chunksize=BLOCK_ROWS)
    yield from batches


def similarities(queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query_id, vec_id, score): inner products of a stated set of queries (query_id, q) with all vectors (vec_id, embedding).

    Every pair is a row: for the few queries whose whole matrix is wanted. nearest() keeps the best alone. Rounded
    scores are few, but Parquet writes each in full (8 bytes, not 2) unless a file's first 20,000 rows repeat them:
    hence a task begins with rows in order of score, and is held to about one row group.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            (q_ids, q), (ids, v) = _arrays(row, "q_ids", "q_vectors"), _arrays(row, "ids", "vectors")
            for k, name in enumerate(q_ids.tolist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), name)), pa.array(ids), pa.array((v * q[k]).sum(1))],
                    names=["query_id", "vec_id", "score"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _head_in_order(pairs(batches))

    return _meet(queries, vectors, TASK_PAIRS).mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(queries: DataFrame, vectors: DataFrame, k: int, by: str = "l2") -> DataFrame:
    """(query_id, vec_id, score, rank): each query's k nearest by squared distance ('l2') or inner product ('dot'). Ties: smaller vec_id.

    A matrix product tells which candidates can be among the best, within its rounding; these are scored one by one, term
    by term, so equal vectors score alike and large norms do not cancel. Each cell keeps its own k best, which one
    shuffle merges. Rows with a null id, a null vector or a null component take no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            (q_ids, q), (ids, v) = _arrays(row, "q_ids", "q_vectors"), _arrays(row, "ids", "vectors")
            squares, q_squares = (v * v).sum(1), (q * q).sum(1)
            rough = -(q @ v.T)
            if by == "l2":
                rough = q_squares[:, None] + squares + 2 * rough
            slack = (q_squares[:, None] + squares.max(initial=0)) * ((v.shape[1] + 8) * 2.0**-50)
            least = np.partition(rough, k - 1, axis=1)[:, k - 1 : k] if len(ids) > k else np.full((len(q), 1), np.inf)
            # where a number leaves its range, all candidates are scored
            maybe = ~(rough > least + 2 * slack)
            parts = []
            for i in range(len(q_ids)):
                near = np.flatnonzero(maybe[i])
                cost = ((v[near] - q[i]) ** 2).sum(1) if by == "l2" else -(v[near] * q[i]).sum(1)
                order = np.lexsort((ids[near], cost))[:k]
                parts.append((np.full(len(order), q_ids[i]), ids[near[order]], cost[order]))
            if parts:
                names, found, cost = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(found), pa.array(cost if by == "l2" else -cost)], names=["query_id", "vec_id", "score"])

    if by not in ("l2", "dot"):
        raise ValueError(f"no such order: {by}")
    order = F.asc("score") if by == "l2" else F.desc("score")
    found = _meet(queries, vectors).mapInArrow(run, "query_id long, vec_id long, score double")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id"))).where(F.col("rank") <= k)


def search_index(queries: DataFrame, index: DataFrame, k: int, by: str = "l2") -> DataFrame:
    """nearest() over an index as sinks.write_index leaves it, with the metadata of what was found."""
    return nearest(queries, index.select("vec_id", "embedding"), k, by).join(index.drop("embedding"), "vec_id")


# ---------------------------------------------------------------- encoders

_TOKEN = re.compile(r"\w+")


class HashEncoder:
    """A deterministic stand-in for a trained encoder: tokens hashed to signed dimensions and to weights. One pass gives both heads.

    A text with tokens always has a unit vector: where the signs cancel in every dimension, the tokens count without them.
    Tokens are lower-cased one by one, so a letter that becomes several doesn't part them.
    """

    def __init__(self, dimension: int = DIMENSION, max_tokens: int = MAX_TOKENS):
        self.dimension, self.max_tokens = dimension, max_tokens

    def count_tokens(self, text: str) -> int:
        return len(_TOKEN.findall(text))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[dict[int, float]]]:
        dense, sparse = np.zeros((len(texts), self.dimension), np.float32), []
        for row, text in enumerate(texts):
            weights: dict[int, float] = {}
            hashes = []
            for token in _TOKEN.findall(text)[: self.max_tokens]:
                h = int.from_bytes(hashlib.blake2b(token.lower().encode(), digest_size=8).digest(), "little")
                dense[row, h % self.dimension] += 1.0 if h >> 63 else -1.0
                weights[h % 30000] = weights.get(h % 30000, 0.0) + 1.0
                hashes.append(h)
            if hashes and not dense[row].any():
                for h in hashes:
                    dense[row, h % self.dimension] += 1.0
            sparse.append(weights)
        norms = np.linalg.norm(dense, axis=1, keepdims=True)
        return dense / np.where(norms == 0, 1, norms), sparse


def pick_device(wanted: str | None = None) -> str:
    """Where a model runs: as wanted, else on the first GPU that the installed library sees, else on the CPU."""
    if wanted:
        return wanted
    try:
        import torch
    except ImportError:
        return "cpu"
    return "cuda" if torch.cuda.is_available() else "cpu"


class DenseEncoder:
    """A trained sentence encoder, where its library and model are installed: unit vectors, no sparse head."""

    def __init__(self, name: str, max_tokens: int = MAX_TOKENS, device: str | None = None):
        from sentence_transformers import SentenceTransformer

        self.model = SentenceTransformer(name, device=pick_device(device))
        self.model.max_seq_length = max_tokens

    def count_tokens(self, text: str) -> int:
        return len(self.model.tokenizer(text, truncation=False)["input_ids"])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[dict[int, float]]]:
        dense = self.model.encode(texts, batch_size=BATCH, normalize_embeddings=True, convert_to_numpy=True, show_progress_bar=False)
        return np.asarray(dense, np.float32), [{} for _ in texts]


class TwoHeadEncoder:
    """A trained encoder with a dense and a lexical head, where its library and model are installed: both from one pass."""

    def __init__(self, name: str, max_tokens: int = MAX_TOKENS, device: str | None = None):
        from FlagEmbedding import BGEM3FlagModel

        device = pick_device(device)
        self.model, self.max_tokens = BGEM3FlagModel(name, use_fp16=device != "cpu", devices=[device]), max_tokens

    def count_tokens(self, text: str) -> int:
        return len(self.model.tokenizer(text, truncation=False)["input_ids"])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[dict[int, float]]]:
        both = self.model.encode(texts, batch_size=BATCH, max_length=self.max_tokens, return_dense=True, return_sparse=True)
        sparse = [{int(t): float(w) for t, w in weights.items() if w > 0} for weights in both["lexical_weights"]]
        return np.asarray(both["dense_vecs"], np.float32), sparse


#: Encoders by name: a function without arguments, called once for each Python worker.
ENCODERS: dict[str, Callable[[], HashEncoder | DenseEncoder | TwoHeadEncoder]] = {
    "hash": HashEncoder,
    "hash64": lambda: HashEncoder(64),
    "e5": lambda: DenseEncoder("intfloat/multilingual-e5-large"),
    "bge-m3": lambda: TwoHeadEncoder("BAAI/bge-m3"),
}
_loaded: dict[str, HashEncoder] = {}

ENCODED = T.StructType([
    T.StructField("dense", T.ArrayType(T.FloatType())),
    T.StructField("sparse", T.MapType(T.IntegerType(), T.DoubleType())),
    T.StructField("n_tokens", T.IntegerType())
])


def encode_texts(text: Column, encoder="hash", mode: str | None = "passage", batch: int = 256) -> Column:
    """A struct of dense vector, sparse vector and number of tokens. Every text gets the prefix of its mode; null counts as empty.

    encoder: a name in ENCODERS, or an encoder that is sent along, such as operators.latent.LatentModel. mode: None for no prefix.
    batch: texts that a worker encodes and hands on at a time; it holds no more vectors than theirs.
    """
    prefix = {"query": QUERY_PREFIX, "passage": PASSAGE_PREFIX, None: ""}[mode]
    named = isinstance(encoder, str)
    if named and encoder not in ENCODERS:
        raise ValueError(f"no encoder named {encoder}")

    @F.pandas_udf(ENCODED)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if named and encoder not in _loaded:
            _loaded[encoder] = ENCODERS[encoder]()
        model = _loaded[encoder] if named else encoder
        for part in parts:
            for at in range(0, len(part), batch):
                texts = [prefix + (t or "") for t in part.iloc[at : at + batch]]
                dense, sparse = model.encode(texts)
                yield pd.DataFrame({"dense": [*dense], "sparse": sparse, "n_tokens": [model.count_tokens(t) for t in texts]})

    return run(text)


def prefixed(text: Column, mode: str) -> Column:
    return F.concat(F.lit({"query": QUERY_PREFIX, "passage": PASSAGE_PREFIX}[mode]), text)
