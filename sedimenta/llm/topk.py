"""Exact top-k inner products by pivot elimination.

Distances of all vectors to a few dozen pivots are computed once, as the vectors are packed into blocks. For a query and
a candidate, the largest difference of their distances to a pivot bounds their own distance from below, and with both
norms their inner product from above. Candidates are scored in the order of this bound until it falls under the k-th
best score (at that score: until the vec_ids pass that of the k-th), so the result is exact, ties included. The bounds
allow for the rounding of distances and squares, in proportion to the magnitudes.

Vectors near the same pivot share a block, and a block knows the least and greatest distance to each pivot. Each query
starts with the k-th best score within the sample; a block of candidates whose bound is under that for all queries of
a block is dropped in the join, before any vector is looked at. Candidates are dealt into rows and queries into columns
of a grid; a cell is a task's work, so a vector travels once for each cell of its row or column, and no block of either
has to fit in one place with all of the other. Pivots are chosen (farthest first) from a bounded sample.

Defined results. Vectors that are null or hold null or non-finite components and rows with a null vec_id take no part;
all other values do, of any size. A score is exact: sums that leave 53 bits are added up in whole numbers, and one among
the k best that doesn't fit a long is an error that says so. A query is compared with vectors of its own length. A
query's own row is no candidate, but other rows with the same vec_id are, equal vectors included; a repeated query row
is answered each time. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import materialize

PIVOTS = 32
#: Vectors from which pivots and the queries' first thresholds come.
PIVOT_SAMPLE = 1024
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 1024
#: Bytes of components in a block at most.
BLOCK_BYTES = 4 << 20
#: Cells of the grid for each shuffle partition: several, so that their load evens out.
CELLS = 4

#: Distances are kept in single precision: their difference may be off by this share of their sum.
_NEAR = 2.0**-22
_LONG = 1 << 63
_BLOCK = "d int, place long, n int, ids binary, kind string, vectors binary, near binary, low array<float>, high array<float>, most double"
_QUERIES = _BLOCK + ", keys binary, copies binary, floors binary, least double"
_FOUND = "query_id long, key long, copies long, vec_id long, score long, over boolean"


def whole_numbers(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, as doubles, which hold it exactly."""

    def whole(x: Column) -> Column:
        y = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)

    return F.transform(embedding, whole)


def usable(embedding: Column) -> Column:
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))


def choose_pivots(rows: list[list[float]], n: int = PIVOTS) -> dict[int, np.ndarray]:
    """Farthest-first vectors of each length, from a sample."""
    out = {}
    for d in sorted({len(r) for r in rows}):
        own = [r for r in rows if len(r) == d]
        have = np.array(own, np.float64).reshape(len(own), d)
        with np.errstate(over="ignore"):
            chosen, far = [0], np.linalg.norm(have - have[0], axis=1)
            while len(chosen) < min(n, len(have)) and far.max() > 0:
                chosen.append(int(far.argmax()))
                far = np.minimum(far, np.linalg.norm(have - have[chosen[-1]], axis=1))
        out[d] = have[chosen]
    return out


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.zeros((len(vectors), len(pivots)), np.float32)
    with np.errstate(over="ignore"):
        for k, p in enumerate(pivots):
            out[:, k] = np.sqrt(((vectors - p) ** 2).sum(1))
    return out


def _squares(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (vectors * vectors).sum(1)


def _small(top: float, other: float, d: int) -> bool:
    """Whether inner products of d components up to these are exact in double precision."""
    return top * other * d < 2.0**53


def products(vectors: np.ndarray, q: np.ndarray) -> list[int]:
    """Exact inner products with q of whole numbers of any size."""
    own = [int(x) for x in q]
    return [sum(int(a) * b for a, b in zip(v, own, strict=True)) for v in vectors.tolist()]


def _floors(ids: np.ndarray, vectors: np.ndarray, sample: tuple[np.ndarray, np.ndarray], k: int) -> np.ndarray:
    """For each query a score that at least k other rows of the sample reach; -inf if there are too few."""
    names, have = sample
    out = np.full(len(ids), -np.inf)
    if len(names) > k and _small(np.abs(have).max(initial=0), np.abs(vectors).max(initial=0), have.shape[1]):
        scores = vectors @ have.T
        scores[ids[:, None] == names[None]] = -np.inf
        out = np.partition(scores, len(names) - k, axis=1)[:, len(names) - k]
    return out


def _pack(pivots: dict[int, np.ndarray], block: int, sample: dict[int, tuple] | None = None, k: int = 0):
    """Blocks of vectors, by length and nearest pivot; of queries, if there is a sample."""

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            lists = batch.column("v")
            lengths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            if not np.isfinite(flat).all():
                raise OverflowError("a scaled component leaves the range of doubles")
            start = np.cumsum(lengths) - lengths
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for d in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == d)
                whole = flat[start[rows][:, None] + np.arange(d)].reshape(len(rows), d)
                p = pivots.get(d, np.zeros((0, d)))
                distance = _distances(whole, p)
                home = distance.argmin(1) if len(p) else np.zeros(len(rows), np.int64)
                order = np.lexsort((distance[np.arange(len(rows)), home] if len(p) else ids[rows], home))
                size = max(1, min(block, BLOCK_BYTES // (8 * max(d, 1))))
                for at in range(0, len(order), size):
                    own = order[at : at + size]
                    own = own[np.argsort(ids[rows[own]], kind="stable")]
                    vectors, near, names = whole[own], distance[own], ids[rows[own]]
                    top = np.abs(vectors).max(initial=0)
                    kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8"
                    columns = {
                        "d": pa.array([d], pa.int32()),
                        "place": pa.array([part << 32 | n]),
                        "n": pa.array([len(own)], pa.int32()),
                        "ids": pa.array([names.tobytes()], pa.binary()),
                        "kind": pa.array([kind]),
                        "vectors": pa.array([vectors.astype(kind).tobytes()], pa.binary()),
                        "near": pa.array([near.T.tobytes()], pa.binary()),
                        "low": pa.array([near.min(0)], pa.list_(pa.float32())),
                        "high": pa.array([near.max(0)], pa.list_(pa.float32())),
                        "most": pa.array([_squares(vectors).max()]),
                    }
                    if sample is not None:
                        floors = _floors(names, vectors, sample.get(d, (np.empty(0, np.int64), np.zeros((0, d)))), k)
                        columns |= {c: pa.array([batch.column(c).to_numpy()[rows[own]].astype(np.int64).tobytes()], pa.binary()) for c in ("keys", "copies")}
                        columns |= {"floors": pa.array([floors.tobytes()], pa.binary()), "least": pa.array([floors.min()])}
                    n += 1
                    yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return run


class Block:
    """Candidates by rising id, with what their bounds need."""

    def __init__(self, d: int, ids: bytes, kind: str, vectors: bytes, near: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.vectors = np.frombuffer(vectors, kind).reshape(len(self.ids), d).astype(np.float64)
        self.near = np.frombuffer(near, np.float32).reshape(-1, len(self.ids))  # a row a pivot
        self.off = _NEAR * float(self.near.max(initial=0))
        self.squares = _squares(self.vectors)
        self.top = float(np.abs(self.vectors).max(initial=0))

    def bounds(self, square: float, near: np.ndarray) -> np.ndarray:
        """Upper bounds, whole numbers, of the inner products with a query of this square and these distances."""
        far = np.zeros(len(self.ids))
        with np.errstate(over="ignore", invalid="ignore"):
            if len(self.near):
                apart = self.near - near[:, None]
                np.abs(apart, out=apart)
                far = np.maximum(apart.max(0).astype(np.float64) - self.off - _NEAR * float(near.max()), 0)
            far[~np.isfinite(far)] = 0
            total = square + self.squares
            bound = np.floor((total - far * far) / 2 + total * ((self.vectors.shape[1] + 8) * 2.0**-50))
        bound[np.isnan(bound)] = np.inf
        return bound


def search(
    q: np.ndarray,
    query_id: int,
    square: float,
    near: np.ndarray,
    floor: float,
    block: Block,
    best: list[tuple[int, int]],
    k: int,
    step: int = 128
) -> list[tuple[int, int]]:
    """best with what these candidates better: (-score, id), in order, k at most."""
    bound = block.bounds(square, near)
    live = np.flatnonzero(bound >= (max(floor, -best[-1][0]) if len(best) == k else floor))
    own = live[block.ids[live] == query_id]
    own = own[(block.vectors[own] == q).all(1)]  # the query's own row and its repetitions, which top_k adds
    live = np.setdiff1d(live, own, assume_unique=True) if len(own) else live
    live = live[np.argsort(-bound[live], kind="stable")]
    small = _small(block.top, float(np.abs(q).max(initial=0)), len(q))
    at = 0
    while at < len(live):
        if len(best) == k:
            top = bound[live[at]]
            if top < -best[-1][0] or top == -best[-1][0] and block.ids[live[at]] > best[-1][1]:
                break
        own = live[at : at + step]
        if small:
            scores = block.vectors[own] @ q if 2 * len(own) < len(block.ids) else (block.vectors @ q)[own]  # gathering rows costs more
            order = np.lexsort((block.ids[own], -scores))[:k]
            scores, names = scores[order].astype(np.int64).tolist(), block.ids[own[order]].tolist()
        else:
            scores, names = products(block.vectors[own], q), block.ids[own].tolist()
        best = sorted([*best, *((-s, i) for s, i in zip(scores, names, strict=True))])[:k]
        at, step = at + step, step * 8
    return best


def _rows(query_id: int, key: int, copies: int, best: list[tuple[int, int]]) -> list[tuple]:
    return [(query_id, key, copies, i, max(min(-s, _LONG - 1), -_LONG), not -_LONG <= -s < _LONG) for s, i in best]


def _told(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.bool_()]
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_id", "key", "copies", "vec_id", "score", "over"])


def _match(k: int):
    def run(batches):
        held, queries, best = None, None, []

        def told() -> pa.RecordBatch:
            _, ids, keys, copies, *_ = queries
            return _told([r for q in zip(ids.tolist(), keys.tolist(), copies.tolist(), best, strict=True) for r in _rows(*q)])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("d", "ids", "kind", "vectors", "near", "q_ids", "q_keys")}
                key = row["d"], row["q_ids"], row["q_keys"]
                if held != key:
                    if held is not None:
                        yield told()
                    q = {c: batch.column(c)[i].as_py() for c in ("q_kind", "q_vectors", "q_near", "q_copies", "q_floors")}
                    own = Block(row["d"], row["q_ids"], q["q_kind"], q["q_vectors"], q["q_near"])
                    queries = own, own.ids, np.frombuffer(row["q_keys"], np.int64), np.frombuffer(q["q_copies"], np.int64), np.frombuffer(q["q_floors"])
                    held, best = key, [[] for _ in own.ids]
                block = Block(row["d"], row["ids"], row["kind"], row["vectors"], row["near"])
                own, ids, _, _, floors = queries
                for j in range(len(ids)):
                    best[j] = search(own.vectors[j], int(ids[j]), float(own.squares[j]), own.near[:, j], float(floors[j]), block, best[j], k)
        if held is not None:
            yield told()

    return run


def _repeated(k: int):
    """Rows of queries that stand several times: each is a candidate of the others."""

    def run(batches):
        for batch in batches:
            rows = []
            for query_id, key, copies, v in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "keys", "copies", "v")), strict=True):
                square = sum(int(x) ** 2 for x in v)
                rows += _rows(query_id, key, copies, [(-square, query_id)] * min(copies - 1, k))
            yield _told(rows)

    return run


def _may_reach() -> Column:
    """Whether some query of a block may reach its threshold with some candidate of another; true where numbers leave their range."""
    apart = F.zip_with(
        F.zip_with("low", "q_high", lambda x, y: x.cast("double") - y.cast("double")),
        F.zip_with("q_low", "high", lambda x, y: x.cast("double") - y.cast("double")),
        lambda x, y: F.greatest(x, y),
    )
    off = F.lit(2 * _NEAR) * (F.array_max("high").cast("double") + F.array_max("q_high").cast("double"))
    gap = F.greatest(F.coalesce(F.array_max(apart) - off, F.lit(0.0)), F.lit(0.0))
    total = F.col("most") + F.col("q_most")
    return (total - gap * gap) / 2 + total * ((F.col("d") + 8) * F.lit(2.0**-50)) >= F.col("q_least") - 1


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    pivots: int = PIVOTS,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k highest inner products. Both inputs: vec_id long, v array<double> of whole numbers; queries are rows of vectors."""
    spark = vectors.sparkSession
    sample: dict[int, list] = {}
    for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(PIVOT_SAMPLE).collect():
        if all(math.isfinite(x) for x in r["v"]):
            sample.setdefault(len(r["v"]), []).append((r["vec_id"], r["v"]))
    chosen = choose_pivots([v for rows in sample.values() for _, v in rows], pivots)
    known = {d: (np.array([i for i, _ in rows], np.int64), np.array([v for _, v in rows], np.float64).reshape(len(rows), d)) for d, rows in sample.items()}
    blocks = materialize(vectors.mapInArrow(_pack(chosen, candidate_block), _BLOCK))
    distinct = queries.groupBy("vec_id", "v").agg(F.count("*").alias("copies")).withColumn("keys", F.xxhash64("vec_id", "v"))
    q_blocks = materialize(distinct.mapInArrow(_pack(chosen, query_block, known, k), _QUERIES))
    # a grid of rows of candidates and columns of queries that moves the fewest bytes for this many cells
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    n, q_n = (b.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for b in (blocks, q_blocks))
    columns = max(1, round((CELLS * parts * q_n / max(n, 1)) ** 0.5))
    rows = max(1, CELLS * parts // columns)
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    named = {c: f"q_{c}" for c in q_blocks.columns if c != "d"}
    left = q_blocks.withColumnsRenamed(named).withColumn("column", F.pmod(F.xxhash64("q_place"), F.lit(columns)))
    left = left.withColumn("row", F.explode(numbers(rows)))
    right = blocks.withColumn("row", F.pmod(F.xxhash64("place"), F.lit(rows))).withColumn("column", F.explode(numbers(columns)))
    cell = ["d", "row", "column"]
    pairs = left.repartition(parts, *cell).join(right.repartition(parts, *cell).hint("merge"), cell).where(_may_reach())
    found = pairs.mapInArrow(_match(k), _FOUND).unionByName(distinct.where("copies > 1").mapInArrow(_repeated(k), _FOUND))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    fits = F.when(
        F.col("over"),
        F.raise_error(F.concat(F.lit("a score of query "), F.col("query_id").cast("string"), F.lit(" doesn't fit a long"))).cast("long")
    ).otherwise(F.col("score"))
    return ranked.select("query_id", "rank", "vec_id", fits.alias("score"), F.explode(F.sequence(F.lit(1), "copies"))).select("query_id", "rank", "vec_id", "score")


def embedding_top_k(embeddings: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """Queries: the rows whose vec_id is divisible by `every`; candidates: every other row."""
    vectors = embeddings.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select("vec_id", whole_numbers(F.col("embedding"), scale).alias("v"))
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k)
