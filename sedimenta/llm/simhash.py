"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprints: 64 bits, a bit is 1 if set in over half of the XXH64 values (seed 42) of the word shingles. Tables: each
bit position gets a random vector of r+1 bits; for each nonzero vector v of r+1 bits, a table masks the positions whose
vector has an even product with v away. Any r positions span less than the r+1 dimensions, so some v is orthogonal to
all of them: every pair within r bits agrees in some table (Pagh, CoveringLSH). Within a bucket an exact search gives
the edges of a spanning forest, never all pairs; a bucket over BLOCK fingerprints is dealt out in pairs of blocks. Copies
cannot make buckets grow without end: they hold distinct fingerprints that agree in about 32 bits, and of those within the
radius of one of them there are 41,449 at most. Beyond come fingerprints that agree by chance, n / 2**32 a bucket.

Defined results. Null and empty texts have fingerprint zero and link like any other. Fewer words than a shingle: the
whole sequence is one shingle. A null doc_id is kept and never the smallest unless its component has no other. Repeated
rows are classed alike; so are rows that share a doc_id but not a text, each by its own text. Extra columns are ignored by
simhash_dedup() and kept by one_of_each(). An empty table gives an empty result.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import chunks, materialize
from .components import components, dealt, heads, keep_heads

RADIUS = 4
SHINGLE = 4
BLOCK = 8192


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The fingerprint of one text, as an unsigned integer."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = xxhash.xxh64_digest(joined, seed=42)
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        start, end = (ends - lengths)[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(joined[a:b], seed=42) for a, b in zip(start, end, strict=True)])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(rows), 1 << 16):
        counts += np.unpackbits(rows[at : at + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(rows)).tobytes(), "big")


def fingerprints(documents: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, digest, fp): the fingerprint of each row's text as a signed 64-bit integer; digest tells the texts of one doc_id apart."""

    def run(batches):
        for batch in chunks(batches, "text"):
            values = np.array([fingerprint(t, width) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(values.view(np.int64))], names=["doc_id", "digest", "fp"])

    return documents.select("doc_id", "text", F.xxhash64("text").alias("digest")).mapInArrow(run, "doc_id long, digest long, fp long")


def majority(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The fingerprint of each text whose shingles' hashes stand between its offsets; zero without any."""
    n = np.diff(offsets)
    text = np.repeat(np.arange(len(n)), n)
    counts = np.zeros((len(n), 64), np.int64)
    for at in range(0, len(hashes), 1 << 16):
        own = text[at : at + (1 << 16)]
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
        cuts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        counts[own[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > n[:, None], axis=1).view(np.uint64)[:, 0]


def masks(radius: int = RADIUS, seed: int = 42) -> list[int]:
    """2**(radius+1) - 1 masks of 64 bits, as signed integers; each pair within the radius agrees under one at least."""
    draw = random.Random(seed)
    vectors = [draw.randrange(1, 1 << (radius + 1)) for _ in range(64)]
    out = []
    for v in range(1, 1 << (radius + 1)):
        mask = sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() & 1)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def forest(values: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest of distinct unsigned values that differ in `radius` bits or fewer. Each value is compared only with those not yet reached."""
    out, rest = [], values
    while len(rest):
        reach, rest = [rest[:1]], rest[1:]
        while reach and len(rest):
            here = reach.pop()
            for x in here:
                near = np.bitwise_count(rest ^ x) <= radius
                if near.any():
                    found, rest = rest[near], rest[~near]
                    out.append((np.full(len(found), x), found))
                    reach.append(found)
                    if not len(rest):
                        break
    return out


def _bucket_edges(radius: int):
    def run(batches):
        key, held = None, []

        def close(held):
            pairs = forest(np.unique(np.concatenate(held)), radius)
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in zip(*pairs, strict=True)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "k", "i", "j")]
            values = batch.column("fp").to_numpy().view(np.uint64)
            cut = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
            edges = np.r_[0, cut, len(values)]
            head = tuple(c[0] for c in columns)
            if key != head and held:
                yield from close(held)
                held = []
            held.append(values[: edges[1]])
            if len(edges) > 2:
                yield from close(held)
                size = np.diff(edges[1:-1])
                starts = edges[1:-2]
                two = starts[size == 2]
                near = two[np.bitwise_count(values[two] ^ values[two + 1]) <= radius]
                near = near[values[near] != values[near + 1]]
                if len(near):
                    yield pa.RecordBatch.from_arrays([pa.array(values[near].view(np.int64)), pa.array(values[near + 1].view(np.int64))], names=["a", "b"])
                for s, n in zip(starts[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                    yield from close([values[s : s + n]])
                held = [values[edges[-2] :]]
            key = tuple(c[-1] for c in columns)
        if held:
            yield from close(held)

    return run


def links(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b): edges that join what is linked among the distinct values of nodes.fp: a spanning forest for each bucket of each table."""
    keyed = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks(radius)])).alias("t", "k"))
    rows = dealt(keyed, ["t", "k"], "fp", block).repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j")
    return rows.mapInArrow(_bucket_edges(radius), "a long, b long")


def least_row() -> Column:
    """The smallest doc_id of a group, with the text's digest; null where no row has one."""
    return F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "digest")))


def _linked(documents: DataFrame, radius: int, width: int, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, digest, fp) of each document; (fp, root); (root, head): the (doc_id, digest) of each component's smallest doc_id."""
    prints = materialize(fingerprints(documents, width))
    nodes = materialize(prints.groupBy("fp").agg(least_row().alias("least")))
    found = components(links(nodes, radius, block)).withColumnsRenamed({"node": "fp"})
    rooted = materialize(nodes.join(found, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    smallest = materialize(rooted.groupBy("root").agg(F.min("least").alias("head")))  # a frequent root: a join that Spark can split
    return prints, rooted.select("fp", "root"), smallest


def simhash_dedup(documents: DataFrame, radius: int = RADIUS, width: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest doc_id that it reaches by links)."""
    prints, rooted, smallest = _linked(documents, radius, width, block)
    named = rooted.join(smallest, "root").select("fp", F.col("head.doc_id").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(documents: DataFrame, radius: int = RADIUS, width: int = SHINGLE, similarity: float | None = None) -> DataFrame:
    """The documents, with all their columns, that are their component's head: the smallest doc_id, of several with that the
    text with the least digest, of repetitions of that one row. Rows without a doc_id stay.

    With a similarity, what counts is that of the sets of shingles, not the bits of fingerprints: see near_copies.
    """
    if similarity is not None:
        from . import near_copies

        if (radius, width, round(100 * similarity)) != (RADIUS, near_copies.SHINGLE, near_copies.PERCENT):
            raise ValueError("near copies are told at the radius, width and similarity of near_copies")
        return near_copies.one_of_each(documents)
    prints, _, smallest = _linked(documents, radius, width, BLOCK)
    return keep_heads(documents, heads(prints, smallest))
