"""Substring dedup by De Bruijn compaction.

Nodes are token k-mers (25 words), edges the 50-word windows. A node is kept where it has the smallest hash of the 26
in a window (a minimiser), so equal windows keep the same node; consecutive windows on one node form one compacted
nonbranching path. Spark joins find the nodes that documents share, and the paths that they share whole. Where a
shared node has several paths it branches: there the windows themselves, fetched again by their source coordinates,
decide. Node hashes only bring candidates together: what is removed is verified on the words that stand at the source
coordinates, by a cryptographic digest (BLAKE2, 128 bits) of their bytes.

Defined results. Null text: no words. A null doc_id is neither smaller nor larger than another: such a row loses
nothing and takes nothing. Repeated rows with one doc_id don't take from each other; equal ones are judged once, and
their result stands for each. Fewer than 50 words: nothing is removed. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Words, binary, chunks, materialize, ranges, runs

WINDOW = 50
NODE = 25

_PATHS = "node long, path1 long, path2 long, doc_id long, copy long, at int, n int"
_WINDOWS = "w1 long, w2 long, doc_id long, copy long, at int"


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` consecutive values."""
    have, reach = values, 1
    while 2 * reach <= width:
        have, reach = np.minimum(have[:-reach], have[reach:]), 2 * reach
    return np.minimum(have[: len(have) - (width - reach)], have[width - reach :]) if reach < width else have


def _paths(window: int, node: int):
    def cut(batches):
        for batch in chunks(batches, "text"):
            data, offsets = binary(batch.column("text"))
            words = Words(data, offsets)
            if len(words) < window:
                continue
            nodes = runs(words.hashes(), node)
            counts = np.maximum(np.diff(words.first) - window + 1, 0)
            start = np.repeat(words.first[:-1], counts) + ranges(counts)
            if not len(start):
                continue
            low = np.uint64((1 << 32) - 1)
            keyed = (nodes & ~low) | np.arange(len(nodes), dtype=np.uint64)
            chosen = (_smallest(keyed, window - node + 1)[start] & low).astype(np.int64)
            first = np.flatnonzero(np.r_[True, (np.diff(start) != 1) | (np.diff(chosen) != 0)])
            n = np.diff(np.r_[first, len(start)])
            at = start[first]
            document = np.searchsorted(words.first, at, "right") - 1
            path = words.digests(at, at + n + window - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes[chosen[first]].view(np.int64)),
                    pa.array(path[:, 0]),
                    pa.array(path[:, 1]),
                    batch.column("doc_id").take(pa.array(document)),
                    batch.column("copy").take(pa.array(document)),
                    pa.array((at - words.first[document]).astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                ],
                names=["node", "path1", "path2", "doc_id", "copy", "at", "n"],
            )

    return cut


def _windows(window: int):
    def cut(batches):
        for batch in chunks(batches, "text"):
            data, offsets = binary(batch.column("text"))
            words = Words(data, offsets)
            wanted = batch.column("wanted")
            per_row = np.diff(wanted.offsets.to_numpy())
            flat = wanted.flatten()
            at, n = flat.field("at").to_numpy().astype(np.int64), flat.field("n").to_numpy().astype(np.int64)
            row = np.repeat(np.repeat(np.arange(batch.num_rows), per_row), n)
            start = np.repeat(at, n) + ranges(n)
            placed = start + words.first[row]
            own = words.digests(placed, placed + window)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own[:, 0]),
                    pa.array(own[:, 1]),
                    batch.column("doc_id").take(pa.array(row)),
                    batch.column("copy").take(pa.array(row)),
                    pa.array(start.astype(np.int32)),
                ],
                names=["w1", "w2", "doc_id", "copy", "at"],
            )

    return cut


def _kept(window: int, with_text: bool):
    def cut(batches):
        for batch in chunks(batches, "text"):
            total, removed, digests, texts = [], [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True):
                words = text.encode().split() if text else []
                gone = 0
                if found:
                    step = np.zeros(len(words) + 1, np.int32)
                    np.add.at(step, [f["at"] for f in found], 1)
                    np.add.at(step, [f["at"] + f["n"] + window - 1 for f in found], -1)
                    keep = np.cumsum(step[:-1]) == 0
                    gone = len(words) - int(keep.sum())
                    kept = b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])
                else:
                    kept = b" ".join(words)
                total.append(len(words))
                removed.append(gone)
                digests.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    texts.append(kept.decode())
            columns = [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "kept_text"]
            columns, names = [*columns, batch.column("n")], [*names, "n"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def once(documents: DataFrame) -> DataFrame:
    """(doc_id, text, copy, n): one row for n rows that are equal in doc_id and text. copy: the text's XXH64.

    Only texts of repeated rows are shuffled, combined before; the others stay where they are.
    """
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("copy"))
    key = ["doc_id", "copy"]
    many = materialize(texts.where("doc_id is not null and text is not null").groupBy(*key).agg(F.count("*").alias("n")).where("n > 1"))
    merged = texts.join(many.select(*key), key, "left_semi").groupBy(*key).agg(F.first("text").alias("text"), F.count("*").alias("n"))
    rest = texts.join(many.select(*key), key, "left_anti").withColumn("n", F.lit(1).cast("long"))
    return rest.unionByName(materialize(merged))


def repeated_spans(texts: DataFrame, window: int = WINDOW, node: int = NODE) -> DataFrame:
    """(doc_id, copy, at, n): windows at..at+n-1 of the document also start in one with a smaller doc_id. texts: as once() gives them."""
    texts = texts.select("doc_id", "text", "copy").where("doc_id is not null and text is not null")
    paths = materialize(texts.mapInArrow(_paths(window, node), _PATHS))
    shared = paths.groupBy("node").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("node")
    shared = materialize(shared)  # joins of two plain shuffles are ones that Spark can split where a key is frequent
    paths = materialize(paths.join(shared, "node", "left_semi"))
    key = ["node", "path1", "path2"]
    firsts = materialize(paths.groupBy(*key).agg(F.min("doc_id").alias("least")))
    placed = materialize(paths.join(firsts, key))
    whole = placed.where("least < doc_id").select("doc_id", "copy", "at", "n")
    branching = (
        placed.groupBy("node").agg(F.min(F.struct("path1", "path2")).alias("a"), F.max(F.struct("path1", "path2")).alias("b")).where("a < b").select("node")
    )
    branching = materialize(branching)
    wanted = (
        placed.where("least = doc_id").join(branching, "node", "left_semi").groupBy("doc_id", "copy").agg(F.collect_list(F.struct("at", "n")).alias("wanted"))
    )
    windows = materialize(texts.join(wanted, ["doc_id", "copy"]).select("doc_id", "copy", "text", "wanted").mapInArrow(_windows(window), _WINDOWS))
    least = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").drop("most")
    least = materialize(least)
    single = windows.join(least, ["w1", "w2"]).where("least < doc_id").select("doc_id", "copy", "at", F.lit(1).alias("n"))
    return whole.unionByName(single)


def substring_dedup(documents: DataFrame, window: int = WINDOW, node: int = NODE, with_text: bool = True) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text (kept words joined by one space)."""
    texts = once(documents)
    found = repeated_spans(texts, window, node).groupBy("doc_id", "copy").agg(F.collect_list(F.struct("at", "n")).alias("found"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    judged = texts.join(found, ["doc_id", "copy"], "left").select("doc_id", "text", "found", "n")
    out = judged.mapInArrow(_kept(window, with_text), f"{schema}, n long")
    return out.withColumn("each", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n", "each")
