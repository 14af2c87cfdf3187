"""Filter interaction audit: what each of five filters removes in each order in which they can be applied.

Arrow buffers of whole texts are scanned once: byte classes and prefix sums give words, capitals, symbols and code
points of each document, sorted word hashes the distinct words; equal hashes are verified on the words' bytes, and a
document where they don't hold is counted by the words themselves. Four filters so become bits of a mask. The fifth,
copies, needs the whole table: the smallest doc_id of each text digest (BLAKE2, 128 bits) is an aggregate, and a row
is looked up by digest and doc_id, so that no join is dealt by the text of a large group of copies. Masks are counted
by part; the 120 orders only add these counts up, by one matrix for all parts.

Defined results. Null text: empty. Null source: the part ''. A null doc_id is neither smaller nor larger than another:
such a row has no label, is no copy and makes none. Rows that repeat a doc_id are judged each by its own text; equal
rows with one doc_id aren't copies of each other. Several labels of a doc_id: one with the value is enough. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import PLAIN, Words, binary, chunks, materialize, ranges

FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT = 65  # of 100 words
MOST_CAPITALS = 5  # of 100 code points
SYMBOLS = b"#$%&*|"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

#: Bits of a mask beside those of the filters: labelled as good, labelled as toxic.
_GOOD, _TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)
_CAPITAL, _SYMBOL = np.zeros(256, bool), np.zeros(256, bool)
_CAPITAL[65:91] = True
_SYMBOL[list(SYMBOLS)] = True
_STEP = 1 << 18


def _equal(words: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words a[k] and b[k] have the same bytes."""
    size = words.end[a] - words.start[a]
    same = size == words.end[b] - words.start[b]
    for k in range(0, len(a), _STEP):
        some = np.flatnonzero(same[k : k + _STEP]) + k
        n = size[some]
        if len(some):
            at = ranges(n)
            equal = words.data[np.repeat(words.start[a[some]], n) + at] == words.data[np.repeat(words.start[b[some]], n) + at]
            same[some] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
    return same


def distinct_words(words: Words) -> np.ndarray:
    """Distinct words of each text."""
    counts = np.diff(words.first)
    if not len(words):
        return counts
    text = np.repeat(np.arange(len(counts)), counts)
    hashes = words.hashes()
    order = np.lexsort((hashes, text))
    a, b = order[:-1], order[1:]
    pair = np.flatnonzero((text[a] == text[b]) & (hashes[a] == hashes[b]))
    a, b = a[pair], b[pair]
    out = counts - np.bincount(text[b], minlength=len(counts))
    for k in np.unique(text[b[~_equal(words, a, b)]]).tolist():  # different words with one hash
        out[k] = len({words.data[words.start[w] : words.end[w]].tobytes() for w in range(words.first[k], words.first[k + 1])})
    return out


def masks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bits of the filters A to D that each text fails."""

    def within(held: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(held, out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    words = Words(data, offsets, PLAIN)
    n = np.diff(words.first)
    fails = (
        n < LEAST_WORDS,
        100 * distinct_words(words) < LEAST_DISTINCT * n,
        100 * within(_CAPITAL[data]) > MOST_CAPITALS * within((data & 0xC0) != 0x80),
        within(_SYMBOL[data]) > 0,
    )
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def _judged(batches):
    for batch in chunks(batches, "text"):
        column = batch.column("text")
        data, offsets = binary(column)
        whole, ends = memoryview(np.ascontiguousarray(data)), offsets.tolist()
        raw = b"".join([hashlib.blake2b(whole[a:b], digest_size=16).digest() for a, b in zip(ends, ends[1:])])
        digest = np.frombuffer(raw, "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(masks(data, offsets))],
            names=["doc_id", "part", "d1", "d2", "mask"],
        )


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n): documents by the filters that they fail (bit k: the k-th of FILTERS) and their labels."""
    texts = documents.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text")
    rows = texts.mapInArrow(_judged, "doc_id long, part string, d1 long, d2 long, mask int")
    rows = materialize(rows.groupBy("doc_id", "part", "d1", "d2", "mask").agg(F.count("*").alias("n")))
    heads = rows.where("doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("doc_id"))
    heads = heads.withColumn("head", F.lit(True))
    copy = F.when(F.col("head"), 0).otherwise(1 << FILTERS.index("E"))
    told = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy("doc_id")
    told = told.agg(
        (F.max(F.when(F.col("quality") == 1, _GOOD).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, _TOXIC).otherwise(0))).alias("told")
    )
    known = rows.where("doc_id is not null").join(heads, ["doc_id", "d1", "d2"], "left").join(told, "doc_id", "left")
    known = known.select("part", (F.col("mask") + copy + F.coalesce("told", F.lit(0))).alias("mask"), "n")
    return known.unionByName(rows.where("doc_id is null").select("part", "mask", "n")).groupBy("part", "mask").agg(F.sum("n").alias("n"))


def orders() -> list[str]:
    return ["".join(p) for p in permutations(FILTERS)]


def _weights() -> np.ndarray:
    """(masks, orders, steps, COUNTS): how often a document with a mask counts in each number."""
    every = orders()
    out = np.zeros((4 << len(FILTERS), len(every), len(FILTERS), len(COUNTS)), np.int64)
    for mask in range(len(out)):
        fails = [mask >> k & 1 for k in range(len(FILTERS))]
        share = len(every) // sum(fails) if any(fails) else 0  # each of its failures comes first equally often
        for o, order in enumerate(every):
            gone = False
            for s, letter in enumerate(order):
                own = fails[FILTERS.index(letter)]
                removed = own and not gone
                out[mask, o, s] = (
                    not (gone or own),
                    removed,
                    own and gone,
                    own and sum(fails) == 1,
                    removed and bool(mask & _GOOD),
                    removed and bool(mask & _TOXIC),
                    share * own,
                )
                gone = gone or bool(own)
    return out


def _reduced(batches):
    weights, every = _weights(), orders()
    steps = len(every) * len(FILTERS)
    weights = weights.reshape(len(weights), -1)
    names = np.repeat(every, len(FILTERS)).tolist()
    for batch in batches:
        for part, held in zip(batch.column("part").to_pylist(), batch.column("held").to_pylist(), strict=True):
            counts = np.zeros(len(weights), np.int64)
            for entry in held:
                counts[entry["mask"]] = entry["n"]
            table = (counts @ weights).reshape(steps, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * steps),
                    pa.array(names),
                    pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(every))),
                    *[pa.array(np.ascontiguousarray(table[:, k])) for k in range(len(COUNTS))],
                ],
                names=["part", "filter_order", "step", *COUNTS],
            )


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order and step: part, filter_order, step and COUNTS, of the documents of the part.

    labels: (doc_id, quality, toxic). A part has at most 128 masks, so its counts fit in a row.
    """
    held = judged(documents, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n")).alias("held"))
    return held.mapInArrow(_reduced, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
