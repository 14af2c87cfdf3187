"""Shared plumbing: tables, durable intermediate results, Arrow text columns and word tables."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from ..plans.durable import materialize, scratch, shared_dir  # noqa: F401

#: Bytes of text that a Python worker handles at once.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    column = column.cast(pa.large_binary() if large else pa.binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    wide = np.int64 if large else np.int32
    offsets = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def trim() -> None:
    """Gives freed memory back to the system; Python workers outlive their tasks and share an executor's limit."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that a piece holds at most `limit` bytes of `column`, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, upto - at)
            at = upto
    trim()


# ---------------------------------------------------------------- words

#: Every byte as itself, but the six ASCII white-space characters as a space.
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[9:14] = 32
#: ASCII letters in lower case, digits and non-ASCII bytes as themselves, the rest as a space.
LETTERS = np.full(256, 32, np.uint8)
LETTERS[48:58] = np.arange(48, 58)
LETTERS[65:91] = np.arange(97, 123)
LETTERS[97:123] = np.arange(97, 123)
LETTERS[128:] = np.arange(128, 256)

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
#: Words of more bytes are hashed by XXH3: sums of powers modulo 2**64 have known collisions from about 1000 terms on.
_SUMMED = 64
#: Powers that stay in memory.
_KEPT = (2 << 20) + 2
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and _BASE**-i modulo 2**64 for i < n. Kept for a chunk's length; a longer text gets its own."""
    if _powers and len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    both = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(max(n, _KEPT), b, np.uint64)
        x[0] = 1
        both.append(np.cumprod(x, out=x))
    if n <= _KEPT:
        _powers[:] = both
    return both[0][:n], both[1][:n]


def _sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values[i] * _BASE**i, from 0; the inverse powers."""
    power, inverse = powers(len(values) + 1)
    total = np.empty(len(values) + 1, np.uint64)
    total[0] = 0
    np.multiply(values, power[:-1], out=total[1:])
    np.cumsum(total, out=total)
    return total, inverse


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (the finaliser of SplitMix64)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_byte_values: dict[int, np.ndarray] = {}


def _values(seed: int) -> np.ndarray:
    if seed not in _byte_values:
        _byte_values[seed] = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * seed)) * _ODD)
    return _byte_values[seed]


class Words:
    """Words of consecutive texts: start, end (in bytes), `first` (a word index per text, one more at the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, form: np.ndarray = PLAIN):
        self.data = data = form[data]
        n = len(data)
        if n:
            solid = data != 32
            edge = np.zeros(n + 1, bool)
            edge[offsets] = True
            before = np.empty(n, bool)
            before[0], before[1:] = False, solid[:-1]
            after = np.empty(n, bool)
            after[-1], after[:-1] = False, solid[1:]
            self.start = np.flatnonzero(solid & (~before | edge[:-1]))
            self.end = np.flatnonzero(solid & (~after | edge[1:])) + 1
        else:
            self.start = self.end = np.empty(0, np.int64)
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self):
            return np.empty(0, np.uint64)
        total, inverse = _sums(_values(seed)[self.data])
        value = (total[self.end] - total[self.start]) * inverse[self.start]
        size = self.end - self.start
        out = mixed(value + size.astype(np.uint64) * _ODD)
        for k in np.flatnonzero(size > _SUMMED).tolist():
            out[k] = xxhash.xxh3_64_intdigest(self.data[self.start[k] : self.end[k]], seed)
        return out

    def digests(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """(spans, 2): 128 bits of BLAKE2 of the bytes of the words first..last-1 of each span, joined by one space, as signed integers."""
        size = self.end - self.start
        ends = np.cumsum(size + 1) - 1
        joined = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
        solid = self.data[self.data != 32]
        joined[np.arange(len(solid)) + np.repeat(np.arange(len(size)), size)] = solid
        whole = memoryview(joined)
        begin, end = (ends - size)[first].tolist(), ends[last - 1].tolist()
        digest = hashlib.blake2b
        raw = b"".join([digest(whole[a:b], digest_size=16).digest() if a < b else bytes(16) for a, b in zip(begin, end, strict=True)])
        return np.frombuffer(raw, "<i8").reshape(-1, 2)


class Vocabulary:
    """Known words, numbered in the order of their bytes, which must be as the form of the texts leaves them."""

    def __init__(self, words: set[str], form: np.ndarray = LETTERS):
        self.words = sorted(words)
        raw = [w.encode() for w in self.words]
        self.number = {w: k for k, w in enumerate(self.words)}
        found = Words(*binary(pa.array(raw, pa.binary())), form)
        if len(found) != len(raw):
            raise ValueError("not single words of this form")
        self.data, self.start, self.size = found.data, found.start, found.end - found.start
        h = found.hashes()
        self.order = np.argsort(h, kind="stable")
        self.sorted = h[self.order]

    def of(self, words: Words, at: np.ndarray | None = None, hashes: np.ndarray | None = None) -> np.ndarray:
        """The number of each word, or of those at some indexes, -1 for those outside. Equal hashes are verified on the words' bytes."""
        at = np.arange(len(words)) if at is None else at
        out = np.full(len(at), -1, np.int64)
        if not len(at) or not len(self.words):
            return out
        h = (words.hashes() if hashes is None else hashes)[at]
        place = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        hit = np.flatnonzero(self.sorted[place] == h)
        number, begin = self.order[place[hit]], words.start[at[hit]]
        same = words.end[at[hit]] - begin == self.size[number]
        hit, number, begin = hit[same], number[same], begin[same]
        for k in range(0, len(hit), 1 << 18):
            n = number[k : k + (1 << 18)]
            size = self.size[n]
            step = ranges(size)
            equal = words.data[np.repeat(begin[k : k + (1 << 18)], size) + step] == self.data[np.repeat(self.start[n], size) + step]
            good = np.logical_and.reduceat(equal, np.cumsum(size) - size)
            out[hit[k : k + (1 << 18)][good]] = n[good]
        return out


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each `width` consecutive entries (some dozens at most); one for each place where that many follow."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, inverse = _sums(hashes)
    return mixed((total[width:] - total[:n]) * inverse[:n])


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each c, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
