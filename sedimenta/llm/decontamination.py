"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

Texts and items are words of letters and digits in lower case. An item of n words is found in a document if some window
of n words is within floor(n * (1 - similarity)) word edits (insert, delete, replace) of it.

The CGK random walk (Chakraborty, Goldenberg, Koucky, 2016) copies a window's words to 3n places, moving on after a place
as a random bit of (walk, place, word) says; few edits become few places that differ. A table takes a few random places
of one walk as its key; WALKS x TABLES tables are filled with the items, and each window asks those of its own length.
What collides is verified exactly, on the words themselves, so no result is wrong: windows that have the most words in
common with the item come first, and one whose words alone ask for more edits than the best so far is passed over.
Recall at the full edit distance is measured in the tests.

Windows are drawn only where the text shares enough runs of g words with an item: each of e edits breaks g runs at
most, so at least n - g + 1 - e * g of them start within a matching window. No match is lost by this.

Items go to all executors in groups of about ITEM_GROUP items or ITEM_BYTES bytes at most, one pass over the documents
for each GROUPS_AT_ONCE groups.

Defined results. Null and empty texts and items without words match nothing. A null doc_id is reported as null; a null
item_id too. Repeated documents are each reported; a repeated item is reported once for each of its ids. Extra columns are
ignored by leaks() and kept by decontaminate(). Empty tables give empty results (decontaminate: all documents).
"""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import LETTERS, Vocabulary, Words, binary, chunks, materialize, mixed, ranges, runs

SIMILARITY = 0.8
WALKS, TABLES, PLACES = 6, 8, 3
ITEM_GROUP = 20_000
ITEM_BYTES = 8 << 20
GROUPS_AT_ONCE = 4
#: Bytes of text that a worker searches at once.
TEXT_BYTES = 2 << 20
#: Windows that are embedded, and cells of edit tables that are filled, at once.
WINDOWS, BAND_CELLS = 1 << 15, 1 << 19
#: Words of the runs that are counted, where an item is long enough.
GRAM = 3


def edit_distances(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Word edits between the rows of a and those of b, of one length; most + 1 where there are more. Only the band that matters is filled."""
    out = np.empty(len(a), np.int64)
    n, width = a.shape[1], 2 * most + 1
    step = max(1, BAND_CELLS // width)
    k = np.arange(width, dtype=np.int32)
    for at in range(0, len(a), step):
        x, y = a[at : at + step], b[at : at + step]
        edge = np.full((len(x), most), -2, y.dtype)
        y = np.concatenate([edge, y, edge], axis=1)
        now = np.broadcast_to(np.where(k >= most, k - most, 1 << 20).astype(np.int32), (len(x), width))
        far = np.full((len(x), 1), 1 << 20, np.int32)
        for i in range(n):  # place k of row i stands for the first i + 1 words of a and the first i + 1 + k - most of b
            new = now + (x[:, i : i + 1] != y[:, i : i + width])
            new = np.minimum(new, np.concatenate([now[:, 1:], far], axis=1) + 1)
            now = np.minimum.accumulate(new - k, axis=1) + k
        out[at : at + step] = np.minimum(now[:, most], most + 1)
    return out


def union(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The whole numbers in any of the intervals first..last, in order."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    heads = np.flatnonzero(np.r_[True, first[1:] > last[:-1]])
    tails = np.r_[heads[1:] - 1, len(first) - 1]
    counts = last[tails] - first[heads] + 1
    return np.repeat(first[heads], counts) + ranges(counts)


class Items:
    """Benchmark items with their LSH tables."""

    def __init__(self, rows: list[tuple], similarity: float, walks: int = WALKS, tables: int = TABLES, places: int = PLACES, seed: int = 42):
        texts = Words(*binary(pa.array([(text or "").encode() for _, text in rows], pa.binary())), LETTERS)
        raw = texts.data.tobytes()
        self.vocabulary = Vocabulary({raw[a:b].decode() for a, b in zip(texts.start.tolist(), texts.end.tolist(), strict=True)})
        number, h = self.vocabulary.of(texts), texts.hashes()
        some = np.flatnonzero(np.diff(texts.first)).tolist()
        cut = [slice(texts.first[k], texts.first[k + 1]) for k in some]
        self.id, self.hash, self.words = [rows[k][0] for k in some], [h[c] for c in cut], [number[c] for c in cut]
        self.length = length = np.array([len(w) for w in self.words], np.int64)
        self.most = edits = np.array([math.floor(n * (1 - similarity) + 1e-9) for n in length.tolist()], np.int64)
        self.walks, self.tables = walks, tables
        draw = random.Random(seed)
        #: By length: the places of each walk's tables; for each table the sorted keys and their items.
        self.sampled: dict[int, list] = {}
        self.table: dict[int, list] = {}
        for n in np.unique(length).tolist():
            own = np.flatnonzero(length == n)
            self.sampled[n] = [[sorted(draw.sample(range(3 * n), min(places, n))) for _ in range(tables)] for _ in range(walks)]
            keys = self.keys(np.concatenate([self.hash[k] for k in own]), np.arange(len(own)) * n, n)
            order = [np.argsort(key, kind="stable") for key in keys]
            self.table[n] = [(key[o], own[o]) for key, o in zip(keys, order, strict=True)]
        self.grams = {}
        width = np.ones(len(length), np.int64)
        for g in range(2, GRAM + 1):
            width[length - g + 1 - edits * g >= 1] = g
        self.least = np.maximum(length - width + 1 - edits * width, 1)
        for g in np.unique(width).tolist():
            own = np.flatnonzero(width == g)
            parts = [runs(self.hash[k], g) for k in own]
            grams = np.concatenate(parts)
            order = np.argsort(grams, kind="stable")
            owner = np.repeat(own, [len(p) for p in parts])
            offset = np.concatenate([np.arange(len(p)) for p in parts])
            maybe = np.zeros(1 << 20, bool)
            maybe[grams & np.uint64((1 << 20) - 1)] = True
            self.grams[g] = grams[order], owner[order], offset[order], maybe

    def keys(self, hashes: np.ndarray, starts: np.ndarray, n: int) -> list[np.ndarray]:
        """A key of each window of n words for each table. The CGK walk goes through 3n places; only sampled ones are kept."""
        wanted: dict[int, dict[int, np.ndarray | None]] = {}
        for w, tables in enumerate(self.sampled[n]):
            for p in sorted({p for places in tables for p in places}):
                wanted.setdefault(p, {})[w] = None
        at = np.zeros((self.walks, len(starts)), np.int64)
        salts = mixed(np.arange(3 * n * self.walks, dtype=np.uint64).reshape(3 * n, self.walks, 1) + np.uint64(1 << 20))
        for j in range(max(wanted) + 1):
            live = at < n
            word = hashes[starts + np.minimum(at, n - 1)]
            for w in wanted.get(j, ()):
                wanted[j][w] = np.where(live[w], word[w], 0)
            at += live & (((word ^ salts[j]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(63)) == 1)
        out = []
        for w, tables in enumerate(self.sampled[n]):
            for t, places in enumerate(tables):
                key = np.full(len(starts), w * self.tables + t, np.uint64)
                for p in places:
                    key = (key ^ wanted[p][w]) * np.uint64(0xD6E8FEB86659FD93)
                    key ^= key >> np.uint64(29)
                out.append(key)
        return out

    def _likely(self, words: Words, h: np.ndarray, g: int) -> list[tuple[int, np.ndarray]]:
        """(n, starts) of windows that share enough runs of g words with an item of n words."""
        known, owner, offset, maybe = self.grams[g]
        grams = runs(h, g)
        at = np.flatnonzero(maybe[grams & np.uint64((1 << 20) - 1)])
        low, high = np.searchsorted(known, grams[at]), np.searchsorted(known, grams[at], "right")
        text = np.searchsorted(words.first, at, "right") - 1
        inside = (high > low) & (at + g <= words.first[text + 1])
        at, low, text = at[inside], low[inside], text[inside]
        counts = high[inside] - low
        posting = np.repeat(low, counts) + ranges(counts)
        at, text = np.repeat(at, counts), np.repeat(text, counts)
        item, shift = owner[posting], at - offset[posting]
        order = np.lexsort((at, text, item))
        at, text, item, shift = at[order], text[order], item[order], shift[order]
        # distinct places of an item in a text; is there a stretch of n words with enough of them that holds this one?
        fresh = np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | (item[1:] != item[:-1])] if len(at) else np.empty(0, bool)
        place = np.cumsum(fresh) - 1
        d_at, d_text, d_item = at[fresh], text[fresh], item[fresh]
        far = np.arange(len(d_at)) + self.least[d_item] - 1
        ok = far < len(d_at)
        end = np.minimum(far, max(len(d_at) - 1, 0))
        ok &= (d_item[end] == d_item) & (d_text[end] == d_text) & (d_at[end] - d_at <= self.length[d_item] - g)
        cover = np.zeros(len(d_at) + 1, np.int64)
        np.add.at(cover, np.flatnonzero(ok), 1)
        np.add.at(cover, end[ok] + 1, -1)
        keep = (np.cumsum(cover)[:-1] > 0)[place]
        text, item, shift = text[keep], item[keep], shift[keep]
        out = []
        for n in np.unique(self.length[item]).tolist():
            own = self.length[item] == n
            e, where = int(self.most[item[own][0]]), text[own]
            first = np.maximum(shift[own] - e, words.first[where])
            last = np.minimum(shift[own] + e, words.first[where + 1] - n)
            fits = first <= last
            if fits.any():
                out.append((n, union(first[fits], last[fits])))
        return out

    def _collide(self, h: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, item) of windows and items of n words that share a key in some table."""
        found = []
        for at in range(0, len(starts), WINDOWS):
            own = starts[at : at + WINDOWS]
            for (known, item), key in zip(self.table[n], self.keys(h, own, n), strict=True):
                low, high = np.searchsorted(known, key), np.searchsorted(known, key, "right")
                hit = np.flatnonzero(high > low)
                counts = (high - low)[hit]
                found.append(np.stack([np.repeat(own[hit], counts), item[np.repeat(low[hit], counts) + ranges(counts)]]))
        return tuple(np.unique(np.concatenate(found, axis=1), axis=1)) if found else (np.empty(0, np.int64),) * 2

    def find(self, words: Words, h: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item, start, edits): for each text and item the window with the fewest edits, then the first. h: the words' hashes."""
        windows: dict[int, list[np.ndarray]] = {}
        for g in self.grams:
            for n, start in self._likely(words, h, g):
                windows.setdefault(n, []).append(start)
        out = []
        for n, parts in sorted(windows.items()):
            start, item = self._collide(h, np.unique(np.concatenate(parts)), n)
            if len(start):
                out += self._verified(words, h, start, item, n)
        return sorted(out)

    def _verified(self, words: Words, h: np.ndarray, start: np.ndarray, item: np.ndarray, n: int) -> list[tuple[int, int, int, int]]:
        """Exact word edits of colliding windows, those with the most words in common first, until nothing better can come."""
        most = int(self.most[item[0]])
        region = union(start, start + n - 1)
        number, at = self.vocabulary.of(words, region, h), np.searchsorted(region, start)
        text = np.searchsorted(words.first, start, "right") - 1
        least = np.empty(len(start), np.int64)  # words that the item lacks must be edited
        member = np.zeros(len(self.vocabulary.words) + 1, bool)
        by_item = np.argsort(item, kind="stable")
        for own in np.split(by_item, np.flatnonzero(np.diff(item[by_item])) + 1):
            member[self.words[item[own[0]]]] = True
            held = np.r_[0, np.cumsum(member[number])]
            least[own] = n - (held[at[own] + n] - held[at[own]])
            member[self.words[item[own[0]]]] = False
        order = np.lexsort((start, least, item, text))
        order = order[least[order] <= most]
        start, item, text, least, place = start[order], item[order], text[order], least[order], at[order]
        if not len(start):
            return []
        cuts = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]), True])
        at, end = cuts[:-1].copy(), cuts[1:]
        edits, first = np.full(len(at), most + 1), np.full(len(at), np.iinfo(np.int64).max)
        take = 1
        while True:
            near = np.minimum(at, end - 1)
            live = np.flatnonzero((at < end) & ((least[near] < edits) | (least[near] == edits) & (start[near] < first)))
            if not len(live):
                break
            counts = np.minimum(end[live] - at[live], take)
            own = np.repeat(at[live], counts) + ranges(counts)
            group = np.repeat(live, counts)
            for k in range(0, len(own), max(1, BAND_CELLS // n)):
                part, g = own[k : k + max(1, BAND_CELLS // n)], group[k : k + max(1, BAND_CELLS // n)]
                x = edit_distances(number[place[part][:, None] + np.arange(n)], np.stack([self.words[i] for i in item[part].tolist()]), most)
                for j in np.lexsort((start[part], x)).tolist():
                    if (x[j], start[part[j]]) < (edits[g[j]], first[g[j]]):
                        edits[g[j]], first[g[j]] = x[j], start[part[j]]
            at[live] += counts
            take *= 4
        return [(int(text[c]), int(item[c]), int(s - words.first[text[c]]), int(x)) for c, s, x in zip(cuts[:-1], first, edits, strict=True) if x <= most]


def leaks(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, start_word, edits, similarity): benchmark items that a document holds, at the closest window."""
    return _each_group(documents.select("doc_id", "text"), benchmark, similarity, False)


def _each_group(documents: DataFrame, benchmark: DataFrame, similarity: float, clean: bool) -> DataFrame:
    spark = documents.sparkSession
    rows = benchmark.select("item_id", "text").where("text is not null").distinct()
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    groups = max(1, -(-n // ITEM_GROUP), -(-size // ITEM_BYTES))
    numbered = rows.withColumn("g", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)))
    if groups > 1:
        numbered = materialize(numbered.repartition("g"))

    def loaded(g: int):
        own = sorted(((r["item_id"], r["text"]) for r in numbered.where(F.col("g") == g).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        return spark.sparkContext.broadcast(Items(own, similarity))

    found = T.StructType(
        [
            documents.schema["doc_id"],
            T.StructField("item_id", T.LongType()),
            T.StructField("start_word", T.LongType()),
            T.StructField("edits", T.LongType()),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    out = None
    for first in range(0, groups, GROUPS_AT_ONCE):
        shared = [loaded(g) for g in range(first, min(first + GROUPS_AT_ONCE, groups))]
        if clean:
            documents = documents.mapInArrow(_keep(shared), documents.schema)
        else:
            part = documents.mapInArrow(_tell(shared), found)
            out = part if out is None else out.unionByName(part)
    return documents if clean else out


def _search(shared: list, batches):
    """(batch, items, what Items.find says) for each piece of the batches and each group of items."""
    for batch in chunks(batches, "text", TEXT_BYTES):
        words = Words(*binary(batch.column("text")), LETTERS)
        h = words.hashes()
        yield batch, [(items.value, items.value.find(words, h) if items.value.id else []) for items in shared]


def _tell(shared: list):
    def run(batches):
        for batch, every in _search(shared, batches):
            for items, found in every:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array([d for d, *_ in found], pa.int64())),
                        pa.array([items.id[k] for _, k, *_ in found], pa.int64()),
                        pa.array([s for *_, s, _ in found], pa.int64()),
                        pa.array([x for *_, x in found], pa.int64()),
                        pa.array([1 - x / int(items.length[k]) for _, k, _, x in found], pa.float64()),
                    ],
                    names=["doc_id", "item_id", "start_word", "edits", "similarity"],
                )

    return run


def _keep(shared: list):
    def run(batches):
        for batch, every in _search(shared, batches):
            keep = np.ones(batch.num_rows, bool)
            for _, found in every:
                keep[[d for d, *_ in found]] = False
            yield batch.filter(pa.array(keep))

    return run


def decontaminate(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item."""
    return _each_group(documents, benchmark, similarity, True)
