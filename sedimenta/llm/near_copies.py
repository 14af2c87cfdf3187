"""SimHash near-dedup at a stated similarity: covering masks, completed by prefixes, verified exactly.

A text's shingles are its runs of five words, ASCII letters in lower case; fewer words are one shingle. Texts with the
same words are one node. A node goes into two kinds of tables:

- a table for each covering mask over the 64-bit SimHash of its shingles: every pair within RADIUS bits meets in one.
- Copies at a Jaccard similarity of 0.8 differ in 10 of 64 bits, out of reach of covering masks, whose number doubles with
  each bit of radius. So a node's distinct shingles are put in one order for all texts, frequent ones last, and its
  first n - ceil(0.8 n) + 1 are keys more. Two texts at 0.8 or more miss at most n - ceil(0.8 n) of each other's
  shingles, so the first that they share is among both's keys (Chaudhuri et al. 2006). Which are frequent moves cost, not
  results: a sample gives a first guess, then all keys are counted, and nodes with a key that stands in over HOT nodes
  without having been guessed get their keys anew, with what is frequent among them last too.

In a bucket pairs are candidates whose sizes and whose parity maps (MAP bits, each shingle turns one; maps differ in no
more bits than sets in shingles) allow the similarity; no pair that has it is refused. Pairs of longer texts are then
compared by wider maps, of a bit a shingle or more. In a bucket of up to SMALL nodes all candidates are verified, in a
larger one first the edges of a spanning forest, then all that join nodes not linked by then. A bucket over BLOCK nodes is
dealt out in pairs of blocks. Verification intersects the whole sets of shingles. Verified pairs are linked, and linked
nodes form groups.

Defined results. Null and empty texts are copies of each other. A null doc_id stays and heads no group. Repeated rows
are classed alike; rows that share a doc_id but not a text are classed by their texts. Extra columns are kept. An empty
table gives an empty result. Groups are exact, but for 64-bit hashes of shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.durable import relieve
from .base import PLAIN, Words, binary, chunks, materialize, mixed, ranges, runs, trim
from .components import components, dealt, heads, keep_heads
from .simhash import RADIUS, least_row, majority, masks

SHINGLE = 5
#: Similarity that links, in hundredths.
PERCENT = 80
_MASKS = [np.uint64(m & (1 << 64) - 1) for m in masks(RADIUS)]
SMALL, BLOCK = 16, 4096
#: Bits of a parity map; pairs compared at once.
MAP, AT_ONCE = 512, 1 << 14
#: Texts whose shingles give a first guess at the frequent ones, and how many are told at most; nodes of a key that the guess has missed.
SAMPLE, FREQUENT, HOT = 8192, 1 << 16, 256
#: Bits of a wide map in buckets at most; pairs that a worker remembers before it starts anew.
FOLDED, REMEMBERED = 1 << 14, 1 << 17

_PRINTS = "doc_id long, digest long, node binary, keys array<long>, sketch binary, wide binary"
_FORM = PLAIN.copy()
_FORM[65:91] = np.arange(97, 123)
_DRAW = 1 << 30


def shingles(batch: pa.RecordBatch, width: int = SHINGLE) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Of each text: a digest of all words; of all texts: the shingles' hashes, one after another, and where each text's begin."""
    words = Words(*binary(batch.column("text")), _FORM)
    h, first = words.hashes(), words.first
    n = np.diff(first)
    some = np.flatnonzero(n)
    nodes = [bytes(16)] * len(n)
    whole = np.zeros(len(n), np.uint64)
    for k, digest in zip(some.tolist(), words.digests(first[some], first[some + 1]), strict=True):
        nodes[k], whole[k] = digest.tobytes(), digest.view(np.uint64)[0]
    counts = np.where(n > width, n - width + 1, np.minimum(n, 1))
    offsets = np.r_[0, np.cumsum(counts)]
    out = np.repeat(whole, counts)
    long = np.repeat(n > width, counts)
    if long.any():
        out[long] = runs(h, width)[(np.repeat(first[:-1], counts) + ranges(counts))[long]]
    return nodes, out, offsets


def ordered(hashes: np.ndarray, offsets: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles, one text after another, and where each text's begin. `frequent` come last, the first of them at the end."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    level = np.zeros(len(hashes), np.int64)
    if len(frequent):
        one = np.uint64(1)  # keys of shingles are odd
        frequent = frequent | one
        by = np.argsort(frequent)
        place = np.minimum(np.searchsorted(frequent[by], hashes | one), len(by) - 1)
        hit = frequent[by][place] == hashes | one
        level[hit] = len(by) - by[place[hit]]
    order = np.lexsort((hashes, level, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.r_[0, np.cumsum(np.bincount(text[new], minlength=len(offsets) - 1))]


def parities(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, MAP / 8) bytes: of each bit, whether an odd number of a text's distinct shingles stands for it."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at, times = np.unique(text * MAP + (hashes % np.uint64(MAP)).astype(np.int64), return_counts=True)
    bits = np.zeros((len(offsets) - 1) * MAP, np.uint8)
    bits[at[times & 1 == 1]] = 1
    return np.packbits(bits).reshape(-1, MAP // 8)


def wide_map(hashes: np.ndarray) -> bytes | None:
    """A longer text's number of distinct shingles, as 8 bytes, and a map of that many bits or more; null up to MAP."""
    n = len(hashes)
    if n <= MAP:
        return None
    bits = 1 << (n - 1).bit_length()
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return n.to_bytes(8, "little") + np.packbits(odd.astype(np.uint8)).tobytes()


def differing(both):
    """Shingles in one of two sets at most, at the similarity or more, if the sets hold so many together."""
    return both - 2 * -(-both * PERCENT // (100 + PERCENT))


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    while len(bits) > words:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def folded(wide: bytes | None) -> bytes | None:
    """A wide map of FOLDED bits at most, so that rows of buckets stay small however long a text is."""
    return wide and wide[:8] + _fold(np.frombuffer(wide, np.uint64)[1:], FOLDED // 64).tobytes()


def wide_near(x: bytes | None, y: bytes | None) -> bool:
    """Whether two wide maps allow the similarity; the wider one is folded to the other's bits."""
    if x is None or y is None:
        return True
    x, y = (np.frombuffer(v, np.uint64) for v in sorted((x, y), key=len))
    most = differing(int(x[0]) + int(y[0]))
    x, y = x[1:], _fold(y[1:], len(x) - 1)
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64)) <= most


def tables(prints: np.ndarray, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all texts, one text after another, and where each text's begin. Keys of masks are even, keys of shingles odd."""
    n = np.diff(offsets)
    first = np.where(n > 0, n - -(-n * PERCENT // 100) + 1, 0)
    starts = np.r_[0, np.cumsum(first + len(_MASKS))]
    keys = np.empty(int(starts[-1]), np.uint64)
    for t, mask in enumerate(_MASKS):
        keys[starts[:-1] + t] = mixed((prints & mask) ^ mixed(np.full(len(prints), t, np.uint64))) & ~np.uint64(1)
    step = ranges(first)
    keys[np.repeat(starts[:-1] + len(_MASKS), first) + step] = mixed(hashes[np.repeat(offsets[:-1], first) + step]) | np.uint64(1)
    return keys, starts


def _prints(frequent: np.ndarray):
    def run(batches):
        for batch in chunks(batches, "text"):
            nodes, hashes, offsets = shingles(batch)
            prints = majority(hashes, offsets)
            own, at = ordered(hashes, offsets, frequent)
            keys, starts = tables(prints, own, at)
            sketch = np.concatenate([np.diff(at).astype(np.int64)[:, None].view(np.uint8), parities(own, at)], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(keys.view(np.int64)))
            wide = [wide_map(own[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(nodes, pa.binary()), lists, pa.array([r.tobytes() for r in sketch], pa.binary()), pa.array(wide, pa.binary())],
                names=["doc_id", "digest", "node", "keys", "sketch", "wide"],
            )

    return run


def _seen(batches):
    for batch in chunks(batches, "text"):
        own, _ = ordered(*shingles(batch)[1:], np.empty(0, np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64))], names=["key"])


def _frequent(rows: DataFrame) -> np.ndarray:
    """Shingles that several of about SAMPLE texts have, those of the most texts first."""
    share = min(1.0, SAMPLE / max(rows.count(), 1))
    some = rows.where(F.pmod("digest", F.lit(_DRAW)) < int(share * _DRAW)) if share < 1 else rows
    once = some.groupBy("digest").agg(F.first("text").alias("text"))
    counted = once.mapInArrow(_seen, "key long").groupBy("key").count().where("count > 1")
    most = counted.orderBy(F.desc("count"), "key").limit(FREQUENT).select("key").collect()
    return np.array([r["key"] for r in most], np.int64).view(np.uint64)


def _missed(shared: DataFrame) -> np.ndarray:
    """Keys of shingles that stand in over HOT nodes, those of the most nodes first. shared: (key, count)."""
    hot = shared.where(F.col("count") > HOT).where(F.col("key").bitwiseAND(F.lit(1).cast("long")) == 1)
    found = hot.orderBy(F.desc("count"), "key").limit(FREQUENT).select("key").collect()
    return np.array([r["key"] for r in found], np.int64).view(np.uint64)


def _texts(rows: DataFrame, digests: DataFrame) -> DataFrame:
    """(doc_id, digest, text): each text with one of the digests once, however many copies. Texts that share a digest are told apart."""
    texts = rows.select("text", "digest").join(digests, "digest", "left_semi")
    once = texts.groupBy("digest", F.hash("text").alias("h"), F.length("text").alias("n")).agg(F.first("text").alias("text"))
    return once.select(F.lit(None).cast("long").alias("doc_id"), "digest", "text")


def _table_keys(frequent: np.ndarray) -> np.ndarray:
    """The keys that tables() makes of shingles which are known but for their lowest bit."""
    odd = frequent | np.uint64(1)
    return np.unique(mixed(np.r_[odd, odd ^ np.uint64(1)]) | np.uint64(1))


def _holding(nodes: DataFrame, keys: np.ndarray) -> DataFrame:
    """(digest) of the nodes that have one of the keys; written."""
    asked = nodes.sparkSession.createDataFrame([(int(x),) for x in keys.view(np.int64)], "key long")
    held = nodes.select("digest", F.explode("keys").alias("key")).join(F.broadcast(asked), "key", "left_semi")
    return materialize(held.select("digest").distinct())


def _reordered(rows: DataFrame, nodes: DataFrame, told: np.ndarray, missed: np.ndarray) -> DataFrame:
    """nodes, with new keys where they have one of `missed` or of what comes last because of these; written.

    All shingles of the texts with one of `missed` are counted, and those in over HOT of them come after all that isn't told.
    So no key then stands in over HOT of these nodes, but for texts that have no others. Every node that has one of these
    shingles among its keys gets its keys anew, also one without any of `missed`: else it would keep keys of the old order that
    the others have given up. The keys of the rest stay as they are: they are their first shingles in the new order too, as
    those that come later now aren't among them.
    """
    texts = materialize(_texts(rows, _holding(nodes, missed)))
    counted = texts.mapInArrow(_seen, "key long").groupBy(F.col("key").bitwiseOR(F.lit(1).cast("long")).alias("key")).count()
    hot = np.setdiff1d(_missed(counted), told | np.uint64(1))
    last = _texts(rows, _holding(nodes, np.union1d(missed, _table_keys(hot))))
    fresh = last.mapInArrow(_prints(np.r_[told, hot]), _PRINTS)
    fresh = materialize(fresh.groupBy("node").agg(F.first("keys").alias("fresh")))
    joined = nodes.join(fresh, "node", "left").withColumn("keys", F.coalesce("fresh", "keys"))
    return materialize(joined.select(*nodes.columns))


def _sets(batches):
    for batch in chunks(batches, "text"):
        nodes, hashes, offsets = shingles(batch)
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(hashes.view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), lists], names=["node", "own"])


def near(sizes: np.ndarray, maps: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the sizes and maps of rows a and b allow the similarity."""
    both = sizes[a] + sizes[b]
    out = np.minimum(sizes[a], sizes[b]) * 100 >= np.maximum(sizes[a], sizes[b]) * PERCENT
    some = np.flatnonzero(out)
    most = differing(both)[some]
    x, y = (np.broadcast_to(k, out.shape)[some] for k in (a, b))
    for k in range(0, len(some), AT_ONCE):
        cut = slice(k, k + AT_ONCE)
        out[some[cut]] = np.bitwise_count(maps[x[cut]] ^ maps[y[cut]]).sum(1, dtype=np.int64) <= most[cut]
    return out


def forest(sizes: np.ndarray, maps: np.ndarray, rows: np.ndarray):
    """Edges of a spanning forest of the rows that are near."""
    rest = rows
    while len(rest):
        reach, rest = [rest[0]], rest[1:]
        while reach and len(rest):
            k = reach.pop()
            hit = near(sizes, maps, k, rest)
            if hit.any():
                found, rest = rest[hit], rest[~hit]
                yield np.full(len(found), k), found
                reach += found.tolist()


def across(sizes: np.ndarray, maps: np.ndarray, roots: np.ndarray, rows: np.ndarray):
    """All near pairs of rows with different roots."""
    _, of, counts = np.unique(roots[rows], return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    rank = rank[of]
    rows, rank = rows[np.argsort(rank, kind="stable")], np.sort(rank)
    for k in np.flatnonzero(rank).tolist():
        before = rows[: np.searchsorted(rank, rank[k])]
        hit = before[near(sizes, maps, rows[k], before)]
        if len(hit):
            yield np.full(len(hit), rows[k]), hit


def _pairs(rooted: bool):
    """Of rows in order of key, i, j: pairs of nodes to verify. Not rooted: those of the first turn, and the key of each
    bucket that needs a second one. Rooted: those of the second, by their wide maps too, a pair once for each worker."""
    told: set[tuple[bytes, bytes]] = set()

    def close(parts: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(parts).combine_chunks()
        key, i, j = (rows.column(c).to_numpy() for c in ("key", "i", "j"))
        both = binary(rows.column("sketch"))[0].reshape(-1, 8 + MAP // 8)
        sizes, maps = (np.ascontiguousarray(x).view(np.uint64) for x in (both[:, :8], both[:, 8:]))
        sizes = sizes[:, 0].astype(np.int64)
        edges = np.r_[0, np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1, len(key)]
        starts, counts = edges[:-1], np.diff(edges)
        large = [s + np.arange(n) for s, n in zip(starts[counts > SMALL].tolist(), counts[counts > SMALL].tolist(), strict=True)]

        def found():
            if rooted:
                roots = binary(rows.column("root"))[0].reshape(-1, 16)
                roots = np.unique(np.ascontiguousarray(roots).view("V16")[:, 0], return_inverse=True)[1]
                node, wide = rows.column("node").to_pylist(), rows.column("wide").to_pylist()
                for a, b in (pair for own in large for pair in across(sizes, maps, roots, own)):
                    keep = []
                    for x, y in zip(a.tolist(), b.tolist(), strict=True):
                        pair = (min(node[x], node[y]), max(node[x], node[y]))
                        fresh = pair not in told
                        keep.append(fresh and wide_near(wide[x], wide[y]))
                        if fresh:
                            if len(told) >= REMEMBERED:
                                told.clear()
                            told.add(pair)
                    keep = np.array(keep, bool)
                    yield a[keep], b[keep]
                return
            for n in range(2, SMALL + 1):
                own = starts[counts == n]
                for a, b in zip(*np.triu_indices(n, 1), strict=True) if len(own) else ():
                    hit = own[near(sizes, maps, own + a, own + b)]
                    yield hit + a, hit + b
            nodes = np.ascontiguousarray(binary(rows.column("node"))[0].reshape(-1, 16)).view(">u8")[:, 0]
            for own in large:
                yield from forest(sizes, maps, own[np.argsort(nodes[own], kind="stable")])  # the same order in all buckets, for the same edges

        def batch(held: list) -> pa.RecordBatch:
            ends = [rows.column("node").take(pa.array(np.concatenate(x))).combine_chunks() for x in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays([*ends, pa.nulls(len(ends[0]), pa.int64())], names=["a", "b", "key"])

        held, n = [], 0
        for pair in found():
            held.append(pair)
            n += len(pair[0])
            if n > AT_ONCE:
                yield batch(held)
                held, n = [], 0
        if n:
            yield batch(held)
        if large and not rooted:
            wide = pa.array(key[[own[0] for own in large]])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(wide), pa.binary()), pa.nulls(len(wide), pa.binary()), wide], names=["a", "b", "key"])

    def last(batch: pa.RecordBatch) -> tuple:
        return tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in ("key", "i", "j"))

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            same = np.logical_and.reduce([batch.column(c).to_numpy() == x for c, x in zip(("key", "i", "j"), last(batch), strict=True)])
            cut = int(np.argmax(same))  # the last bucket may go on in the next batch
            if cut:
                yield from close([*held, batch.slice(0, cut)])
                held = []
            elif held and last(held[-1]) != last(batch):
                yield from close(held)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from close(held)
        trim()

    return run


def _found(keyed: DataFrame, counts: DataFrame, nodes: DataFrame, block: int) -> DataFrame:
    """(a, b, key) of buckets of keyed (key, id), with their counts: nodes has a node's id and sketch, and its root for the second turn."""
    shared = dealt(keyed, ["key"], "id", block, counts).join(nodes, "id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    pairs = shared.mapInArrow(_pairs("root" in nodes.columns), "a binary, b binary, key long")
    return materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "key").distinct())


def _folded(batches):
    for batch in batches:
        wide = pa.array([folded(x) for x in batch.column("wide").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("sketch"), wide], names=["node", "sketch", "wide"])


def _closer(batches):
    for batch in batches:
        keep = [wide_near(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _linked(rows: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose sets of shingles have the similarity; written."""
    maps = nodes.where("wide is not null")
    mapped = pairs.join(maps.select(F.col("node").alias("a"), F.col("wide").alias("x")), "a", "left").join(maps.select(F.col("node").alias("b"), F.col("wide").alias("y")), "b", "left")
    pairs = materialize(mapped.select("a", "b", "x", "y").mapInArrow(_closer, "a binary, b binary"))
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = materialize(nodes.select("node", "digest").join(asked, "node", "left_semi").select("digest"))
    sets = _texts(rows, wanted).mapInArrow(_sets, "node binary, own array<long>")  # a node once, as each is asked for by one digest
    own = materialize(sets.select("node", F.array_distinct("own").alias("own")))
    both = pairs.join(own.select(F.col("node").alias("a"), F.col("own").alias("x")), "a").join(own.select(F.col("node").alias("b"), F.col("own").alias("y")), "b")
    counted = both.select("a", "b", (F.size("x") + F.size("y")).alias("n"), F.size(F.array_intersect("x", "y")).alias("shared"))
    return materialize(counted.where(F.col("shared") * 100 >= (F.col("n") - F.col("shared")) * PERCENT).select("a", "b"))


def _counts(nodes: DataFrame) -> DataFrame:
    """(key, count) of the keys that several nodes have; written. Counted before the shuffle, so that a frequent key is no burden."""
    return materialize(nodes.select(F.explode("keys").alias("key")).groupBy("key").count().where("count > 1"))


def _rooted(nodes: DataFrame, linked: DataFrame) -> DataFrame:
    """(node, least, root) of all nodes; written."""
    ends = components(linked).withColumnsRenamed({"node": "at"})
    return materialize(nodes.join(ends, nodes["node"] == ends["at"], "left").select("node", "least", F.coalesce("root", "node").alias("root")))


def _grouped(documents: DataFrame, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, digest, node) of each document; (node, root); (root, head): the (doc_id, digest) of each group's smallest doc_id."""
    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    told = _frequent(rows)
    prints = materialize(rows.mapInArrow(_prints(told), _PRINTS))
    first = [F.min("digest").alias("digest"), *[F.first(c).alias(c) for c in ("keys", "sketch", "wide")]]
    nodes = materialize(prints.groupBy("node").agg(least_row().alias("least"), *first))
    short = F.xxhash64("node").alias("id")  # in shuffles of keys; nodes that shared one would only be compared in vain
    counts = _counts(nodes)
    if len(missed := np.setdiff1d(_missed(counts), told | np.uint64(1))):
        nodes = _reordered(rows, nodes, told, missed)
        counts = _counts(nodes)
    relieve(documents.sparkSession)
    keyed = nodes.select(F.explode("keys").alias("key"), short)
    found = _found(keyed, counts, nodes.select(short, "node", "sketch"), block)
    relieve(documents.sparkSession)
    pairs = found.where("key is null").select("a", "b")
    linked = _linked(rows, nodes, pairs)
    relieve(documents.sparkSession)
    rooted = _rooted(nodes, linked)
    wide = found.where("key is not null").select("key").distinct()
    if not wide.isEmpty():
        roots = rooted.select(short, "node", "root")
        wide = keyed.join(wide, "key")
        split = wide.join(roots, "id").groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"))
        wide = materialize(wide.join(split.where("least < most").select("key"), "key"))
        sketched = nodes.select("node", "sketch", "wide").mapInArrow(_folded, "node binary, sketch binary, wide binary").join(roots, "node")
        more = _found(wide, counts, sketched, block).select("a", "b").join(pairs, ["a", "b"], "left_anti")
        more = _linked(rows, nodes, more)
        if not more.isEmpty():
            rooted = _rooted(nodes, linked.unionByName(more))
    smallest = materialize(rooted.groupBy("root").agg(F.min("least").alias("head")))
    return prints.select("doc_id", "digest", "node"), rooted.select("node", "root"), smallest


def near_classes(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, digest, head: the (doc_id, digest) of its group's smallest doc_id."""
    rows, rooted, smallest = _grouped(documents, block)
    return rows.join(rooted.join(smallest, "root").select("node", "head"), "node").select("doc_id", "digest", "head")


def near_copies(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, group_id (the smallest doc_id of its group)."""
    return near_classes(documents).select("doc_id", F.col("head.doc_id").alias("group_id"))


def one_of_each(documents: DataFrame) -> DataFrame:
    """The documents, with all their columns, that head their group: the smallest doc_id, of several with that the text
    with the least digest, of repetitions of that one row. Rows without a doc_id stay."""
    rows, _, smallest = _grouped(documents, BLOCK)
    return keep_heads(documents, heads(rows, smallest))
