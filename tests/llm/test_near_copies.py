"""Near copies against all pairs."""

import random
from itertools import combinations

from sedimenta.llm import near_copies


def similarity(a, b):
    sets = []
    for text in (a, b):
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else {()})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def groups(rows):
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        if similarity(rows[a][1], rows[b][1]) >= 0.8:
            root[find(a)] = find(b)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, least.get(find(k))) for k, (i, *_) in enumerate(rows)), key=repr)


def test_odd_documents(documents, clashing, empty, rows):
    assert sorted((tuple(r) for r in near_copies.near_copies(documents).collect()), key=repr) == groups(rows)
    assert near_copies.near_copies(empty).count() == 0
    kept = near_copies.one_of_each(clashing)
    assert kept.columns == clashing.columns
    ids = [r.doc_id for r in kept.where("doc_id is not null").collect()]
    assert sorted(ids) == sorted({i for i, g in groups(rows) if i is not None and i == g})


def test_large_buckets_are_dealt_out(spark):
    """Groups far over a block, in pairs of blocks: the same groups as without, and one for a star and for a chain of copies."""
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(150)]
    star = [" ".join(base[:k] + [word()] + base[k + 1 :]) for k in range(60)]
    chain, own = [], [word() for _ in range(150)]
    for k in range(40):
        own = [*own[:k], word(), *own[k + 1 :]]
        chain.append(" ".join(own))
    rows = list(enumerate([*star, *chain, *(" ".join(word() for _ in range(50)) for _ in range(20))]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for block in (4096, 16):
        got = {r.doc_id: r["head"].doc_id for r in near_copies.near_classes(docs, block).collect()}
        assert got == {k: 0 if k < 60 else 60 if k < 100 else k for k in range(120)}


def test_recall(spark):
    """The pipeline's stage removes near copies down to a similarity of 0.8, and nothing below it."""
    import corpus_pipeline as cp

    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    rows, told = [], {}
    for k in range(400):
        words = [word() for _ in range(draw.randint(60, 400))]
        copy = list(words)
        for at in draw.sample(range(len(copy) // 6), max(1, round(len(copy) * draw.choice((0.004, 0.01, 0.02, 0.03))))):
            copy[at * 6] = word()
        rows += [(2 * k, " ".join(words), "en", "s", 0), (2 * k + 1, " ".join(copy), "en", "s", 0)]
        told[2 * k + 1] = similarity(rows[-2][1], rows[-1][1])
    base = [word() for _ in range(300)]  # a group that fills buckets
    for k in range(60):
        rows.append((1000 + k, " ".join(base[: 5 * k] + [word()] + base[5 * k + 1 :]), "en", "s", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stays = {r.doc_id for r in dict(cp.STAGES)["near_duplicates"](spark, docs, "").collect()}
    near = [i for i, x in told.items() if x >= 0.8]
    assert len(near) > 100 and len([i for i in near if told[i] < 0.9]) > 30
    assert sum(i not in stays for i in near) >= 0.99 * len(near)
    assert all(i in stays for i, x in told.items() if x < 0.8)
    assert {i for i in stays if i >= 1000} == {1000}


def test_no_link_is_left_out(spark, monkeypatch):
    """Copies just above and just below the similarity, in buckets far over SMALL: the groups of all pairs, whichever edges of a forest fail."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    rows = []
    for g in range(6):
        base = [word() for _ in range(200)]
        for k in range(40):
            n, at = draw.randint(5, 13), draw.randrange(180)
            rows.append((100 * g + k, " ".join([*base[:at], *(word() for _ in range(n)), *base[at + n :]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    turns, own = [], near_copies._pairs
    monkeypatch.setattr(near_copies, "_pairs", lambda rooted: turns.append(rooted) or own(rooted))
    assert sorted((tuple(r) for r in near_copies.near_copies(docs).collect()), key=repr) == groups(rows)
    assert turns == [False, True]


def test_frequent_shingles_that_the_sample_misses(spark, monkeypatch):
    """A passage that many texts share, unknown to the sample: keys are dealt out anew, and groups are those of all pairs."""
    from pyspark.sql import functions as F

    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    passage = [word() for _ in range(40)]
    texts = [" ".join([*(word() for _ in range(draw.randint(5, 60))), *passage, *(word() for _ in range(60))]) for _ in range(150)]
    texts += [t + " tail" for t in texts[:30]] + [" ".join(passage)] * 3
    rows = [*enumerate(texts), (7, "another text " + texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(near_copies, "SAMPLE", 0)
    monkeypatch.setattr(near_copies, "HOT", 20)
    largest, own = [], near_copies._counts

    def counts(nodes):
        found = own(nodes)
        odd = found.where(F.col("key").bitwiseAND(F.lit(1).cast("long")) == 1)
        largest.append(odd.agg(F.max("count")).first()[0])
        return found

    monkeypatch.setattr(near_copies, "_counts", counts)
    assert sorted((tuple(r) for r in near_copies.near_copies(docs).collect()), key=repr) == groups(rows)
    assert largest[0] > 100 and largest[1] <= 20


def test_keys_follow_one_order_after_some_come_last(spark, monkeypatch):
    """Short texts beside one with a shingle more that is frequent: if that one gets new keys, the other does too."""
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    short = [[word() for _ in range(10)] for _ in range(60)]
    spread = [w for own in short for w in own]
    texts = [" ".join([*spread, *(word() for _ in range(600))]) for _ in range(25)]
    texts += [" ".join(own[:n]) for own in short for n in (9, 10)]
    rows = [*enumerate(texts)]
    monkeypatch.setattr(near_copies, "SAMPLE", 0)
    monkeypatch.setattr(near_copies, "HOT", 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in near_copies.near_copies(docs).collect()), key=repr) == groups(rows)


def test_pairs_at_the_similarity_share_a_key_and_are_near():
    """Sets of all sizes at the least similarity that links, and texts with other frequent shingles: none is lost before verification."""
    import numpy as np

    draw = np.random.default_rng(1)
    for n in (1, 2, 4, 5, 9, 10, 45, 90, 333, 3000):
        for less, more in ((0, 0), (n // 5, 0), (0, n // 4), (n // 9, n // 9)):
            pool = draw.integers(0, (1 << 64) - 1, n + more, np.uint64)
            x, y = pool[:n], pool[less:]
            assert len(np.intersect1d(x, y)) * 100 >= len(np.union1d(x, y)) * 80
            own, offsets = near_copies.ordered(np.r_[x, y, y], np.cumsum([0, len(x), len(y), len(y)]), draw.permutation(pool)[: n // 2])
            assert np.diff(offsets).tolist() == [len(x), len(y), len(y)]
            keys, starts = near_copies.tables(np.array([0, 2**64 - 1, 0], np.uint64), own, offsets)
            a, b = (set(keys[starts[k] : starts[k + 1]].tolist()) for k in (0, 1))
            assert any(k & 1 for k in a & b)
            maps = near_copies.parities(own, offsets).view(np.uint64)
            assert near_copies.near(np.diff(offsets), maps, np.array([0, 1]), np.array([1, 2])).all()
            assert near_copies.wide_near(*(near_copies.wide_map(own[offsets[k] : offsets[k + 1]]) for k in (0, 1)))
    far = [near_copies.wide_map(draw.integers(0, (1 << 64) - 1, n, np.uint64)) for n in (2000, 2100)]
    assert len(far[0]) < len(far[1]) and not near_copies.wide_near(*far)
