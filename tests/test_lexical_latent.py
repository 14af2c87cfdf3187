"""Lexical search against all pairs; latent vectors against a full decomposition."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import DATA
from sedimenta.functions import vectors as vx
from sedimenta.operators import latent
from sedimenta.operators import lexical as lx


def best(scores, k):
    found = []
    for q, own in scores.items():
        ranked = sorted(own.items(), key=lambda x: (-x[1], x[0]))[:k]
        found += [(q, i, round(s, 6), r) for r, (i, s) in enumerate(ranked, 1)]
    return sorted(found)


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_sparse_nearest(spark, block):
    draw = random.Random(1)
    vectors = {i: {t: draw.choice([0.5, 1.0, 2.5, draw.random()]) for t in draw.sample(range(40), draw.randint(0, 8)) + [0]} for i in range(200)}
    asked = {q: {t: draw.random() for t in draw.sample(range(45), 4)} for q in range(15)} | {99: {77: 1.0}}
    scores = defaultdict(dict)
    for q, own in asked.items():
        for i, v in vectors.items():
            if shared := own.keys() & v.keys():
                scores[q][i] = round(sum(own[t] * v[t] for t in shared), lx.DIGITS)
    rows = spark.createDataFrame([(i, v) for i, v in vectors.items()] + [(300, {1: -5.0, 2: 0.0}), (None, {1: 9.0}), (301, None)], "vec_id long, sparse map<int,double>")
    queries = spark.createDataFrame([(q, t, w) for q, own in asked.items() for t, w in own.items()] + [(0, 5, -1.0)], "query_id long, token int, q double")
    got = lx.sparse_nearest(queries, lx.postings(rows), 6, block)
    assert sorted((r.query_id, r.vec_id, round(r.score, 6), r["rank"]) for r in got.collect()) == best(scores, 6)
    assert lx.sparse_nearest(queries, lx.postings(rows.limit(0)), 6).count() == 0


def test_bm25(spark):
    texts = {1: "Uno dos dos tres", 2: "dos", 3: "", 4: None, 5: "cuatro cuatro uno", 6: "UNO uno_2 dos"}
    docs = spark.createDataFrame([*texts.items(), (None, "uno")], "doc_id long, text string")
    counts = {i: Counter(t.lower().split()) for i, t in texts.items() if t}
    df = Counter(t for c in counts.values() for t in c)
    mean = sum(sum(c.values()) for c in counts.values()) / len(counts)
    want = {}
    for i, c in counts.items():
        for t, n in c.items():
            idf = math.log(1 + (len(counts) - df[t] + 0.5) / (df[t] + 0.5))
            want[i, t] = round(idf * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)), 9)
    got = lx.bm25(lx.tokens(docs)).collect()
    assert {(r.vec_id, r.token): round(r.weight, 9) for r in got} == want


def test_both_heads(spark):
    dense = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.4)], "query_id long, vec_id long, score double")
    sparse = spark.createDataFrame([(1, 2, 0.3), (1, 3, 1.0)], "query_id long, vec_id long, score double")
    assert [(r.vec_id, r.score) for r in lx.both_heads(dense, sparse, 2, 0.5).orderBy("rank").collect()] == [(2, 0.55), (1, 0.5)]


def test_latent_against_a_full_decomposition(spark):
    docs = spark.read.parquet(str(DATA / "sf0.001" / "documents.parquet")).select("doc_id", "text").repartition(5)
    model = latent.fit(docs, 12, 512, rounds=12)
    rows = docs.orderBy("doc_id").collect()
    row, column, value = model.weighted([r.text for r in rows])
    whole = np.zeros((len(rows), 512))
    whole[row, column] = value
    right = np.linalg.svd(whole, full_matrices=False)[2][:12].T
    assert np.linalg.svd(right[:, :8].T @ model.projection)[1].min() > 0.99
    exact, got = whole @ right, model.encode([r.text for r in rows])[0]
    exact /= np.maximum(np.linalg.norm(exact, axis=1, keepdims=True), 1e-12)
    near = lambda v: np.argsort(-(v @ v.T), axis=1, kind="stable")[:, :10]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(near(exact), near(got.astype(float)))]) > 9
    again = latent.fit(docs.repartition(2), 12, 512, rounds=12)
    assert np.allclose(again.projection, model.projection, atol=1e-6)


def test_latent_encoder(spark, tmp_path):
    """Texts of one topic are near each other though they share no word, as others tie these words together."""
    a, b = ["cat paw fur", "fur whisker tail", "cat tail"], ["stock bond fund", "fund share price", "stock price"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate((a + b) * 5)] + [(100, ""), (101, None)], "doc_id long, text string")
    model = latent.fit(docs, 2)
    latent.save(model, spark, f"{tmp_path}/m")
    model = latent.load(spark, f"{tmp_path}/m")
    texts = spark.createDataFrame([(0, "paw"), (1, "whisker"), (2, "bond"), (3, ""), (4, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in latent.encoded(texts, model).collect()}
    vectors = {i: np.array(r.dense) for i, r in rows.items()}
    assert vectors[0] @ vectors[1] > 0.9 > 0.1 > abs(vectors[0] @ vectors[2])
    assert not vectors[3].any() and not vectors[4].any() and rows[0].n_tokens == 1 and len(rows[0].sparse) == 1
    assert all(abs(np.linalg.norm(vectors[i]) - 1) < 1e-6 for i in (0, 1, 2))
    nothing = latent.fit(docs.limit(0), 4)
    assert not nothing.encode(["cat"])[0].any()
    got = docs.select(vx.encode_texts(F.col("text"), model, "passage").alias("e")).select(F.size("e.dense").alias("n")).distinct().collect()
    assert [r.n for r in got] == [2]


def test_latent_reads_texts_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for rows in batches:
            read.add(len(rows))
            yield rows

    docs = spark.range(600, numPartitions=2).select(F.concat(F.lit("word"), (F.col("id") % 7).cast("string"), F.lit(" other")).alias("text"))
    assert latent.fit(docs.mapInPandas(counting, "text string"), 2, 64).projection.any()
    assert read.value == 600


def test_an_encoder_hands_on_its_vectors_in_pieces(spark):
    class Watching:
        """Each vector tells how many arrays of vectors are held when it is made."""

        def count_tokens(self, text):
            return 1

        def encode(self, texts):
            import weakref

            self.made = getattr(self, "made", [])
            held = sum(r() is not None for r in self.made)
            out = np.full((len(texts), 1), held, np.float32)
            self.made.append(weakref.ref(out))
            return out, [{} for _ in texts]

    docs = spark.range(5000, numPartitions=1).select("id", F.col("id").cast("string").alias("text"))
    rows = docs.select("id", vx.encode_texts(F.col("text"), Watching(), None).alias("e")).select("id", F.col("e.dense")[0].alias("held")).collect()
    assert sorted(r.id for r in rows) == list(range(5000)) and max(r.held for r in rows) <= 3


def test_sparse_nearest_makes_no_row_for_a_pair_of_postings(spark):
    draw = np.random.default_rng(3)
    held = draw.random((3000, 60)) < np.concatenate([np.full(10, 0.6), np.full(20, 0.05), np.full(30, 0.004)])
    dense = held * np.round(draw.random(held.shape) * 8 + 1)
    postings = [(int(t), int(i), float(dense[i, t])) for i, t in zip(*np.nonzero(dense), strict=True)]
    index = spark.createDataFrame(postings, "token int, vec_id long, weight double")
    asked = index.where("vec_id % 10 = 0").select(F.col("vec_id").alias("query_id"), "token", F.col("weight").alias("q"))
    found = lx.sparse_nearest(asked, index, 4)
    assert found._jdf.queryExecution().toString().split("== Physical Plan ==")[1].count("Join") == 1  # of packed blocks
    scores = dense[::10] @ dense.T
    want = [(10 * q, int(i), float(scores[q, i])) for q in range(300) for i in np.lexsort((np.arange(3000), -scores[q]))[:4] if scores[q, i] > 0]
    assert sorted((r.query_id, r.vec_id, r.score) for r in found.collect()) == sorted(want)


def test_blocks_out_of_reach_are_not_scored(spark, monkeypatch):
    """Many blocks in bands of norms: the results are those of all pairs, and a block whose norms can't reach a query's k-th score is passed over."""
    import pyarrow as pa

    draw = random.Random(6)
    rows = [(str(t), i, float(draw.randint(1, 9) * (1 + i % 7))) for i in range(900) for t in draw.sample(range(20), draw.randint(1, 5))]
    index = spark.createDataFrame(rows, "token string, vec_id long, weight double")
    asked = index.where("vec_id % 9 = 0").selectExpr("vec_id as query_id", "token", "weight as q")
    vectors = {}
    for t, i, w in rows:
        vectors.setdefault(i, {})[t] = w
    want = []
    for i in (i for i in vectors if i % 9 == 0):
        scores = [(-sum(w * v.get(t, 0) for t, w in vectors[i].items()), j) for j, v in vectors.items()]
        want += [(i, j, -s, n) for n, (s, j) in enumerate(sorted(x for x in scores if x[0])[:5], 1)]
    got = lx.sparse_nearest(asked, index, 5, block=20).select("query_id", "vec_id", "score", "rank").collect()
    assert sorted(map(tuple, got)) == sorted(want)

    def packed(ids, weight):
        table = pa.table({"block": pa.array([0] * len(ids), pa.int32()), "token": ["t"] * len(ids), "id": ids, "weight": [weight] * len(ids)})
        return lx._pack(table).to_pylist()[0]

    scored, own = [], lx._scores
    monkeypatch.setattr(lx, "_scores", lambda q, d: scored.append(len(q.ids)) or own(q, d))
    met = [{"q": packed([1, 2], 1.0), "d": packed(ids, w)} for ids, w in (([10, 11], 5.0), ([12, 13], 4.0), ([8, 9], 5.0))]
    found = pa.Table.from_batches([*lx._nearest(2)([pa.RecordBatch.from_pylist(met)])])
    assert scored == [2, 2] and sorted(found["vec_id"].to_pylist()) == [8, 8, 9, 9, 10, 10, 11, 11]
