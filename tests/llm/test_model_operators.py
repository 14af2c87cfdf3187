"""Quality, top-k, SentencePiece, decontamination, sharding, token files, pipeline."""

import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import told
from sedimenta.llm import decontamination as dc
from sedimenta.llm import pieces, quality, sharding, token_files, topk
from sedimenta.llm.queries import public_tokenizer
from sedimenta.plans.durable import shared_dir

WORD_BPE, PIECE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def tables(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")


def test_em_finds_the_labellers():
    draw = np.random.default_rng(1)
    truth = draw.random(20000) < 0.8
    right = np.array([0.95, 0.9, 0.7, 0.6])
    votes = np.where(draw.random((20000, 4)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[draw.random(votes.shape) < 0.2] = 2
    pattern, counts = np.unique(quality.patterns(votes), return_counts=True)
    posterior, told_ = quality.em(pattern, counts.astype(float), 4)
    share = told_[:, 1, 1] / (told_[:, 1, 1] + told_[:, 1, 0])
    assert np.abs(share - right).max() < 0.05
    by = dict(zip(pattern.tolist(), posterior.tolist(), strict=True))
    said = np.array([by[p] for p in quality.patterns(votes).tolist()]) > 0.5
    assert (said == truth).mean() > 0.93


def test_quality_on_labels(tables):
    """The labels play no part in training, so all of them are held out."""
    got = quality.score(tables("documents")).join(tables("labels"), "doc_id")
    n = {(r["quality"], r["keep"]): r["count"] for r in got.groupBy("quality", "keep").count().collect()}
    right = n.get((1, True), 0) + n.get((0, False), 0)
    assert right / sum(n.values()) > 0.95
    assert n.get((1, False), 0) <= 2


def test_quality_edges(documents, clashing, empty, rows):
    scores = quality.score(documents).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores)
    assert all(r.keep for r in scores if r.n_words < 5)
    assert quality.score(empty).count() == 0
    kept = quality.keep_good(clashing)
    assert kept.columns == clashing.columns and kept.count() == quality.score(clashing).where("keep").count()
    assert quality.keep_good(empty).count() == 0


def test_quality_votes_follow_their_texts():
    import pyarrow as pa

    from sedimenta.llm.base import binary

    texts = ["plain words here. more of them follow now.", None, "", "A B!! C!! D!! E!! F!!", "x | y | z | w | v | u", "same same same same same same"]
    together = quality.Texts(*binary(pa.array(texts)))
    alone = [quality.Texts(*binary(pa.array([t]))) for t in texts]
    assert (together.votes() == np.concatenate([a.votes() for a in alone])).all()
    assert np.allclose(together.features(), np.concatenate([a.features() for a in alone]))


def test_quality_sample_holds_each_document_once(spark, monkeypatch):
    """A row that repeats without end comes to the driver once; the sample is bounded."""
    seen = []
    monkeypatch.setattr(quality, "train", lambda x, y, **_: seen.append(len(x)) or np.zeros(quality.BUCKETS + 3))
    one = spark.range(5000).selectExpr("1L AS doc_id", "'the same words again and again here.' AS text")
    many = spark.range(3000).selectExpr("id AS doc_id", "concat('document ', id, ' has words of its own.') AS text")
    quality.fit(one.unionByName(many), sample=8000)
    quality.fit(one.unionByName(many), sample=100)
    quality.fit(many, sample=500)
    assert seen[0] == 3001 and seen[1] <= 100 and 300 < seen[2] <= 500


@pytest.mark.parametrize("passage", [40, 700, 2500])
def test_quality_sees_repetition_at_every_length(passage):
    import pyarrow as pa

    from sedimenta.llm.base import binary

    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    own = [word() for _ in range(passage)]
    texts = [" ".join((own * 1000)[:n]) for n in (13 * passage, 4999 + 8 * passage, 5000 + 8 * passage, 60000)]
    texts += [" ".join(word() for _ in range(n)) for n in (4999, 5000, 60000)]
    got = quality.Texts(*binary(pa.array(texts)))
    assert (got.votes()[:4, 5] == 0).all() and (got.votes()[4:, 5] == 1).all()
    assert (got.repetition[:4] > 0.85).all() and (got.repetition[4:] < 0.1).all()


def best(rows, k):
    out = []
    whole = lambda x: math.floor(256 * np.float64(np.float32(x)))
    good = [(n, i, [whole(x) for x in v]) for n, (i, v) in enumerate(rows) if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for n, i, q in good:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, j, v in good if m != n and len(v) == len(q))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k, blocks", [(5, (2048, 4096)), (3, (2, 7)), (50, (5, 16))])
def test_top_k(spark, k, blocks):
    draw = random.Random(k)
    rows = [(i, [round(draw.uniform(-1, 1), 3) for _ in range(6)]) for i in range(180)]
    rows += [(200 + i, rows[50][1]) for i in range(40)] + [
        (300, [0.0] * 6),
        (350, [1.0]),
        (351, [-1.0]),
        (352, []),
        (None, [0.5] * 6),
        (400, None),
        (401, [float("nan")] * 6),
        (402, [None, 1.0]),
        (403, [float("inf")] * 6),
        (450, [900.0, -900.0, 1e-9, 0.5, 0.25, 3.0])
    ]
    rows += [(50, rows[50][1]), (50, rows[50][1]), (50, [0.5] * 6), (100, [2.0] * 6), (101, [2.0] * 6), (101, [2.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit("x")).repartition(3)
    vectors = df.where(F.col("vec_id").isNotNull() & topk.usable(F.col("embedding"))).select("vec_id", topk.whole_numbers(F.col("embedding")).alias("v"))
    got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k, 4, *blocks)
    assert told(got) == best(rows, k)
    assert told(topk.embedding_top_k(df, k)) == best(rows, k)


def test_top_k_of_large_components(spark):
    """Finite components of any size take part; scores are exact beyond 53 bits, and an error where they leave a long."""
    schema = "vec_id long, embedding array<float>"
    draw = random.Random(2)
    rows = [(1, [1.0, 2.0]), (50, [300000.0, 1.0]), (2, [3.0, 1.0])]
    rows += [(100 + k, [draw.choice((1.0, 2.0**22, 2.0**23 + 1, -(2.0**21))) * draw.uniform(-1, 1) for _ in range(2)]) for k in range(120)]
    assert told(topk.embedding_top_k(spark.createDataFrame(rows, schema))) == best(rows, 5)
    far = [(k, [draw.uniform(-1, 1), 2.0**26]) for k in range(1, 40)] + [(50, [1.0, 0.0]), (100, [0.0, 0.5])]
    assert told(topk.embedding_top_k(spark.createDataFrame(far, schema))) == best(far, 5)
    over = spark.createDataFrame([(50, [2.0**40]), (51, [2.0**40])], schema)
    with pytest.raises(Exception, match="doesn't fit a long"):
        topk.embedding_top_k(over).collect()
    own = [(50, [2.0**40]), (51, [0.0]), (52, [1.0])]
    assert told(topk.embedding_top_k(spark.createDataFrame(own, schema))) == best(own, 5)


def test_top_k_empty(spark):
    assert topk.embedding_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


TEXTS = [
    None,
    "",
    " ",
    "  ",
    "a  b   c    d     e",
    " lead",
    "tail ",
    "日本語 abc日本.def",
    "tab\tx\n\n\ny",
    "aaaaaaaaaaaaaa aaaa",
    "\x00 é😀 ",
    "......... -------- ======== ____",
    "a" * 3000,
    "don't!!'s '''s a'b.c's 12's İ ΩΣ á ≠ <| <|endoftext|>x<|ENDOFTEXT|>",
    "The THE the. the,the;the"
]


def test_pieces_equal_the_library(spark, tables):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizer(PIECE_BPE))
    odd = spark.createDataFrame([(-k - 1, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    docs = tables("documents").select("doc_id", "text").unionByName(odd)
    texts = {r.doc_id: r.text for r in docs.collect()}
    encoded = pieces.encode(docs.withColumn("decoded0", F.lit(1)), public_tokenizer(PIECE_BPE))
    for r in pieces.decode(encoded, public_tokenizer(PIECE_BPE)).collect():
        assert r.ids == own.encode(texts[r.doc_id] or ""), r.doc_id
        assert r.decoded == (texts[r.doc_id] or "")
    for r in pieces.digests(odd, public_tokenizer(PIECE_BPE)).collect():
        ids = own.encode(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_crc32, r.decoded_crc32, r.same) == (
            len(ids),
            zlib.crc32(np.array(ids, "<u4").tobytes()),
            zlib.crc32((texts[r.doc_id] or "").encode()),
            True
        )


def test_pieces_of_spaces_and_long_units():
    import pyarrow as pa
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizer(PIECE_BPE))
    draw = random.Random(2)
    texts = [" " * k + w for k in range(40) for w in ("", "x", "the", "é", "1", " word", "ing's")]
    texts += ["".join(draw.choice(["the", " ", "  ", "   ", "\n", "a", "日本", "é", "x1", "    "]) for _ in range(draw.randint(1, 25))) for _ in range(500)]
    base64 = "".join(draw.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1 << 20))
    texts += ["  " + base64, "日本語漢字" * 20000, " " * 200_000 + "x", "a" * 100_000]
    began = time.time()
    ids, offsets = pieces.model(public_tokenizer(PIECE_BPE)).texts(pa.array(texts))
    assert time.time() - began < 30
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == own.encode(texts)


def test_pieces_reject_other_models(tmp_path):
    field = lambda n, content: bytes([n << 3 | 2, len(content)]) + content
    flags = lambda **k: b"".join(bytes([int(n[1:]) << 3, v]) for n, v in k.items())
    path = tmp_path / "model"
    for trainer, normaliser, good in (
        (flags(f3=2), flags(f4=0), True),
        (flags(f3=1), flags(f4=0), False),
        (b"", flags(f4=0), False),
        (flags(f3=2), b"", False),
        (flags(f3=2), flags(f3=0, f4=0), False),
        (flags(f3=2), field(2, b"map") + flags(f4=0), False)
    ):
        path.write_bytes(field(2, trainer) + field(3, normaliser))
        if good:
            pieces.check(str(path))
        else:
            with pytest.raises(ValueError):
                pieces.check(str(path))


def test_pieces_edges(clashing, empty):
    got = pieces.encode(clashing, public_tokenizer(PIECE_BPE))
    assert sorted(got.columns) == sorted(clashing.columns) and got.count() == clashing.count()
    assert pieces.digests(empty, public_tokenizer(PIECE_BPE)).count() == 0


def test_compatible_is_what_merging_leaves():
    own = pieces.model(public_tokenizer(PIECE_BPE))
    draw = random.Random(9)
    plain = [i for i in own.whole if own.text[i].isascii() and "▁" not in own.text[i][1:]]
    for _ in range(4000):
        a, b = draw.choice(plain), draw.choice(plain)
        if own.text[b].startswith("▁"):
            continue
        assert own.compatible(a, b) == (own.merge(own.text[a] + own.text[b]) == [own.text[a], own.text[b]])


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def windows_within(words, item, most):
    n = len(item)
    least = lambda part: n - sum(w in item for w in part)
    found = [(edits(item, words[s : s + n]), s) for s in range(len(words) - n + 1) if least(words[s : s + n]) <= most]
    return min((f for f in found if f[0] <= most), default=None)


def test_edit_distances():
    draw = np.random.default_rng(4)
    for n in (1, 2, 5, 9, 30):
        a, b = draw.integers(-1, 4, (60, n)), draw.integers(0, 4, (60, n))
        b[:30] = a[:30]
        for most in (0, 1, 2, n):
            want = [min(edits(x, y), most + 1) for x, y in zip(a.tolist(), b.tolist())]
            assert dc.edit_distances(a, b, most).tolist() == want


def test_decontamination_of_long_items(spark):
    """Many copies of items of 1000 words, exact, edited and too far, in bounded time."""
    draw = random.Random(3)
    say = lambda n: [f"w{draw.randrange(5000)}" for _ in range(n)]
    item, other = say(1000), say(600)
    changed = lambda own, n: [f"x{draw.randrange(9)}" if k in at else w for at in [set(draw.sample(range(len(own)), n))] for k, w in enumerate(own)]
    docs = [
        (1, say(50) + [w for _ in range(100) for w in item + say(3)]),
        (2, [w for k in range(20) for w in changed(other, 100 + k) + say(2)]),
        (3, changed(item, 230)),
        (4, say(3000)),
        (5, say(7) + changed(item, 200)),
        (6, ["the"] * 5000)
    ]
    bench = [(1, " ".join(item)), (2, " ".join(other)), (3, " ".join(["the"] * 40))]
    began = time.time()
    got = dc.leaks(spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert told(got.drop("similarity")) == [(1, 1, 50, 0), (2, 2, 0, 100), (5, 1, 7, 200), (6, 3, 0, 0)]
    assert time.time() - began < 60


def test_decontamination_recall(spark, rows):
    """Items with as many edits as allowed, among random words: at least 0.95 are found, each answer is right."""
    draw = random.Random(11)
    say = lambda n: [f"w{draw.randrange(300)}" for _ in range(n)]
    items = [(k, say(draw.randint(1, 60))) for k in range(80)]
    docs, spell = [], lambda ws: " ".join(w.upper() if draw.random() < 0.1 else w for w in ws)
    for k, own in items:
        for _ in range(3):
            made = list(own)
            for _ in range(int(len(own) * 0.2)):
                kind, at = draw.randrange(3), draw.randrange(len(made) or 1)
                if kind == 0:
                    made[at] = "edit"
                elif kind == 1 and len(made) > 1:
                    made.pop(at)
                else:
                    made.insert(at, "more")
            docs.append((len(docs), spell(say(40) + made + say(40))))
    docs += [(10_000 + k, r[1]) for k, r in enumerate(rows)] + [(5, docs[0][1]), (None, docs[3][1])]
    bench = [(k, ", ".join(w)) for k, w in items] + [(500, None), (501, " ?! "), (0, ", ".join(items[0][1])), (None, " ".join(items[1][1]))]
    got = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    found = {(r.doc_id, r.item_id): r for r in got.collect()}
    split = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
    want = {}
    for i, t in docs:
        words = split(t)
        for k, own in items:
            hit = windows_within(words, own, int(len(own) * 0.2 + 1e-9))
            if hit:
                want[i, k] = hit
    assert not [key for key in found if key[1] is not None and key not in want]
    right = [found[key].edits == hit[0] and found[key].start_word == hit[1] for key, hit in want.items() if key in found]
    assert len(right) / len(want) >= 0.95
    assert sum(right) / len(want) >= 0.9
    exact = [key for key, hit in want.items() if hit[0] == 0]
    assert exact and all(key in found for key in exact)


def test_decontamination_in_groups(spark, tables, monkeypatch):
    """Benchmarks that go out in several groups and passes find the same."""
    docs, bench = tables("documents").limit(300).cache(), tables("benchmark")
    want, kept = told(dc.leaks(docs, bench)), told(dc.decontaminate(docs, bench).select("doc_id"))
    monkeypatch.setattr(dc, "ITEM_GROUP", 6)
    assert want and told(dc.leaks(docs, bench)) == want and told(dc.decontaminate(docs, bench).select("doc_id")) == kept


def test_decontamination_edges(spark, clashing, empty, documents):
    bench = spark.createDataFrame([(1, documents.where("doc_id = 7").first().text)], "item_id long, text string").withColumn("doc_id", F.lit("x"))
    assert dc.leaks(empty, bench).count() == 0
    assert dc.leaks(documents, bench.limit(0)).count() == 0
    kept = dc.decontaminate(clashing, bench)
    assert kept.columns == clashing.columns
    gone = {r.doc_id for r in clashing.select("doc_id").collect()} - {r.doc_id for r in kept.select("doc_id").collect()}
    assert 7 in gone and 0 not in gone
    assert dc.decontaminate(clashing, bench.limit(0)).count() == clashing.count()


def jump(key, shards):
    """The published function."""
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 8, 9, 1000])
def test_jump_hash(spark, shards):
    draw = random.Random(shards)
    keys = [0, -1, 1, -(1 << 63), (1 << 63) - 1] + [draw.randrange(-(1 << 63), 1 << 63) for _ in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    assert {r.k: r.s for r in df.select("k", sharding.jump_hash(F.col("k"), shards).alias("s")).collect()} == {k: jump(k, shards) for k in keys}


def test_sharding(spark, documents, clashing, empty, rows):
    for docs in (documents, clashing):
        got = sharding.shard(docs).collect()
        text = lambda r: (r[1] or "").encode()
        want = sorted(((r[0], len(text(r)) + 1, zlib.crc32(text(r)), "key", jump(r[0] or 0, 8), jump(r[0] or 0, 9)) for r in rows), key=repr)
        assert sorted(((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got), key=repr) == want
        for s in range(8):
            own = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
            assert [r.slot for r in own] == list(range(len(own)))
            order = [(r.doc_id is not None, r.doc_id or 0, r.text_crc32) for r in own]
            assert order == sorted(order)
    assert sharding.shard(empty).count() == 0


def test_token_files(spark, documents, clashing, empty, rows, tables):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizer(WORD_BPE))
    ids = lambda t: own.encode(t or "", add_special_tokens=False).ids + [1]
    odd = [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS, 500)]
    every = [*rows, *odd]
    docs = clashing.unionByName(spark.createDataFrame(odd, documents.schema), allowMissingColumns=True)
    order = sorted(every, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode())))
    want, start = [], 0
    for i, t, *_ in order:
        x = ids(t)
        want.append((i, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    assert told(token_files.token_digests(docs, public_tokenizer(WORD_BPE))) == sorted(want, key=repr)
    assert token_files.token_digests(empty, public_tokenizer(WORD_BPE)).count() == 0
    where = shared_dir(spark)
    token_files.write_ids(tables("documents"), where, public_tokenizer(WORD_BPE), partitions=3)
    back = token_files.read_ids(spark, where)
    for r in tables("documents").where("doc_id % 97 = 0").collect():
        assert back.where(F.col("doc_id") == r.doc_id).first().ids == ids(r.text)
    scan = next(x for x in back.where("doc_id = 5")._jdf.queryExecution().toString().splitlines() if "FileScan orc" in x)
    assert "EqualTo(doc_id,5)" in scan.split("PushedFilters: ")[1]


def test_token_files_of_another_tokenizer(spark):
    from tokenizers import Tokenizer

    path = public_tokenizer("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    where = shared_dir(spark)
    token_files.write_ids(docs, where, path, end_id=7)
    assert {r.doc_id: r.ids for r in token_files.read_ids(spark, where).collect()} == {
        k: own.encode(t or "", add_special_tokens=False).ids + [7] for k,
        t in enumerate(TEXTS)
    }


def test_pipeline(spark):
    import corpus_pipeline as cp
    from sedimenta.llm import near_copies, secrets

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "near_duplicates", "benchmark_decontamination", "secret_scan", "piece_ids"]
    kept = {r.doc_id for r in quality.score(docs).where("keep").collect()}
    after = docs.where(F.col("doc_id").isin(sorted(kept)))
    heads = {r.doc_id for r in near_copies.near_copies(after).where("doc_id = group_id").collect()}
    after = after.where(F.col("doc_id").isin(sorted(heads)))
    leaked = {r.doc_id for r in dc.leaks(after, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    out = {r.doc_id: r for r in cp.run(spark, sf_dir).collect()}
    assert set(out) == heads - leaked and leaked
    own = pieces.model(public_tokenizer(PIECE_BPE))
    clean = {r.doc_id: r.text for r in secrets.redact(after).collect()}
    assert all(own.decode(np.array(r.ids, np.int64)) == clean[i] and r.n_tokens == len(r.ids) for i, r in out.items())


def test_pipeline_edges(spark, clashing, empty, documents, rows, tmp_path):
    """Every stage on nulls, empty and long texts, repeated rows, clashing names and an empty table; then all of them."""
    import corpus_pipeline as cp

    bench = spark.createDataFrame([(1, rows[7][1]), (None, None)], "item_id long, text string")
    for name, docs in (("odd", clashing), ("empty", empty)):
        bench.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        docs.select(*documents.columns).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        for k, (_, stage) in enumerate(cp.STAGES):
            out = stage(spark, docs, f"{tmp_path}/{name}")
            left = out.collect()
            assert len(left) <= docs.count() and (name == "odd") == bool(left)
            assert out.columns == (docs.columns if k < 4 else ["doc_id", "n_tokens", "ids"])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = cp.run(spark, f"{tmp_path}/odd").collect()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    assert sum(r.doc_id is None for r in got) == 2 and {r.doc_id for r in got if r.doc_id is not None} < {r[0] for r in rows}
    assert cp.run(spark, f"{tmp_path}/empty").count() == 0


def plain_votes(text):
    """The labellers, one text at a time, in plain Python; and what the scorer sees of it."""
    raw = (text or "").encode()
    words = raw.split()
    blank = b" \t\n\r\x0b\x0c"
    point = lambda c: 33 <= c < 127 and not chr(c).isalnum()
    odd = lambda c: point(c) and chr(c) not in ".,;:'\"-()?"
    n, solid = len(words), sum(c not in blank for c in raw)
    upper, lower = sum(65 <= c < 91 for c in raw), sum(97 <= c < 123 or c > 127 for c in raw)
    again = sum(a == b for a, b in zip(words, words[1:]))
    parts = max(-(-n // quality.STRETCH), 1)
    fresh = len({(k * parts // max(n, 1), w) for k, w in enumerate(words)})
    runs = [tuple(words[k : k + quality.PASSAGE]) for k in range(n - quality.PASSAGE + 1)]
    repetition = max(1 - fresh / max(n, 1), (len(runs) - len(set(runs))) / max(n - quality.PASSAGE + 1, 1))
    one = max(n, 1)
    cases = [
        (sum(map(odd, raw)) / max(solid, 1), 0.01, 0.06),
        (upper / max(upper + lower, 1), 0.15, 0.5),
        (again / one, 0.03, 0.2),
        (sum(len(w) == 1 and point(w[0]) for w in words) / one, 0.02, 0.15),
        (sum(len(w) > 1 and point(w[-1]) and (odd(w[-1]) or odd(w[-2])) for w in words) / one, 0.03, 0.25),
        (repetition, 0.55, 0.8),
        (n / max(raw.count(b"."), 1), 60, 150),
        (solid / one, 10, 16),
    ]
    votes = [2 if n < 5 else 1 if x < good else 0 if x > bad else 2 for x, good, bad in cases]
    shape = [65 if 65 <= c < 91 else 97 if 97 <= c < 123 or c > 127 else 48 if 48 <= c < 58 else 32 if c in blank else c for c in raw]
    counts = np.zeros(quality.BUCKETS)
    for a, b, c in zip(shape, shape[1:], shape[2:]):
        counts[(((a * 31 + b) * 31 + c) * 2654435761 % (1 << 32)) >> (32 - 10)] += 1
    return votes, [*np.sqrt(counts / max(counts.sum(), 1)), math.sqrt(again / one), math.sqrt(max(repetition, 0)), 1.0], n


def plain_posteriors(votes, rounds=100):
    """Dawid and Skene over documents, not over patterns of votes."""
    good = [(v.count(1) + 1) / (v.count(1) + v.count(0) + 2) for v in votes]
    for _ in range(rounds):
        prior = [(len(good) - sum(good) + 1) / (len(good) + 2), (sum(good) + 1) / (len(good) + 2)]
        told_ = [[[sum((p if c else 1 - p) for v, p in zip(votes, good) if v[j] == x) + 1 for x in range(3)] for c in range(2)] for j in range(8)]
        weight = [len(good) - sum(good), sum(good)]
        now = []
        for v in votes:
            log = [math.log(prior[c]) + sum(math.log(told_[j][c][v[j]] / (weight[c] + 3)) for j in range(8)) for c in range(2)]
            now.append(1 / (1 + math.exp(min(max(log[0] - log[1], -700), 700))))
        done = max(abs(a - b) for a, b in zip(now, good)) < 1e-9
        good = now
        if done:
            break
    return good


def test_quality_against_a_plain_version(spark, rows, tables):
    """score() as a whole: votes, posteriors and features in plain Python, the ridge regression by Newton's method."""
    docs = [(r[0], r[1]) for r in rows] + [(r.doc_id + 1000, r.text) for r in tables("documents").orderBy("doc_id").limit(150).collect()]
    seen = [plain_votes(t) for _, t in docs]
    labels = plain_posteriors([v for v, *_ in seen])
    once = [*{d: k for k, d in enumerate(docs)}.values()]  # each document once
    x = np.array([seen[k][1] for k in once]).astype(np.float16).astype(float)
    y = np.array([labels[k] for k in once])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (p - y) / len(x) + 1e-3 * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(x) + 1e-3 * np.eye(len(w)), slope)
    got = quality.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    text_of = sorted(
        ((i, n, 1 / (1 + math.exp(-np.dot(f, w))), all(v == 2 for v in votes)) for (i, _), (votes, f, n) in zip(docs, seen)),
        key=lambda r: (r[0] is None, r[0] or 0, r[1])
    )
    told_ = sorted(((r.doc_id, r.n_words, r.score, r.keep) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [r[:2] for r in told_] == [r[:2] for r in text_of]
    assert max(abs(a[2] - b[2]) for a, b in zip(told_, text_of)) < 0.05
    assert all(a[3] == (b[2] >= 0.5 or b[3]) for a, b in zip(told_, text_of) if abs(b[2] - 0.5) > 0.05)


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = {re.match(r"op\d+_|pipeline", n)[0] for n in entry.queries() if re.match(r"op\d+_|pipeline", n)}
    assert names == {"pipeline", *(f"op{n}_" for n in range(1, 11))}


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op4_topk", "op6_secrets", "op8_licenses", "op9_sharding"])
def test_oracles(spark, name):
    from compare import differences
    from sedimenta.llm.queries import ORACLES, QUERIES

    assert differences(spark, QUERIES[name], ORACLES[name], "/root/testdata/sf0.001") == ""


def test_token_files_worker_memory():
    """What a worker holds to tokenise a batch does not grow with the batch: two workers share an executor's limit."""
    import tracemalloc

    import pyarrow as pa
    from sedimenta.llm import token_files
    from sedimenta.llm.base import chunks

    batch = pa.RecordBatch.from_pydict({"text": ["some words that stand again and again " * 50] * 4000})
    path = public_tokenizer("word_bpe_49k.json")
    token_files.tokenise(batch.column("text").slice(0, 1), path)
    tracemalloc.start()
    for part in chunks(iter([batch]), "text", token_files.TEXT_BYTES):
        token_files.tokenise(part.column("text"), path)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
