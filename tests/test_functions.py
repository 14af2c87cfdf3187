"""Text, JSON and vector functions on small cases; native expressions against Python."""

import json

import pytest
from pyspark.sql import functions as F

from sedimenta.functions import json_harvest as jh
from sedimenta.functions import text as tx
from sedimenta.functions import text_udf as tu
from sedimenta.functions import vectors as vx

P = " ".join(f"palabra{i}" for i in range(36))
Q = " ".join(f"frase{i}" for i in range(26))

ODD = [
    "",
    " ",
    "a\x00b\x0b c​d",
    "x\n\n\n\ny\n \n z ",
    "Menu\nMenu\n Menu\nbody",
    "a\nb\na\nb\n\n\n\na",
    "é　end",
    "line" * 30 + "\n" + ("line" * 30 + "\n") * 3,
    "one\ttwo  three\r\n",
    " lead\x85"
]


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r[1] for r in rows.select("k", f(F.col("v")).alias("o")).orderBy("k").collect()]


def test_clean_text_is_its_steps(spark):
    whole = column(spark, [*ODD, None], tu.clean_text)
    steps = column(spark, ODD, lambda c: tx.collapse_whitespace(tx.remove_repeated_lines(tu.normalize_nfc(tx.remove_control_chars(c)))))
    assert whole == [*steps, ""]
    assert whole[4] == "body" and whole[3] == "x\n\ny\n\nz"


def test_strip_and_counts(spark):
    assert column(spark, ODD, tx.strip) == [x.strip() for x in ODD]
    assert column(spark, ODD, tx.word_count) == [len(x.split()) for x in ODD]
    assert column(spark, ["中文 a", None], tx.word_count_cjk) == [4, None]


@pytest.mark.parametrize(
    "path, want",
    [("F1_x/a.txt", 1), ("a/Fenómeno 2/b", 2), ("FENÓMENO-3/f1_x", 3), ("fenomeno2", 2), ("xf1_a", None), ("a/b", None), ("f3-norte/fenomeno1", 3)],
)
def test_category(spark, path, want):
    assert column(spark, [path], tx.category_from_path) == [want]


def test_tileset_root(spark):
    paths = ["a/Tiles/1/2/3.pbf", "tiles/1.pbf", "a/b.pbf", "b.pbf", "a/tiles/b/tiles/c.pbf"]
    assert column(spark, paths, tx.tileset_root) == ["a", ".", "a", ".", "a/tiles/b"]


def test_junk(spark):
    values = ["https://x.y/z", "2024-01-02T10", "12,5 %", "DEADBEEFDEADBEEF", "and/or", "a.pdf", "plain text", " 12 ", "x 1"]
    assert column(spark, values, tx.is_junk) == [True, True, True, True, True, True, False, True, False]


CASES = [
    (json.dumps({"title": "T", "body_text": P}), 1, [P]),
    (json.dumps({"headline": "T", "content": P, "author": "Ana"}), 1, [P]),
    (json.dumps({"article": {"title": "T", "paragraphs": [P, Q]}}), 1, [P, Q]),
    (json.dumps({"content": {"blocks": [P + Q, Q + P]}}), 1, [P + Q]),
    (json.dumps({"body_paragraphs": [{"text": P}, {"text": Q}]}), 1, [P, Q]),
    ("﻿" + json.dumps({"body_text": P}), 1, [P]),
    (json.dumps({"body_text": P}) + "\n" + json.dumps({"body_text": Q}), 1, [P, Q]),
    (json.dumps([{"body_text": P}, {"body_text": Q}]), 1, [P, Q]),
    (json.dumps({"title": "T", "notas": {"raro": P}}), 1, [P]),
    (json.dumps({"title": "T", "images": [{"alt": P}]}), 2, [P]),
    (json.dumps({"url": "https://a", "date": "2024-01-01", "tags": ["a", "b"]}), 3, []),
    ('{"a": ', 0, []),
    (json.dumps({"body": "中" * 40}), 1, ["中" * 40]),
]


@pytest.mark.parametrize("raw, tier, parts", CASES)
def test_harvest(raw, tier, parts):
    got = jh.harvest(raw)
    assert got["tier"] == tier
    at = [got["texto"].index(p) for p in parts]
    assert at == sorted(at)
    assert jh.harvest(raw.encode()) == got


def test_harvest_keeps_one_body():
    both = jh.harvest(json.dumps({"body_paragraphs": [P, Q], "body_text": f"{P} {Q}"}))
    assert both["texto"] == f"{P}\n\n{Q}" and "body_text" not in both["claves_texto"]
    far = jh.harvest(json.dumps({"body_paragraphs": [P, Q], "alerta_meta": {"tema_clave": P}}))
    assert far["texto"].count(P) == 1
    assert jh.harvest(json.dumps({"body_paragraphs": [P]}) + "\n" + json.dumps({"body": Q}))["texto"] == P


def test_harvest_meta():
    got = jh.harvest(json.dumps({"author": None, "date": "x" * 400, "tags": ["a", 1], "year": 2020, "body": P, "año": "2020", "sub": {"author": "late"}}))
    assert got["meta"] == {"date": "x" * 300, "tags": "a, 1", "year": "2020", "author": "late"}
    assert got["claves_meta"] == ["date", "tags", "year", "sub.author"]
    assert "https" not in jh.harvest(json.dumps({"body": P, "pdf_links": ["https://x"], "ref": "https://y"}))["texto"]


def test_outline():
    page = "<html><head><title>t</title></head><body><h1>A &amp; B</h1><p>x<b>y</b></p><script>'</p>'</script><ul><li>one</ul><br/>z &am"
    assert tu.outline(page) == "\n\n# A & B \n\nx y \n- one \n\n"
    assert tu.outline(None) == "" and tu.outline("<head>x") == ""


def test_sparse_dot_is_symmetric(spark):
    rows = spark.sql("select map(1, 2.0D, 2, 1.0D) a, map(2, 3.0D, 3, 5.0D) b")
    assert rows.select(vx.sparse_dot(F.col("a"), F.col("b")), vx.sparse_dot(F.col("b"), F.col("a"))).first()[:] == (3.0, 3.0)


def test_encoder(spark):
    rows = spark.createDataFrame([(1, "a b a"), (2, None), (3, "c")], "k int, t string")
    got = {r.k: r.e for r in rows.select("k", vx.encode_texts(F.col("t"), "hash64", "query").alias("e")).collect()}
    assert all(abs(sum(x * x for x in e.dense) - 1) < 1e-5 and len(e.dense) == 64 for e in got.values())
    assert got[1].n_tokens == 4 and sorted(got[1].sparse.values()) == [1.0, 1.0, 2.0]
    with pytest.raises(ValueError):
        vx.encode_texts(F.col("t"), "none")


def test_cleaning_on_random_texts(spark):
    """Column expressions and the Arrow function agree on texts made of everything that cleaning looks at."""
    import random

    draw = random.Random(8)
    parts = [
        "a",
        "B",
        "é",
        "e\u0301",
        " ",
        "  ",
        "\t",
        "\n",
        "\n\n\n",
        "\r",
        "\x00",
        "\x0b",
        "\x1c",
        "\x7f",
        "\x85",
        "\xa0",
        "\u200b",
        "\u3000",
        "\ufeff",
        "Menu\n",
        " Menu\n",
        "x" * 81 + "\n",
        "中",
        "😀"
    ]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 60))) for _ in range(400)]
    steps = column(spark, texts, lambda c: tx.collapse_whitespace(tx.remove_repeated_lines(tu.normalize_nfc(tx.remove_control_chars(c)))))
    assert column(spark, texts, tu.clean_text) == steps == [tu.clean(t) for t in texts]
    assert column(spark, texts, tx.word_count) == [len(t.split()) for t in texts]
    assert column(spark, texts, tx.strip) == [t.strip() for t in texts]


@pytest.mark.parametrize("raw", ['{"a": ' + "9" * 5000 + "}", "[" * 100_000, '{"a": 1}\n{"a": ' + "9" * 5000 + "}"])
def test_json_that_stops_the_parser_is_unreadable(spark, raw):
    rows = spark.createDataFrame([(raw,)], "raw string").select(jh.harvest_json("raw").alias("h"))
    assert rows.first().h.tier == 0


def test_json_with_lone_surrogates(spark):
    raw = '{"title": "a \\ud800 b", "k\\udfffey": "' + "words of prose " * 20 + '\\ud83d\\ude00", "author": "x\\udc00", "tags": ["\\ud801"]}'
    h = spark.createDataFrame([(raw,)], "raw string").select(jh.harvest_json("raw").alias("h")).first().h
    assert h.texto.startswith("a \ufffd b\n\nwords") and h.texto.endswith("\U0001f600")
    assert h.meta == {"author": "x\ufffd", "tags": "\ufffd"} and h.claves_raiz == ["author", "k\ufffdey", "tags", "title"]


def test_trained_encoders(monkeypatch):
    """The adapters of trained encoders, with stand-ins for their libraries."""
    import sys
    from types import SimpleNamespace as N

    import numpy as np

    monkeypatch.setitem(sys.modules, "torch", N(cuda=N(is_available=lambda: True)))
    assert vx.pick_device() == "cuda" and vx.pick_device("cpu") == "cpu"
    monkeypatch.setitem(sys.modules, "torch", None)
    assert vx.pick_device() == "cpu"
    told = []
    tokens = lambda text, truncation: {"input_ids": text.split()}
    dense = N(tokenizer=tokens, encode=lambda texts, **k: told.append(k) or np.ones((len(texts), 4)) / 2)
    monkeypatch.setitem(sys.modules, "sentence_transformers", N(SentenceTransformer=lambda name, device: told.append((name, device)) or dense))
    encoder = vx.ENCODERS["e5"]()
    vectors, sparse = encoder.encode(["a b", "c"])
    assert vectors.dtype == np.float32 and vectors.shape == (2, 4) and sparse == [{}, {}] and encoder.count_tokens("a b") == 2
    assert dense.max_seq_length == 512 and told[0] == ("intfloat/multilingual-e5-large", "cpu") and told[1]["batch_size"] == 8
    both = N(tokenizer=tokens, encode=lambda texts, **k: {"dense_vecs": np.ones((len(texts), 2)), "lexical_weights": [{"7": 0.5, "8": 0.0, "9": -1.0}] * len(texts)})
    monkeypatch.setitem(sys.modules, "FlagEmbedding", N(BGEM3FlagModel=lambda name, use_fp16, devices: both))
    vectors, sparse = vx.ENCODERS["bge-m3"]().encode(["x"])
    assert vectors.shape == (1, 2) and sparse == [{7: 0.5}]


def test_texts_whose_signs_cancel_have_unit_vectors():
    from sedimenta.functions.vectors import HashEncoder

    encoder = HashEncoder(64)
    words = [f"w{k}" for k in range(3000)]
    alone, _ = encoder.encode(words)
    texts = [f"passage {w}" for w in words]
    own = encoder.encode(["passage"])[0][0]
    cancelled = [t for t, v in zip(texts, alone, strict=True) if not (v + own).any()]
    assert len(cancelled) > 5
    dense, sparse = encoder.encode([*cancelled, "", "x İstanbul"])
    assert [round(float((v * v).sum()), 5) for v in dense] == [1.0] * len(cancelled) + [0.0, 1.0]
    assert sum(sparse[-1].values()) == encoder.count_tokens("x İstanbul") == 2


def test_cleaning_holds_few_texts_as_strings():
    import tracemalloc

    import pyarrow as pa

    texts = pa.array([f"{k} " + "x" * 10_000 for k in range(4000)] + [None, ""])
    tracemalloc.start()
    try:
        done = tu.clean_text.func(texts)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 4 << 20, most
    assert done[1].as_py() == texts[1].as_py() and done.to_pylist()[-2:] == ["", ""] and len(done) == 4002
    assert tu.clean_text.func(texts.slice(0, 0)).to_pylist() == []
    odd = [*ODD, None] * 40
    assert tu.clean_text.func(pa.array(odd, pa.string())[3:]).to_pylist() == [tu.clean(t) for t in odd[3:]]
