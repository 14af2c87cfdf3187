"""Folders of files to documents: formats, errors, ids, resuming, tilesets, streaming."""

import io
import json
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.operators import corpus as op
from sedimenta.operators.documents import generate
from sedimenta.sources import adapters as ad
from sedimenta.sources import files, sinks
from sedimenta.streaming.ingest import ingest

WORDS = " ".join(f"palabra{i}" for i in range(40))


def field(number, payload):
    return bytes([number << 3 | 2, len(payload)]) + payload


def tile(layer, features):
    keys = sorted({k for f in features for k in f})
    values = [v for f in features for v in f.values()]
    body = field(1, layer.encode())
    n = 0
    for f in features:
        tags = []
        for k in f:
            tags += [keys.index(k), n]
            n += 1
        body += field(2, field(2, bytes(tags)))
    for k in keys:
        body += field(3, k.encode())
    for v in values:
        body += field(4, field(1, v.encode()) if isinstance(v, str) else bytes([5 << 3, v]) if isinstance(v, int) else bytes([3 << 3 | 1]) + struct.pack("<d", v))
    return field(3, body)


def workbook(rows):
    cells = "".join("<row>" + "".join(f'<c t="inlineStr"><is><t>{v}</t></is></c>' for v in r) + "</row>" for r in rows)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns:r="r"><sheets><sheet name="a" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet><sheetData>{cells}</sheetData></worksheet>")
    return out.getvalue()


@pytest.fixture
def folder(tmp_path):
    def put(path, content):
        target = tmp_path / "corpus" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content if isinstance(content, bytes) else content.encode())

    put("F1_sur/b.TXT", "hola\r\nmundo")
    put("F1_sur/latin.md", "ni\xf1o".encode("latin-1"))
    put("a-b/x.csv", "k,v\n1,uno\n2,nan\nshort\n,,\n\n\"q\nr\",s\n")
    put("a/x.html", "<h1>T</h1><p>cuerpo")
    put("a/y.json", json.dumps({"title": "T", "body": WORDS}))
    put("a/broken.json", "{")
    put("a/skip.exe", b"\0")
    put("a/photo.png", b"\x89PNG")
    put("a/doc.pdf", b"%PDF-")
    put("t/book.xlsx", workbook([["k", "v"], ["1", "NA"], ["2", "dos"]]))
    put("mapa/tiles/0/0/0.pbf", tile("lugar", [{"fid": 7, "n": "uno"}, {"fid": 0, "n": "dos"}]))
    put("mapa/tiles/1/0/0.pbf", tile("lugar", [{"fid": 7, "n": "otra"}, {"n": "tres", "x": 1.5}]))
    put("mapa/tiles/1/0/bad.pbf", b"\xff\xff")
    return str(tmp_path / "corpus")


def test_generate(spark, folder):
    got = generate(spark, folder)
    rows = {r.fuente: r for r in got.documents.collect()}
    assert sorted(r.doc_id for r in rows.values()) == [f"DOC-{k:04d}" for k in range(1, 11)]
    order = sorted(rows, key=lambda s: rows[s].doc_id)
    assert order == ["mapa", "F1_sur/b.TXT", "F1_sur/latin.md", "a/broken.json", "a/doc.pdf", "a/photo.png", "a/x.html", "a/y.json", "a-b/x.csv", "t/book.xlsx"]
    assert rows["F1_sur/b.TXT"].texto_limpio == "hola\nmundo" and rows["F1_sur/b.TXT"].fenomeno == 1
    assert rows["F1_sur/latin.md"].texto_limpio == "niño"
    assert rows["a-b/x.csv"].texto_limpio == "k: 1 | v: uno\nk: 2\nk: q\nr | v: s"
    assert rows["a/x.html"].texto_limpio == "# T\n\ncuerpo"
    assert rows["t/book.xlsx"].texto_limpio == "k: 1\nk: 2 | v: dos"
    assert rows["mapa"].texto_limpio.split("\n") == ["capa: lugar | fid: 7 | n: uno", "capa: lugar | fid: 0 | n: dos", "capa: lugar | n: tres | x: 1.5"]
    assert rows["a/photo.png"].texto_limpio == "" and rows["a/doc.pdf"].texto_limpio == ""
    assert {r.fuente for r in got.errors.collect()} == {"a/broken.json", "a/doc.pdf"}


def test_resume_keeps_ids(spark, folder):
    first = generate(spark, folder)
    registry = first.registry.where("fuente <> 'a/y.json'")
    again = generate(spark, folder, registry, first.documents.where("fuente <> 'a/y.json'"))
    rows = again.documents.collect()
    assert [(r.fuente, r.doc_id) for r in rows] == [("a/y.json", "DOC-0011")]
    assert again.registry.count() == 10


def test_hooks(spark):
    options = ad.Options(hooks={
        "pdf": lambda c: [[(5.0, 20.0, "below"), (9.0, 1.02, "right"), (1.0, 1.04, " left ")], []],
        "pdf_ocr": lambda c,
        o: "read by eye " * 9,
        "image_ocr": lambda c,
        o: "x" * 29
    })
    assert ad.pdf_file("a.pdf", b"", options)[0] == "read by eye " * 9
    assert ad.page_text([(5.0, 20.0, "below"), (9.0, 1.02, "right"), (1.0, 1.04, " left ")]) == "left\nright\nbelow"
    assert ad.image_file("a.png", b"", options) == ("", {})
    with pytest.raises(ValueError):
        ad.load_document("a.rtf", b"")


@pytest.mark.parametrize("read", ["\n" * 18, " " * 60 + "Acta", "Acta 7", RuntimeError("no model"), None])
def test_ocr_takes_no_text_away(read):
    """White space is no text, and an engine that fails leaves what the file says."""

    def engine(content, options):
        if isinstance(read, Exception):
            raise read
        return read

    options = ad.Options(hooks={"pdf": lambda c: [[(0.0, 0.0, "Acta 7")]], "pdf_ocr": engine})
    text, meta = ad.pdf_file("a.pdf", b"", options)
    assert text == "Acta 7" and meta.get("ocr_aplicado") is None
    assert meta.get("ocr_error") == ("RuntimeError: no model" if isinstance(read, Exception) else None)


def test_ocr_of_pages_that_fail(monkeypatch):
    """A page that can't be read is empty, the others count; PDF files and images have the same reader."""
    import sys
    from types import SimpleNamespace as N

    class Document(list):
        __enter__ = lambda self: self
        __exit__ = lambda self, *_: None

    pages = [N(get_text=lambda _: [], get_pixmap=lambda matrix, k=k: N(tobytes=lambda kind: k)) for k in range(3)]
    monkeypatch.setitem(sys.modules, "fitz", N(open=lambda stream, filetype: Document(pages), Matrix=lambda x, y: None))
    monkeypatch.setitem(sys.modules, "easyocr", N(Reader=lambda names, gpu: N(readtext=lambda k, detail, paragraph: [f"{names} {k}", str(6 // k)])))
    monkeypatch.setattr(ad, "_readers", {})
    assert ad.pdf_file("x.pdf", b"", ad.Options(ocr_languages=" spa + xx+"))[0] == "\n\n['es', 'xx'] 1\n\n6\n\n['es', 'xx'] 2\n\n3"
    assert ad.easyocr_languages(" + ") == ["es"]


def test_csv_counts():
    text, meta = ad.csv_file("x.csv", b"a,b,a\n1,2,3\n1\n1,2,3,4\n,,\n\n", ad.Options())
    assert text == "a: 3 | b: 2"
    assert (meta["num_filas_validas"], meta["filas_omitidas_por_formato_invalido"], meta["columnas"]) == (2, 2, ["a", "b", "a"])


def test_sinks_and_lists(spark, tmp_path):
    rows = spark.createDataFrame([("a/b.png", "uno", None), ("c.png", "dos", "x")], "fuente string, texto string, error string")
    sinks.write_jsonl(rows, f"{tmp_path}/o.jsonl")
    sinks.write_jsonl(rows, f"{tmp_path}/o.jsonl", "append")
    assert files.load_records(spark, f"{tmp_path}/o.jsonl").count() == 4
    assert {r.fuente for r in files.load_processed(spark, f"{tmp_path}/o.jsonl").collect()} == {"a/b.png", "c.png"}
    (tmp_path / "l.txt").write_text('"a\\\\b"\n\n  c  \n"a\\\\b"\n')
    assert {r.fuente for r in files.load_list(spark, f"{tmp_path}/l.txt").collect()} == {"a\\b", "c"}


def test_one_text_file_an_image(spark, tmp_path):
    long = "texto " * 20
    rows = spark.createDataFrame(
        [("a/b.png", long), ("a/b.jpg", "other"), ("c.tar.gif", "dos"), ("a/d/.e", None), ("c.tar.gif", "dos ")],
        "fuente string, texto string"
    )
    got = sorted(tuple(r) for r in sinks.write_texts(rows, f"{tmp_path}/t").collect())
    assert got == [("a/b.png", "a/b.txt", "ok"), ("a/d/.e", "a/d/.e.txt", "empty"), ("c.tar.gif", "c.tar.txt", "empty")]
    there = {str(x.relative_to(tmp_path / "t")): x.read_text() for x in (tmp_path / "t").rglob("*") if x.is_file()}
    assert there == {"a/b.txt": long.strip(), "a/d/.e.txt": "", "c.tar.txt": "dos"}


def test_registry_survives_a_failed_write(spark, tmp_path):
    path = f"{tmp_path}/r"
    assert sinks.read_registry(spark, path).count() == 0
    for n in (1, 2, 3):
        sinks.write_registry(spark.createDataFrame([(f"f{k}", f"DOC-000{k}") for k in range(n)], "fuente string, doc_id string"), path)
        assert sinks.read_registry(spark, path).count() == n
    assert sorted(x.name for x in (tmp_path / "r").iterdir()) == ["v=2", "v=3"]
    broken = sinks.read_registry(spark, path).select("fuente", F.raise_error(F.lit("stop")).cast("string").alias("doc_id"))
    with pytest.raises(Exception, match="stop"):
        sinks.write_registry(broken, path)
    assert sinks.read_registry(spark, path).count() == 3
    sinks.write_registry(sinks.read_registry(spark, path).limit(1), path)  # from what it replaces, over what the failure left
    assert sinks.read_registry(spark, path).count() == 1


def test_scratch_removes_what_was_written_inside(spark):
    from sedimenta.plans import durable

    before = durable.materialize(spark.range(3))
    with pytest.raises(ZeroDivisionError), durable.scratch(spark):
        inside = durable.materialize(spark.range(4))
        with durable.scratch(spark):
            deeper = durable.materialize(spark.range(5))
        paths = [df.inputFiles()[0].rsplit("/", 1)[0] for df in (before, inside, deeper)]
        assert [durable.exists(spark, p) for p in paths] == [True, True, False]
        raise ZeroDivisionError
    assert [durable.exists(spark, p) for p in paths] == [True, False, False]


def test_vector_index(spark, tmp_path):
    from sedimenta.functions import vectors as vx

    rows = [(f"f{k:02}", "x" * k, [float(k), 1.0]) for k in range(30)] + [("none", None, None)]
    path = f"{tmp_path}/i"
    with pytest.raises(FileNotFoundError):
        sinks.read_index(spark, path)
    sinks.write_index(spark.createDataFrame(rows, "fuente string, texto string, dense array<float>").repartition(3), path, ["fuente"])
    index = sinks.read_index(spark, path)
    assert [(r.vec_id, r.fuente) for r in index.orderBy("vec_id").collect()] == [(k, r[0]) for k, r in enumerate(rows[:30])]
    asked = spark.createDataFrame([(7, [11.2, 1.0])], "query_id long, q array<double>")
    got = vx.search_index(asked, index, 3).orderBy("rank").collect()
    assert [(r.rank, r.fuente, r.texto) for r in got] == [(1, "f11", "x" * 11), (2, "f12", "x" * 12), (3, "f10", "x" * 10)]


@pytest.mark.parametrize("by", ["l2", "dot"])
def test_nearest_is_exact(spark, by):
    """Near ties, equal vectors, large norms, nulls, other lengths, fewer than k."""
    import random

    from sedimenta.functions import vectors as vx

    draw = random.Random(5)
    base = [1e6 + draw.random() for _ in range(5)]
    rows = [(
        k,
        [x + draw.choice((0.0, 1e-9, 1e-7, 3.0)) for x in base]
    ) for k in range(300)] + [(300 + k, [draw.uniform(-1, 1) for _ in range(5)]) for k in range(1500)]
    rows += [(5000, [1.0]), (5001, None), (None, base), (5002, [None] * 5), (5003, [])]
    asked = [(1, base), (2, rows[400][1]), (3, [0.5]), (4, [0.0] * 5), (5, None)]
    term = (lambda a, b: (b - a) ** 2) if by == "l2" else (lambda a, b: -a * b)
    want = []
    for q, v in asked:
        costs = sorted(
            (float(np.array([term(a, b) for a, b in zip(v, w)]).sum()), i) for i,
            w in rows if i is not None and w is not None and None not in w and len(w) == len(v)
        ) if v is not None else []
        want += [(q, i, c if by == "l2" else -c, r) for r, (c, i) in enumerate(costs[:7], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = vx.nearest(spark.createDataFrame(asked, "query_id long, q array<double>"), vectors, 7, by)
    assert sorted(tuple(r) for r in got.select("query_id", "vec_id", "score", "rank").collect()) == sorted(want)


def test_similarities_are_packed(spark, tmp_path, monkeypatch):
    """Rounded scores take under 6 bytes in small files (over 7 where Parquet gives up its dictionary); many pairs make more tasks; none is lost."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from sedimenta.functions import vectors as vx

    v = np.random.default_rng(5).normal(size=(6000, 64)) / 8
    pq.write_table(pa.table({"vec_id": np.arange(6000), "embedding": list(v)}), tmp_path / "v.parquet")
    vectors = spark.read.parquet(str(tmp_path / "v.parquet"))
    asked = vectors.where("vec_id % 50 = 0").selectExpr("vec_id AS query_id", "embedding AS q")
    vx.similarities(asked, vectors).select("query_id", "vec_id", F.round("score", 5).alias("score")).write.parquet(str(tmp_path / "found"))
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "found").glob("*.parquet")]
    assert sum(m.row_group(g).column(2).total_compressed_size for m in files for g in range(m.num_row_groups)) < 6 * 120 * 6000
    rows = pq.read_table(tmp_path / "found").sort_by([("query_id", "ascending"), ("vec_id", "ascending")])
    assert np.array_equal(rows["query_id"], np.repeat(np.arange(0, 6000, 50), 6000))
    assert np.array_equal(rows["vec_id"], np.tile(np.arange(6000), 120))
    assert np.abs(rows["score"].to_numpy() - (v[::50] @ v.T).ravel()).max() < 0.00000501
    monkeypatch.setattr(vx, "TASK_PAIRS", 100_000, raising=False)
    assert vx.similarities(asked, vectors).rdd.getNumPartitions() == 8


def test_patch_takes_one_change(spark):
    docs = spark.createDataFrame(
        [("a", "old", 3, "es", {"p": "1"}), ("b", "old", 3, "es", None)],
        "fuente string, texto string, num_caracteres int, idioma string, meta_extra map<string,string>"
    )
    changes = spark.createDataFrame(
        [
            ("a", "zwei", 4, "de", {"o": "1"}, None),
            ("a", "eins", 4, "de", {"o": "2"}, None),
            ("a", "", 0, "und", None, "broken"),
            ("b", "", 0, "und", None, "broken")
        ],
        "fuente string, texto string, num_caracteres int, idioma string, meta_extra map<string,string>, error string"
    )
    for c in (changes, changes.orderBy(F.desc("texto"))):
        assert sorted((r.fuente, r.texto, r.meta_extra) for r in op.patch(docs, c).collect()) == [("a", "eins", {"p": "1", "o": "2"}), ("b", "old", None)]
        assert sorted(tuple(r) for r in op.patch_outcomes(docs.select("fuente"), c, 2).collect()) == [("a", "ok"), ("b", "error")]


def test_ocr_engines(monkeypatch):
    """The adapters that are tried where libraries are installed, with stand-ins for these."""
    import sys
    from types import SimpleNamespace as N

    scales = []
    page = N(get_text=lambda _: [], get_pixmap=lambda matrix: N(tobytes=lambda kind: b"png"))

    class Document(list):
        __enter__ = lambda self: self
        __exit__ = lambda self, *_: None

    with pytest.raises(ad.Missing):
        ad.pdf_ocr(b"", ad.Options())
    monkeypatch.setitem(sys.modules, "fitz", N(open=lambda stream, filetype: Document([page, page]), Matrix=lambda x, y: scales.append((x, y))))
    monkeypatch.setitem(sys.modules, "PIL.Image", N(open=lambda f: f.read()))
    monkeypatch.setitem(
        sys.modules,
        "pytesseract",
        N(
            Output=N(DICT="d"),
            image_to_data=lambda png,
            lang,
            output_type: {"text": ["uno", " ", f"{lang}"]},
            image_to_string=lambda png,
            lang: "palabras de la imagen leída aquí"
        )
    )
    assert ad.pdf_file("x.pdf", b"", ad.Options(ocr_dpi=144)) == (
        "uno spa+eng\n\nuno spa+eng",
        {"num_paginas": 2, "ocr_aplicado": True, "ocr_dpi": 144, "ocr_idiomas": "spa+eng"}
    )
    assert scales == [(2.0, 2.0)] * 2 and ad.zoom_scale(300) == 300 / 72
    assert ad.pdf_file("x.pdf", b"", ad.Options(ocr=False)) == ("\n\n", {"num_paginas": 2})
    assert ad.image_file("x.png", b"", ad.Options()) == ("palabras de la imagen leída aquí", {})
    monkeypatch.setitem(sys.modules, "easyocr", N(Reader=lambda languages, gpu: N(readtext=lambda c, detail, paragraph: [f"{languages} {gpu} " + "x" * 30, "y"])))
    assert ad.image_file("x.png", b"", ad.Options()) == ("['es', 'en'] False " + "x" * 30 + "\n\ny", {})


@pytest.mark.parametrize(
    "value, date, text",
    [
        ("1", False, "1"),
        ("1.5", False, "1.5"),
        ("0.30000000000000004", False, "0.30000000000000004"),
        ("1E3", False, "1000.0"),
        ("45296", True, "2024-01-05 00:00:00"),
        ("45296.75", True, "2024-01-05 18:00:00"),
        ("0.5", True, "12:00:00"),
        ("1", True, "1900-01-01 00:00:00"),
        ("61", True, "1900-03-01 00:00:00"),
        ("x", False, "x")
    ]
)
def test_workbook_numbers(value, date, text):
    assert ad.number_text(value, date) == text


def test_chunk_limits(spark):
    rows = spark.createDataFrame([(1, "a b c d e"), (2, ""), (3, None)], "doc_id int, text string")
    got = [(r.doc_id, r.chunk_ix, r.chunk) for r in op.chunk_words(rows, size=3, overlap=1).orderBy("doc_id", "chunk_ix").collect()]
    assert got == [(1, 0, "a b c"), (1, 1, "c d e"), (1, 2, "e")]
    with pytest.raises(ValueError):
        op.chunk_words(rows, size=3, overlap=3)


def test_stream_remembers(spark, tmp_path):
    source, target, mark = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/mark"
    for k in range(2):
        spark.createDataFrame([(k, f" t{k} ")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(source)
        ingest(spark, source, target, mark, 1)
    assert sorted(r.texto_limpio for r in spark.read.parquet(target).collect()) == ["t0", "t1"]


def test_listing_takes_names_as_they_are(spark, tmp_path):
    names = ["a b.txt", "ñandú.txt", "100%.txt", "x+y.TXT", "p%20q.txt", "sub dir/#1.txt", ".hidden/x", "no_ending"]
    for name in names:
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text("x")
    rows = {r.fuente: r.e for r in files.listing(spark, f"{tmp_path}/in").select("fuente", files.extension(F.col("fuente")).alias("e")).collect()}
    assert {k: v for k, v in rows.items() if not k.startswith(".")} == {k: ("" if k == "no_ending" else ".txt") for k in names if not k.startswith(".")}


def test_feature_identity():
    assert files.identity({"fid": 7}) == files.identity({"id": 7.0, "fid": 0}) != files.identity({"fid": "7"})
    assert files.identity({"fid": 0, "a": 1}) != files.identity({"fid": "", "a": 1})


def test_numbering_is_global(spark):
    rows = spark.createDataFrame([(f"{k % 7}/{k}",) for k in range(300)], "p string").repartition(5)
    got = [(r.p, r.n) for r in op.numbered(rows, op.path_order(F.col("p")), first=5).collect()]
    order = sorted((p for p, _ in got), key=lambda p: p.split("/"))
    assert sorted(got, key=lambda x: x[1]) == [(p, k) for k, p in enumerate(order, 5)]
    assert op.numbered(rows.limit(0), "p").count() == 0


def test_stream_gives_lasting_ids(spark, tmp_path):
    from sedimenta.streaming.ingest import ingest_with_ids

    where = [f"{tmp_path}/{x}" for x in ("in", "out", "registry", "mark")]
    for k in range(2):
        rows = [(f"F1_a/{k}{j}.txt", "txt", f" text {k}{j} ") for j in range(2)] + [("F1_a/00.txt", "txt", "again")]
        spark.createDataFrame(rows, "fuente string, formato string, text string").coalesce(1).write.mode("append").parquet(where[0])
        ingest_with_ids(spark, *where)
    got = sorted((r.doc_id, r.fuente) for r in spark.read.parquet(where[1]).select("doc_id", "fuente").distinct().collect())
    assert got == [("DOC-0001", "F1_a/00.txt"), ("DOC-0002", "F1_a/01.txt"), ("DOC-0003", "F1_a/10.txt"), ("DOC-0004", "F1_a/11.txt")]
    assert spark.read.parquet(where[2]).count() == 4


def test_a_new_checkpoint_overwrites_nothing(spark, tmp_path):
    from sedimenta.streaming.ingest import ingest_with_ids

    where = [f"{tmp_path}/{x}" for x in ("in", "out", "registry")]
    for k, mark in enumerate(["m0", "m1", "m1", "m0"]):
        rows = [(f"F1_a/{k}.txt", "txt", f"text {k}")]
        spark.createDataFrame(rows, "fuente string, formato string, text string").coalesce(1).write.mode("append").parquet(where[0])
        ingest_with_ids(spark, *where, f"{tmp_path}/{mark}", 1)
    got = sorted((r.doc_id, r.fuente, r.texto_limpio) for r in spark.read.parquet(where[1]).collect())
    assert got == [(f"DOC-000{k + 1}", f"F1_a/{k}.txt", f"text {k}") for k in range(4)]
    assert sorted(r.doc_id for r in spark.read.parquet(where[2]).collect()) == [x[0] for x in got]


def test_stream_of_a_folder(spark, folder, tmp_path):
    """Files that come late, a replay of the last batch, and a second checkpoint give what one batch gives."""
    import shutil
    from pathlib import Path

    from sedimenta.operators.documents import DOCUMENT
    from sedimenta.streaming.ingest import REGISTERED, ingest_folder, read_ingested

    late, where = tmp_path / "late", [f"{tmp_path}/{x}" for x in ("out", "registry", "errors")]
    late.mkdir()
    for name in ("a/x.html", "a/broken.json", "F1_sur/latin.md"):
        shutil.move(f"{folder}/{name}", late / name.replace("/", "+"))

    def told():
        documents = read_ingested(spark, where[0], DOCUMENT).collect()
        errors = read_ingested(spark, where[2], "fuente string, error string, traceback string").collect()
        return sorted(tuple(r) for r in documents), sorted((r.fuente, r.error) for r in errors)

    ingest_folder(spark, folder, *where, f"{tmp_path}/m0", files_per_batch=2)
    first, _ = told()
    for moved in sorted(late.iterdir()):
        shutil.move(moved, Path(folder) / moved.name.replace("+", "/"))
    ingest_folder(spark, folder, *where, f"{tmp_path}/m0", files_per_batch=2)
    second = told()
    assert set(first) < set(second[0])
    newest = max(int(p.name) for p in (tmp_path / "m0" / "commits").iterdir() if p.name.isdigit())
    for name in (f"{newest}", f".{newest}.crc"):
        (tmp_path / "m0" / "commits" / name).unlink(missing_ok=True)  # as if stopped before the end of the last batch
    ingest_folder(spark, folder, *where, f"{tmp_path}/m0", files_per_batch=2)
    ingest_folder(spark, folder, *where, f"{tmp_path}/m1")
    assert told() == second
    batch = generate(spark, folder)
    assert sorted(r[1:] for r in second[0]) == sorted(tuple(r)[1:] for r in batch.documents.where("formato <> 'pbf'").collect())
    assert second[1] == sorted((r.fuente, r.error) for r in batch.errors.collect())
    ids = [r[0] for r in second[0]]
    assert sorted(ids) == [f"DOC-{k:04d}" for k in range(1, len(ids) + 1)]
    assert {(r.fuente, r.doc_id) for r in read_ingested(spark, where[1], REGISTERED).collect()} == {(r[1], r[0]) for r in second[0]}


def test_commands(spark, folder, tmp_path, capsys):
    from sedimenta.__main__ import main

    out = f"{tmp_path}/docs.jsonl"
    main(["corpus", folder, out, "--registry", f"{tmp_path}/reg", "--errors", f"{tmp_path}/err"])
    assert spark.read.json(out).count() == 10 and spark.read.json(f"{tmp_path}/err").count() == 2
    assert "n: 10, n_empty: 3, n_errors: 2" in capsys.readouterr().out
    main(["corpus", folder, out, "--registry", f"{tmp_path}/reg", "--resume"])
    assert spark.read.json(out).count() == 10
    assert sinks.read_registry(spark, f"{tmp_path}/reg").count() == 10
    main(["harvest", folder, f"{tmp_path}/log", "--texts", f"{tmp_path}/texts", "--catalog", "broken.json"])
    tiers = {r.archivo: r.tier for r in spark.read.json(f"{tmp_path}/log").collect()}
    assert tiers == {"a/y.json": 1, "a/broken.json": 0}
    assert [(r.doc_id, r.fenomeno, r.org) for r in spark.read.json(f"{tmp_path}/texts").collect()] == [("DOC-0000", 0, "a")]
    main(["census", f"{tmp_path}/log"])
    assert "body" in capsys.readouterr().out
    main(["encode", f"{tmp_path}/texts", f"{tmp_path}/vec", "--encoder", "hash64", "--text-field", "texto"])
    assert len(spark.read.parquet(f"{tmp_path}/vec").first().dense) == 64


def test_a_task_takes_in_many_small_files(spark, tmp_path, monkeypatch):
    from sedimenta.streaming import ingest

    (tmp_path / "in").mkdir()
    for k in range(300):
        (tmp_path / "in" / f"{k}.txt").write_text(f"text {k}")
    seen, own, key = [], ingest.extract, "spark.sql.files.openCostInBytes"
    monkeypatch.setattr(ingest, "extract", lambda rows, options: seen.append(rows.rdd.getNumPartitions()) or own(rows, options))
    before = spark.conf.get(key)
    ingest.ingest_folder(spark, f"{tmp_path}/in", *[f"{tmp_path}/{x}" for x in ("out", "registry", "errors", "mark")])
    assert len(seen) == 1 and seen[0] <= 5 and spark.conf.get(key) == before
    assert ingest.read_ingested(spark, f"{tmp_path}/registry", ingest.REGISTERED).count() == 300


def test_extracted_texts_leave_before_a_batch_ends():
    import pyarrow as pa

    n, size = 60, 100_000
    batch = pa.RecordBatch.from_pydict({
        "fuente": [f"{k}.txt" for k in range(n)] + ["none.json", "cut.json"],
        "formato": ["txt"] * n + ["json"] * 2,
        "content": pa.array([b"x" * size] * n + [None, b'{"cut'], pa.binary())
    })
    frames = list(files.extracted(iter([batch, batch]), ad.Options()))
    assert max(f.num_rows for f in frames) <= files.EXTRACT_CHARS // size + 3
    rows = [r for f in frames for r in f.to_pylist()]
    assert [r["fuente"] for r in rows] == batch.column("fuente").to_pylist() * 2
    assert all(r["texto"] == "x" * size and r["error"] is None for r in rows[:n])
    assert [r["error"].split(":")[0] for r in rows[n : n + 2]] == ["TypeError", "ValueError"] and rows[n]["texto"] == ""
    small = pa.RecordBatch.from_pydict({"fuente": ["a.txt"] * 3000, "formato": ["txt"] * 3000, "content": pa.array([b""] * 3000, pa.binary())})
    assert [f.num_rows for f in files.extracted(iter([small]), ad.Options())] == [1024, 1024, 952]
