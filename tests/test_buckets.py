"""Outputs in buckets: only what is touched is rewritten."""

from pathlib import Path

from pyspark.sql import functions as F

from sedimenta.operators import buckets as bk
from sedimenta.operators import corpus as op

SCHEMA = "fuente string, texto string, num_caracteres int, idioma string, meta_extra map<string,string>"


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_patch_in_place(spark, tmp_path):
    path = f"{tmp_path}/out"
    docs = spark.createDataFrame([(f"s{k}", "old", 3, "en", {"o": str(k)}) for k in range(200)] + [("s7", "again", 5, "de", None)], SCHEMA)
    bk.write_buckets(docs, path, 16)
    told = lambda df: sorted((r.fuente, r.texto, r.num_caracteres, r.idioma, str(sorted((r.meta_extra or {}).items()))) for r in df.collect())
    assert told(bk.read_buckets(spark, path, SCHEMA)) == told(docs)
    before = files(path)
    changes = spark.createDataFrame(
        [("s7", "neu", 3, "de", {"p": "1"}, None), ("s8", "", 0, "", None, "broken"), ("gone", "x", 1, "en", None, None), ("s9", "neun", 4, "de", None, None)],
        SCHEMA + ", error string",
    )
    want = told(op.patch(docs, changes))
    hit = {r.b for r in docs.where("fuente in ('s7', 's9')").select(bk.bucket_of(F.col("fuente"), 16).alias("b")).collect()}
    assert bk.patch_in_place(spark, path, SCHEMA, changes, 16) == len(hit)
    assert told(bk.read_buckets(spark, path, SCHEMA)) == want
    after = files(path)
    assert {f.split("/")[0] for f in before.items() ^ after.items() for f in [f[0]]} == {f"bucket={b}" for b in hit}
    assert bk.patch_in_place(spark, path, SCHEMA, changes.where("fuente = 'gone' or error is not null"), 16) == 0 and files(path) == after
    assert bk.patch_in_place(spark, f"{tmp_path}/none", SCHEMA, changes, 16) == 0


def test_append_new(spark, tmp_path):
    path = f"{tmp_path}/out"
    docs = spark.createDataFrame([(f"s{k}", "t", 1, "en", None) for k in range(20)], SCHEMA)
    assert bk.append_new(spark, path, docs.limit(12), 4).count() == 12
    first = files(path)
    added = bk.append_new(spark, path, docs, 4)
    assert added.count() == 8 and set(first.items()) <= set(files(path).items())
    assert sorted(r.fuente for r in bk.read_buckets(spark, path, SCHEMA).collect()) == sorted(f"s{k}" for k in range(20))
    assert bk.append_new(spark, path, docs, 4).count() == 0
