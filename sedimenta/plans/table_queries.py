"""Queries on tables: resuming, patching, features, rows of files, OCR words, layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import buckets as bk
from ..operators import corpus as op
from ..plans.durable import shared_dir
from ..sources import files, sinks
from .registry import query, table
from .text_queries import _VARIANTS, _variants, s_strip


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti_join(spark, sf_dir):
    return op.resume(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


_PATCHED = """
SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL AND l.toxic = 0 THEN 'patched ' || l.quality ELSE d.text END AS texto,
  CASE WHEN l.doc_id IS NOT NULL AND l.toxic = 0 THEN 9 ELSE d.n_chars END AS num_caracteres, CASE WHEN l.doc_id IS NOT NULL AND l.toxic = 0 THEN 'und' ELSE d.lang END AS idioma,
  CASE WHEN l.doc_id IS NOT NULL AND l.toxic = 0 THEN 'ocr=true,src=new' ELSE 'pages=1,src=old' END AS note, CASE WHEN l.doc_id IS NOT NULL AND l.toxic = 0 THEN 3 ELSE 2 END AS n_meta
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def _patch_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("fuente"),
        F.col("text").alias("texto"),
        F.col("n_chars").alias("num_caracteres"),
        F.col("lang").alias("idioma"),
        F.create_map(F.lit("pages"), F.lit("1"), F.lit("src"), F.lit("old")).alias("meta_extra")
    )
    changes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("fuente"),
        F.concat(F.lit("patched "), F.col("quality").cast("string")).alias("texto"),
        F.lit(9).cast("long").alias("num_caracteres"),
        F.lit("und").alias("idioma"),
        F.create_map(F.lit("ocr"), F.lit("true"), F.lit("src"), F.lit("new")).alias("meta_extra"),
        F.when(F.col("toxic") == 1, "broken").alias("error"),
    )
    return docs, changes


def _patch_rows(out: DataFrame) -> DataFrame:
    m = F.col("meta_extra")
    note = F.when(F.map_contains_key(m, "ocr"), F.concat(F.lit("ocr="), m["ocr"])).otherwise(F.concat(F.lit("pages="), m["pages"]))
    return out.select(
        F.col("fuente").alias("doc_id"),
        "texto",
        "num_caracteres",
        "idioma",
        F.concat(note, F.lit(",src="), m["src"]).alias("note"),
        F.size(m).alias("n_meta")
    )


@query(_PATCHED)
def ocr_patch(spark, sf_dir):
    """Rows with a change take its text and metadata; changes with an error leave them alone."""
    return _patch_rows(op.patch(*_patch_tables(spark, sf_dir)))


@query(_PATCHED)
def ocr_patch_in_place(spark, sf_dir):
    """The same on a table in buckets, of which only those with a change are written again."""
    where = shared_dir(spark)
    docs, changes = _patch_tables(spark, sf_dir)
    bk.append_new(spark, where, docs.where("fuente % 2 = 0"), 8)
    bk.append_new(spark, where, docs, 8)
    bk.patch_in_place(spark, where, docs.schema, changes, 8)
    return _patch_rows(bk.read_buckets(spark, where, docs.schema))


_FEATURES = """f AS (SELECT p_partkey, p_brand AS layer, CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 4 = 1 THEN '0' ELSE CAST(p_partkey % 50 AS VARCHAR) END AS fid, p_size AS size,
  'z' || (p_partkey % 3) || '/' || p_partkey AS path FROM part)"""


def _features(spark, sf_dir):
    n = F.col("p_partkey")
    fid = F.when(n % 4 == 0, F.lit(None)).when(n % 4 == 1, "0").otherwise((n % 50).cast("string"))
    attrs = F.create_map(F.lit("fid"), fid, F.lit("size"), F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select(
        F.lit("r").alias("root"),
        F.concat(F.lit("z"), (n % 3).cast("string"), F.lit("/"), n.cast("string")).alias("path"),
        n.cast("int").alias("ordinal"),
        F.col("p_brand").alias("layer"),
        attrs.alias("attrs")
    )


@query(f"WITH {_FEATURES}, k AS (SELECT *, row_number() OVER (PARTITION BY layer, CASE WHEN fid IS NULL OR fid = '0' THEN 'x' || coalesce(fid, 'null') || '/' || size ELSE fid END ORDER BY string_split(path, '/'), p_partkey) AS r FROM f) SELECT layer, path FROM k WHERE r = 1")
def feature_dedupe(spark, sf_dir):
    return op.dedupe_features(_features(spark, sf_dir)).select("layer", "path")


@query(f"WITH {_FEATURES} SELECT layer, count(*) AS n, count(DISTINCT string_split(path, '/')[1]) AS n_zooms FROM f GROUP BY layer")
def layer_counts(spark, sf_dir):
    rows = _features(spark, sf_dir)
    return rows.groupBy("layer").agg(F.count("*").alias("n"), F.count_distinct(F.split("path", "/")[0]).alias("n_zooms"))


_WORDS = "w AS (SELECT o_custkey AS doc_id, o_orderkey AS ordinal, CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE o_orderpriority END AS word, CASE o_orderkey % 4 WHEN 0 THEN '-1' WHEN 1 THEN '95.3' ELSE CAST(o_orderkey % 90 AS VARCHAR) END AS conf FROM orders)"


@query(f"WITH {_WORDS} SELECT doc_id, string_agg(word, ' ' ORDER BY ordinal) AS text, coalesce(round_even(avg(CASE WHEN conf <> '-1' AND conf NOT LIKE '%.%' THEN CAST(conf AS DOUBLE) END), 1), 0.0) AS confidence FROM w WHERE trim(word) <> '' GROUP BY doc_id")
def ocr_confidence(spark, sf_dir):
    n = F.col("o_orderkey")
    word = F.when(n % 5 == 0, " ").otherwise(F.col("o_orderpriority"))
    conf = F.when(n % 4 == 0, "-1").when(n % 4 == 1, "95.3").otherwise((n % 90).cast("string"))
    return op.ocr_words(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), n.alias("ordinal"), word.alias("word"), conf.alias("conf")))


@query(
    """
WITH b AS (SELECT l_orderkey AS doc_id, l_linenumber % 2 AS page, l_linenumber AS ordinal, l_quantity % 7 + 0.04 AS y, CAST(l_partkey % 9 AS DOUBLE) + 0.03 AS x, CASE WHEN l_linenumber % 6 = 0 THEN '  ' ELSE ' ' || l_partkey || ' ' END AS t FROM lineitem),
p AS (SELECT doc_id, page, coalesce(string_agg(trim(t), chr(10) ORDER BY round(y, 1), round(x, 1), ordinal, trim(t)) FILTER (WHERE trim(t) <> ''), '') AS t FROM b GROUP BY ALL)
SELECT doc_id, string_agg(t, chr(10) || chr(10) ORDER BY page) AS text FROM p GROUP BY doc_id
"""
)
def layout_reading_order(spark, sf_dir):
    text = F.when(F.col("l_linenumber") % 6 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" ")))
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        (F.col("l_linenumber") % 2).alias("page"),
        F.col("l_linenumber").alias("ordinal"),
        (F.col("l_quantity") % 7 + 0.04).alias("y0"),
        ((F.col("l_partkey") % 9).cast("double") + 0.03).alias("x0"),
        text.alias("text")
    )
    return op.reading_order(rows)


def _csv_files(spark, sf_dir):
    """One CSV file for each nation's suppliers, with an empty cell, short ones, a long and an empty line."""
    line = F.concat_ws(
        ",",
        F.col("s_suppkey").cast("string"),
        F.concat(F.lit('"'), F.col("s_name"), F.lit(', SA"')),
        F.when(F.col("s_suppkey") % 3 == 0, "nan").otherwise(""),
        F.lit("x")
    )
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", line.alias("l")))), lambda s: s["l"]), "\n")
    text = F.concat(F.lit("key,name,gap,flag\n"), body, F.lit("\nshort,row\n\na,b,c,d,e\n"), F.repeat(F.lit("x,y\n"), (F.col("s_nationkey") % 4).cast("int")))
    return table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(text.alias("t")).select(
        F.concat(F.lit("n/"), F.col("s_nationkey").cast("string"), F.lit(".csv")).alias("fuente"),
        F.lit("csv").alias("formato"),
        F.encode("t", "UTF-8").alias("content")
    )


@query("SELECT 'n/' || s_nationkey || '.csv' AS fuente, string_agg('key: ' || s_suppkey || ' | name: ' || s_name || ', SA | flag: x', chr(10) ORDER BY s_suppkey) AS texto FROM supplier GROUP BY s_nationkey")
def csv_row_text(spark, sf_dir):
    return files.extract(_csv_files(spark, sf_dir)).select("fuente", "texto")


@query("SELECT 'n/' || s_nationkey || '.csv' AS fuente, count(*) AS num_filas_validas, CAST(2 + s_nationkey % 4 AS BIGINT) AS omitidas FROM supplier GROUP BY s_nationkey")
def csv_malformed_counts(spark, sf_dir):
    meta = files.extract(_csv_files(spark, sf_dir))
    return meta.select(
        "fuente",
        F.col("meta")["num_filas_validas"].cast("long").alias("num_filas_validas"),
        F.col("meta")["filas_omitidas_por_formato_invalido"].cast("long").alias("omitidas")
    )


@query("SELECT doc_id, text AS texto, CASE WHEN doc_id % 2 = 0 THEN NULL ELSE lang END AS idioma FROM documents")
def jsonl_roundtrip(spark, sf_dir):
    """JSON Lines written with their nulls, and read again."""
    where = f"{shared_dir(spark)}/out.jsonl"
    sinks.write_jsonl(
        table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("texto"), F.when(F.col("doc_id") % 2 != 0, F.col("lang")).alias("idioma")),
        where
    )
    return files.load_records(spark, where).select("doc_id", "texto", "idioma")


@query(
    f"""
WITH {_VARIANTS}, n AS (SELECT doc_id + variant * 1000000 AS fuente, doc_id, text FROM v),
listed AS (SELECT fuente FROM n UNION SELECT fuente + 2000000 FROM n)
SELECT l.fuente, CASE WHEN n.fuente IS NULL THEN 'missing' WHEN b.toxic = 1 THEN 'error' WHEN length({s_strip("n.text")}) >= 50 THEN 'ok' ELSE 'still_empty' END AS outcome
FROM listed l LEFT JOIN n ON l.fuente = n.fuente LEFT JOIN labels b ON n.doc_id = b.doc_id
"""
)
def patch_log(spark, sf_dir):
    """What became of each listed source when its text was read again: whole texts, short ones, and sources without any."""
    docs = _variants(spark, sf_dir).select((F.col("doc_id") + F.col("variant") * 1000000).alias("fuente"), "doc_id", "text")
    toxic = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    changes = docs.join(toxic, "doc_id", "left").select("fuente", F.col("text").alias("texto"), F.when(F.col("toxic") == 1, "broken").alias("error"))
    ids = docs.select("fuente")
    return op.patch_outcomes(ids.unionByName(ids.select((F.col("fuente") + 2000000).alias("fuente"))), changes)
