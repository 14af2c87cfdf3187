"""Queries on paths: order, formats, categories, tilesets, ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import corpus as op
from ..sources import adapters, files
from .registry import query, table

# Paths of several kinds from doc_id and source, the same in both languages.
_FOLDERS = ["Fenómeno 2", "F1_sur", "fenomeno_3", "FENÓMENO-1", "otros", "f2-norte", "mapas/Tiles/7", "mapas/tiles/x/TILES/10", "a-b", "a"]
_ENDINGS = [".txt", ".PDF", ".htm", ".json", ".Jpeg", ".xls", ".exe", ".pbf", ".md", ""]
S_PATHS = f"paths AS (SELECT doc_id, list_value({', '.join(repr(f) for f in _FOLDERS)})[CAST(doc_id % 10 AS INTEGER) + 1] || '/' || source || '/' || doc_id || list_value({', '.join(repr(e) for e in _ENDINGS)})[CAST((doc_id // 10) % 10 AS INTEGER) + 1] AS path FROM documents)"


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda of, k: F.element_at(F.array(*[F.lit(x) for x in of]), (k + 1).cast("int"))
    n = F.col("doc_id")
    path = F.concat(pick(_FOLDERS, n % 10), F.lit("/"), F.col("source"), F.lit("/"), n.cast("string"), pick(_ENDINGS, F.floor(n / 10) % 10))
    return table(spark, sf_dir, "documents").select("doc_id", path.alias("path"))


_S_EXT = r"lower(regexp_extract(path, '[^/](\.[^./]+)$', 1))"
_S_FORMAT = "CASE " + " ".join(f"WHEN {_S_EXT} = '{k}' THEN '{v}'" for k, v in adapters.FORMATS.items()) + " END"
_S_ROOT = r"CASE WHEN regexp_matches(path, '(?i)^(?:.*/)?tiles/.*$') THEN regexp_extract(path, '(?i)^(?:(.*)/)?tiles/.*$', 1) ELSE regexp_extract(path, '^(.*)/[^/]+$', 1) END"


@query("SELECT url AS path, row_number() OVER (ORDER BY string_split(url, '/'), page_id) AS n FROM pages")
def corpus_scan_order(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("path"), "page_id")
    return op.numbered(pages, op.path_order(F.col("path")), "page_id").select("path", "n")


@query(f"WITH {S_PATHS} SELECT path, {_S_FORMAT} AS formato FROM paths WHERE {_S_FORMAT} IS NOT NULL")
def format_dispatch(spark, sf_dir):
    return paths(spark, sf_dir).select("path", files.format_of(F.col("path")).alias("formato")).where("formato is not null")


@query(f"WITH {S_PATHS} SELECT path FROM paths WHERE {_S_EXT} IN ('.jpg', '.jpeg', '.png')")
def ext_filter(spark, sf_dir):
    wanted = ["." + x.strip().lower().lstrip(".") for x in (" JPG", ".jpeg", "png")]
    return paths(spark, sf_dir).select("path").where(files.extension(F.col("path")).isin(wanted))


@query(f"WITH {S_PATHS} SELECT path, CAST(list_filter(list_transform(string_split(path, '/'), lambda s: CASE WHEN regexp_extract(s, '(?i)fen[oó]meno[\\s_-]*([123])', 1) <> '' THEN regexp_extract(s, '(?i)fen[oó]meno[\\s_-]*([123])', 1) ELSE nullif(regexp_extract(s, '(?i)^f([123])[_\\s-]', 1), '') END), lambda x: x IS NOT NULL)[1] AS INTEGER) AS fenomeno FROM paths")
def category_from_path(spark, sf_dir):
    return paths(spark, sf_dir).select("path", tx.category_from_path(F.col("path")).alias("fenomeno"))


@query(f"WITH {S_PATHS} SELECT path, CAST(coalesce(nullif(regexp_extract(string_split(path, '/')[1], '^[Ff]([123])_', 1), ''), '0') AS INTEGER) AS fenomeno FROM paths")
def category_top_folder(spark, sf_dir):
    return paths(spark, sf_dir).select("path", tx.category_top_folder(F.col("path")).alias("fenomeno"))


@query(f"WITH {S_PATHS} SELECT path, CASE WHEN len(string_split(path, '/')) > 2 THEN string_split(path, '/')[2] ELSE string_split(path, '/')[1] END AS org FROM paths")
def source_org(spark, sf_dir):
    return paths(spark, sf_dir).select("path", tx.source_org(F.col("path")).alias("org"))


@query(f"WITH {S_PATHS}, g AS (SELECT CAST(coalesce(nullif(regexp_extract(string_split(path, '/')[1], '^[Ff]([123])_', 1), ''), '0') AS INTEGER) AS fenomeno, string_split(path, '/')[2] AS org FROM paths) SELECT fenomeno, org, count(*) AS n FROM g GROUP BY ALL")
def category_source_grid(spark, sf_dir):
    grid = paths(spark, sf_dir).select(tx.category_top_folder(F.col("path")).alias("fenomeno"), tx.source_org(F.col("path")).alias("org"))
    return grid.groupBy("fenomeno", "org").agg(F.count("*").alias("n"))


@query(f"WITH {S_PATHS} SELECT path, CASE WHEN {_S_ROOT} = '' THEN '.' ELSE {_S_ROOT} END AS root FROM paths")
def tileset_root(spark, sf_dir):
    return paths(spark, sf_dir).select("path", tx.tileset_root(F.col("path")).alias("root"))


@query(f"WITH {S_PATHS} SELECT {_S_ROOT} AS root, count(*) AS n, min(path) AS first_path, max(path) AS last_path FROM paths WHERE {_S_EXT} = '.pbf' GROUP BY 1")
def tileset_group(spark, sf_dir):
    tiles = paths(spark, sf_dir).where(files.extension(F.col("path")) == ".pbf").select(tx.tileset_root(F.col("path")).alias("root"), "path")
    return tiles.groupBy("root").agg(F.count("*").alias("n"), F.min("path").alias("first_path"), F.max("path").alias("last_path"))


@query(f"WITH {S_PATHS} SELECT path FROM paths WHERE {_S_EXT} <> '.pbf'")
def tileset_exclude(spark, sf_dir):
    every = paths(spark, sf_dir).select("path")
    members = every.where(files.extension(F.col("path")) == ".pbf")
    return every.join(members, "path", "left_anti")


@query(f"WITH {S_PATHS} SELECT path FROM paths WHERE NOT list_contains(['1.txt', '11.PDF', '25.htm'], string_split(path, '/')[-1])")
def catalog_exclude(spark, sf_dir):
    return paths(spark, sf_dir).select("path").where(~F.element_at(F.split("path", "/"), -1).isin("1.txt", "11.PDF", "25.htm"))


@query(
    f"""
WITH {S_PATHS}, known AS (SELECT path AS fuente, printf('DOC-%04d', doc_id * 2 + 1) AS doc_id FROM paths WHERE doc_id % 7 = 0),
new AS (SELECT path AS fuente, {_S_EXT} = '.pbf' AS t FROM paths WHERE doc_id % 7 <> 0),
last AS (SELECT max(CAST(string_split(doc_id, '-')[2] AS BIGINT)) AS m FROM known)
SELECT fuente, doc_id FROM known UNION ALL
SELECT fuente, printf('DOC-%04d', m + row_number() OVER (ORDER BY NOT t, string_split(fuente, '/'))) FROM new, last
"""
)
def registry_assign(spark, sf_dir):
    p = paths(spark, sf_dir)
    registry = p.where("doc_id % 7 = 0").select(F.col("path").alias("fuente"), op.doc_name(F.col("doc_id") * 2 + 1).alias("doc_id"))
    return op.assign_ids(p.select(F.col("path").alias("fuente"), (files.extension(F.col("path")) == ".pbf").alias("is_tileset")), registry)


@query(f"WITH {S_PATHS} SELECT path, printf('DOC-%04d', row_number() OVER (ORDER BY string_split(path, '/')) - 1) AS doc_id FROM paths WHERE {_S_EXT} = '.json'")
def sample_numbering(spark, sf_dir):
    kept = paths(spark, sf_dir).where(files.extension(F.col("path")) == ".json").select("path")
    return op.numbered(kept, op.path_order(F.col("path")), first=0).select("path", op.doc_name(F.col("n")).alias("doc_id"))


@query(f"WITH {S_PATHS} SELECT DISTINCT path AS fuente FROM paths")
def list_normalize(spark, sf_dir):
    quoted = F.concat(F.lit('  "'), F.replace("path", F.lit("/"), F.lit("\\\\")), F.lit('"\t'))
    doubled = paths(spark, sf_dir).select(quoted.alias("line"))
    lines = doubled.unionByName(doubled).unionByName(doubled.limit(1).select(F.lit(" ").alias("line")))
    return lines.select(tx.slashes(tx.normalise_listed(F.col("line"))).alias("fuente")).where("fuente <> ''").distinct()


@query(f"WITH {S_PATHS} SELECT path FROM paths WHERE {_S_EXT} = '.txt' UNION ALL SELECT path FROM paths WHERE {_S_EXT} = '.md'")
def union_formats(spark, sf_dir):
    p = paths(spark, sf_dir).select("path")
    return p.where(files.extension(F.col("path")) == ".txt").unionByName(p.where(files.extension(F.col("path")) == ".md"))


@query(f"WITH {S_PATHS} SELECT path || '.gone' AS path FROM paths WHERE doc_id % 5 = 0")
def missing_listed(spark, sf_dir):
    p = paths(spark, sf_dir)
    listed = p.select("path").unionByName(p.where("doc_id % 5 = 0").select(F.concat("path", F.lit(".gone")).alias("path")))
    return listed.join(p.select("path"), "path", "left_anti").distinct()


@query("SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN ['es', 'en'] WHEN 1 THEN ['fra'] WHEN 2 THEN ['es'] ELSE ['xx', 'es'] END AS langs FROM nation")
def ocr_lang_map(spark, sf_dir):
    case = F.col("n_nationkey") % 4
    codes = F.when(case == 0, "spa+eng").when(case == 1, " fra ").when(case == 2, " + ").otherwise("xx+spa")
    return table(spark, sf_dir, "nation").select("n_nationkey", tx.ocr_languages(codes).alias("langs"))


@query("SELECT l_orderkey AS k, array_to_string(list_transform(list_sort(list_distinct(list(CAST(l_linenumber * 7 % 11 AS INTEGER)))), lambda x: CAST(x AS VARCHAR)), ',') AS zooms FROM lineitem GROUP BY l_orderkey")
def zoom_sort(spark, sf_dir):
    zoom = (F.col("l_linenumber") * 7 % 11).cast("string")
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.array_join(files.zoom_order(F.collect_set(zoom)), ",").alias("zooms"))
