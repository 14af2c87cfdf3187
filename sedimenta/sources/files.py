"""File sources: the corpus folder, extraction by format, JSON Lines, lists and earlier outputs."""

from __future__ import annotations

import json
import traceback
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalise_listed, tileset_root
from ..operators.corpus import dedupe_features, path_order
from .adapters import ADAPTERS, FORMATS, Options, pdf_pages, tile_features

EXTRACTED = "fuente string, formato string, texto string, meta map<string,string>, error string, traceback string"
_TEXT = pa.string()
_EXTRACTED = pa.schema([(c.split()[0], pa.map_(_TEXT, _TEXT) if "map" in c else _TEXT) for c in EXTRACTED.split(", ")])
#: Extracted files, and the characters of their texts, that leave a task at once.
EXTRACT_ROWS, EXTRACT_CHARS = 1024, 1 << 20
BLOCK = "doc_id string, page int, ordinal int, x0 double, y0 double, text string, error string"
BLOCK_NAMES = [c.split()[0] for c in BLOCK.split(", ")]
#: Blocks of PDF text, and their characters, that leave a task at once.
BLOCK_ROWS, BLOCK_CHARS = 1024, 4 << 20
FEATURE = "root string, path string, ordinal int, layer string, key string, attrs map<string,string>, text string"


def extension(path: Column) -> Column:
    """The ending with its point, in lower case; '' without one. A point at the start of a name is no ending."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def format_of(path: Column, formats: dict[str, str] = FORMATS) -> Column:
    """The format's label; null for others."""
    table = F.create_map(*[F.lit(x) for pair in formats.items() for x in pair])
    return F.try_element_at(table, extension(path))


def relative_path(spark: SparkSession, root: str) -> Column:
    """The column `path` of Spark's binary files, relative to root."""
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base).toString().rstrip("/") + "/"
    plain = base.split(":", 1)[-1].lstrip("/")
    return F.substring(F.regexp_replace(F.col("path"), "^[a-z0-9]+:/*", ""), F.lit(len(plain) + 1), F.length("path"))


def listing(spark: SparkSession, root: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """(fuente, length, content): all files below root, by path relative to it. Spark reads no content that isn't selected."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select(relative_path(spark, root).alias("fuente"), "length", "content")


def extracted(batches: Iterator[pa.RecordBatch], options: Options) -> Iterator[pa.RecordBatch]:
    """EXTRACTED of batches of (fuente, formato, content), a file at a time. Rows leave by EXTRACT_ROWS, or by EXTRACT_CHARS of text:
    no more than these and one file are held beside the batch that Spark has sent."""

    def frame(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _EXTRACTED, strict=True)], schema=_EXTRACTED)

    rows, held = [], 0
    for batch in batches:
        for file in zip(*(batch.column(c) for c in ("fuente", "formato", "content")), strict=True):
            fuente, formato, content = (x.as_py() for x in file)
            text, meta, error, trace = "", {}, None, None
            try:
                text, meta = ADAPTERS[formato](fuente, bytes(content), options)
            except Exception as why:
                error, trace = f"{type(why).__name__}: {why}", traceback.format_exc()
            told = [(k, v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)) for k, v in meta.items()]
            rows.append((fuente, formato, text, told, error, trace))
            held += len(text)
            if len(rows) >= EXTRACT_ROWS or held >= EXTRACT_CHARS:
                yield frame(rows)
                rows, held = [], 0
    if rows:
        yield frame(rows)


def extract(files: DataFrame, options: Options | None = None) -> DataFrame:
    """EXTRACTED of (fuente, formato, content). A file that can't be read has an empty text and says why."""
    options = options or Options()
    return files.select("fuente", "formato", "content").mapInArrow(lambda batches: extracted(batches, options), EXTRACTED)


def pdf_blocks(files: DataFrame, options: Options | None = None) -> DataFrame:
    """(doc_id, page, ordinal, x0, y0, text, error) of (fuente, content): a row for each block of text, pages from 1; doc_id is the source.

    A file that can't be read has one row with its error, a page without text one without text. Rows leave by BLOCK_ROWS, or by
    BLOCK_CHARS of text, whatever files and pages they come from: a frame for each page takes longer than reading it.
    """
    options = options or Options()

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=BLOCK_NAMES).astype({"page": "Int32", "ordinal": "Int32"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        for pdf in batches:
            for fuente, content in zip(pdf["fuente"], pdf["content"], strict=True):
                try:
                    pages = pdf_pages(bytes(content), options)
                except Exception as why:
                    rows.append((fuente, None, None, None, None, None, f"{type(why).__name__}: {why}"))
                    continue
                for number, found in enumerate(pages, 1):
                    rows += [(fuente, number, k, x, y, text, None) for k, (x, y, text) in enumerate(found or [(0.0, 0.0, "")])]
                    held += sum(len(b[2]) for b in found or ())
                    if len(rows) >= BLOCK_ROWS or held >= BLOCK_CHARS:
                        yield frame(rows)
                        rows, held = [], 0
        if rows:
            yield frame(rows)

    return files.select("fuente", "content").mapInPandas(run, BLOCK)


def identity(attrs: dict) -> str:
    """What makes two features of a layer the same: the first of fid, id and FID that is set and neither zero, false nor empty, else all attributes."""
    given = next((v for name in ("fid", "id", "FID") if (v := attrs.get(name))), None)
    if given is None:
        return json.dumps(sorted(attrs.items()), ensure_ascii=False)
    return f"n{float(given)!r}" if isinstance(given, (int, float)) and float(given) == given else f"s{given}"


def features(tiles: DataFrame) -> DataFrame:
    """FEATURE of (fuente, content): all features of all tiles; a tile that can't be decoded is passed over."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for root, path, content in zip(pdf["root"], pdf["fuente"], pdf["content"], strict=True):
                try:
                    found = tile_features(bytes(content))
                except Exception:
                    continue
                for k, (layer, attrs) in enumerate(found):
                    pairs = [f"{a}: {v}" for a, v in attrs.items() if v is not None and str(v).strip()]
                    rows.append((
                        root,
                        path,
                        k,
                        layer,
                        identity(attrs),
                        {a: None if v is None else str(v) for a, v in attrs.items()},
                        " | ".join([f"capa: {layer}", *pairs])
                    ))
            yield pd.DataFrame(rows, columns=["root", "path", "ordinal", "layer", "key", "attrs", "text"])

    return tiles.select(tileset_root(F.col("fuente")).alias("root"), "fuente", "content").mapInPandas(run, FEATURE)


def tilesets(tiles: DataFrame) -> DataFrame:
    """(fuente, formato, texto): one document for each tileset, a line for each distinct feature in order of first sight."""
    first = dedupe_features(features(tiles))
    lines = first.groupBy("root").agg(F.array_sort(F.collect_list(F.struct(path_order(F.col("path")).alias("p"), "ordinal", "text"))).alias("l"))
    told = lines.select("root", F.array_join(F.transform("l", lambda x: x["text"]), "\n").alias("texto"))
    roots = tiles.select(tileset_root(F.col("fuente")).alias("root")).distinct()
    return roots.join(told, "root", "left").select(F.col("root").alias("fuente"), F.lit("pbf").alias("formato"), F.coalesce("texto", F.lit("")).alias("texto"))


def tileset_meta(tiles: DataFrame) -> DataFrame:
    """(root, num_archivos_pbf, niveles_zoom, capas, num_elementos_unicos): figures of each tileset, zoom levels as numbers where they are."""
    found = features(tiles)
    unique = dedupe_features(found).groupBy("root").agg(F.count("*").alias("num_elementos_unicos"))
    layers = found.groupBy("root", "layer").count().groupBy("root").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("layer", "count")))).alias("capas"))
    own = tiles.select(tileset_root(F.col("fuente")).alias("root"), F.regexp_extract("fuente", r"(?i)(?:^|/)tiles/([^/]+)/", 1).alias("z"))
    files = own.groupBy("root").agg(F.count("*").alias("num_archivos_pbf"), zoom_order(F.collect_set(F.nullif(F.col("z"), F.lit("")))).alias("niveles_zoom"))
    return files.join(layers, "root", "left").join(unique, "root", "left")


def zoom_order(levels: Column) -> Column:
    """Zoom levels in the order of their numbers; others behind, by text."""
    keyed = F.transform(levels, lambda z: F.struct(F.coalesce(z.try_cast("int"), F.lit(2147483647)).alias("n"), z.alias("z")))
    return F.transform(F.array_sort(keyed), lambda x: x["z"])


def load_records(spark: SparkSession, path: str, text_fields: tuple[str, ...] = ("texto", "texto_limpio")) -> DataFrame:
    """Records of a .jsonl file (blank lines skipped) or a JSON array, with `texto` from the first field that is there."""
    rows = spark.read.option("multiLine", str(not path.endswith(".jsonl")).lower()).json(path)
    return rows.withColumn("texto", F.coalesce(*[F.col(c) for c in text_fields if c in rows.columns]))


def load_list(spark: SparkSession, path: str) -> DataFrame:
    """(fuente): distinct lines of a list, without quotes and doubled backslashes."""
    return spark.read.text(path).select(normalise_listed(F.col("value")).alias("fuente")).where("fuente <> ''").distinct()


def load_processed(spark: SparkSession, path: str) -> DataFrame:
    """(fuente): sources in an earlier output; blank and broken lines and rows without it are ignored."""
    schema = T.StructType([T.StructField("fuente", T.StringType())])
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where("fuente is not null").distinct()
