"""JSON files to texts and provenance traces, one row a file, failures included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json_harvest import harvest_json
from ..functions.text import category_top_folder, source_org, word_count
from ..sources.files import listing
from .corpus import doc_name, numbered, path_order

TRACE = ("archivo", "tier", "carga", "claves_texto", "claves_meta", "claves_raiz", "advertencias", "n_palabras", "n_meta", "error")


def harvested(spark: SparkSession, root: str, glob: str = "*.json") -> DataFrame:
    """(archivo, texto, meta) and the trace of every JSON file below root. Tier 0: unreadable, 3: too little text."""
    rows = listing(spark, root, glob).select(F.col("fuente").alias("archivo"), harvest_json("content").alias("h"))
    return rows.select("archivo", "h.*").withColumn("n_meta", F.size("meta"))


def traces(rows: DataFrame) -> DataFrame:
    return rows.select(*TRACE)


def handoff(rows: DataFrame, catalogs: tuple[str, ...] = ()) -> DataFrame:
    """Texts for chunking: numbered from DOC-0000 by path, with category (0 if unknown), organisation and words. Catalog files stay out.

    rows: (archivo, tier, texto), written ones. Rows that are still to be harvested would be harvested four times: by the filter and
    for the text, and both again when numbering draws its ranges.
    """
    name = F.element_at(F.split("archivo", "/"), -1)
    kept = rows.where((F.col("tier").between(1, 2)) & ~name.isin(*catalogs) if catalogs else F.col("tier").between(1, 2))
    n = numbered(kept.select("archivo", "texto"), path_order(F.col("archivo")), first=0)
    return n.select(
        doc_name(F.col("n")).alias("doc_id"),
        F.col("archivo").alias("fuente"),
        F.lit("json").alias("formato"),
        category_top_folder(F.col("archivo")).alias("fenomeno"),
        source_org(F.col("archivo")).alias("org"),
        word_count(F.col("texto")).alias("n_palabras"),
        "texto"
    )
