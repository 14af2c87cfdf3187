"""Relational operators of the corpus pipeline: ids, chunks, duplicates, patches, census, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import words
from ..plans.durable import materialize


def path_order(path: Column) -> Column:
    """Paths sort by their parts, so that 'a/x' comes before 'a-b/x'."""
    return F.split(path, "/")


def numbered(df: DataFrame, *order: Column | str, first: int = 1, to: str = "n") -> DataFrame:
    """df with consecutive numbers in the given order, without passing all rows through one task.

    Rows are dealt into ranges, written, counted by range and numbered from the sums of the ranges before.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = df.columns
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    named = df.withColumns({f"_o{k}": c for k, c in enumerate(keys)})
    names = [f"_o{k}" for k in range(len(keys))]
    ranged = materialize(named.repartitionByRange(parts, *names).withColumn("_range", F.spark_partition_id()))
    offsets, before = [], first
    for r in sorted(ranged.groupBy("_range").count().collect()):  # a row a range
        offsets.append((r["_range"], before))
        before += r["count"]
    starts = df.sparkSession.createDataFrame(offsets, "_range int, _before long")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*names)) - 1
    return ranged.withColumn("_within", within).join(F.broadcast(starts), "_range").select(*kept, (F.col("_within") + F.col("_before")).alias(to))


def doc_name(n: Column) -> Column:
    return F.format_string("DOC-%04d", n)


def assign_ids(sources: DataFrame, registry: DataFrame) -> DataFrame:
    """(fuente, doc_id) of all sources: registered ids stay, new ones continue after the largest, tilesets first, then by path.

    sources: (fuente, is_tileset), registry: (fuente, doc_id). Only new sources are sorted.
    """
    known = sources.select("fuente", "is_tileset").distinct().join(registry, "fuente", "left")
    last = registry.agg(F.coalesce(F.max(F.split("doc_id", "-").getItem(1).cast("long")), F.lit(0)).alias("m")).first()["m"]
    new = numbered(known.where("doc_id is null").drop("doc_id"), (~F.col("is_tileset")).alias("t"), path_order(F.col("fuente")), first=last + 1)
    return known.where("doc_id is not null").select("fuente", "doc_id").unionByName(new.select("fuente", doc_name(F.col("n")).alias("doc_id")))


def register(assigned: DataFrame, registry: DataFrame) -> DataFrame:
    """The registry with the new ids."""
    return registry.unionByName(assigned.join(registry, "fuente", "left_anti").select("fuente", "doc_id"))


def chunk_words(df: DataFrame, text: str = "text", size: int = 200, overlap: int = 20) -> DataFrame:
    """df without its text, and (chunk_ix, chunk): windows of `size` words, each `overlap` words over the one before."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than the size")
    step = size - overlap
    split = words(F.col(text))
    starts = F.when(F.size("_w") > 0, F.sequence(F.lit(0), F.size("_w") - 1, F.lit(step)))
    rest = [c for c in df.columns if c != text]
    exploded = df.select(*rest, split.alias("_w")).select(*rest, "_w", F.posexplode(starts).alias("chunk_ix", "_s"))
    return exploded.select(*rest, "chunk_ix", F.array_join(F.slice("_w", F.col("_s") + 1, size), " ").alias("chunk"))


def resume(sources: DataFrame, done: DataFrame, key: str = "fuente") -> DataFrame:
    """Sources that are not in the output yet. Apply it before anything expensive: Spark doesn't move it below Python."""
    return sources.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def first_of_each(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key; pre-aggregated before the shuffle, so a frequent key is no burden."""
    rank = F.struct(*order)
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.min_by(row, rank).alias("_r")).select("_r.*")


def dedupe_features(features: DataFrame) -> DataFrame:
    """One feature for each layer and identity in a root: fid, id or FID if set and neither 0 nor empty, else all attributes.

    features: (root, path, ordinal, layer, attrs map<string,string>); the first by path, then ordinal, stays. A column
    `key`, where there is one, is the identity.
    """
    if "key" in features.columns:
        return first_of_each(features, ["root", "layer", "key"], [path_order(F.col("path")), F.col("ordinal")])

    def given(name: str) -> Column:
        v = F.try_element_at("attrs", F.lit(name))
        return F.when(~v.isin("", "0", "0.0", "false", "False"), v)

    everything = F.to_json(F.array_sort(F.map_entries("attrs")))
    keyed = features.withColumn("_key", F.coalesce(given("fid"), given("id"), given("FID"), everything))
    return first_of_each(keyed, ["root", "layer", "_key"], [path_order(F.col("path")), F.col("ordinal")]).drop("_key")


def one_change(changes: DataFrame, key: str = "fuente") -> DataFrame:
    """One change for each source: of several one without error, then the one whose fields, as JSON, sort first."""
    fields = F.to_json(F.struct(*[c for c in changes.columns if c != key]), {"ignoreNullFields": "false"})
    return first_of_each(changes, [key], [F.col("error").isNotNull(), fields])


def patch(documents: DataFrame, changes: DataFrame, key: str = "fuente") -> DataFrame:
    """Documents with the text, length, language and metadata of their change, if it has one without error; metadata keys of
    the change win. Of several changes for a source one_change() takes one, so no document is repeated."""
    c = one_change(changes.where("error is null"), key).select(
        key,
        *[F.col(x).alias(f"_{x}") for x in ("texto", "num_caracteres", "idioma", "meta_extra")],
        F.lit(True).alias("_hit")
    )
    joined = documents.join(c, key, "left")
    old = F.coalesce("meta_extra", F.create_map().cast("map<string,string>"))
    new = F.coalesce("_meta_extra", F.create_map().cast("map<string,string>"))
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(new), k)), new)
    pick = lambda x: F.when(F.col("_hit"), F.col(f"_{x}")).otherwise(F.col(x)).alias(x)
    out = {x: pick(x) for x in ("texto", "num_caracteres", "idioma")} | {"meta_extra": F.when(F.col("_hit"), merged).otherwise(F.col("meta_extra")).alias("meta_extra")}
    return joined.select(*[out.get(x, F.col(x)) for x in documents.columns])


def summary(documents: DataFrame) -> DataFrame:
    """(formato, n, empty): documents and empty ones of each format."""
    return documents.groupBy("formato").agg(F.count("*").alias("n"), F.count_if(F.col("texto_limpio") == "").alias("empty"))


def _each(traces: DataFrame, name: str) -> DataFrame:
    """(p): the elements of an array. An inner explode would first be given a filter on the array's size, and so harvest every text twice."""
    return traces.select(F.explode_outer(name).alias("p")).where("p is not null")


def census_paths(traces: DataFrame, top: int = 25) -> DataFrame:
    """(path, n): the most frequent text paths, indexes left out. Ties: by path."""
    paths = _each(traces, "claves_texto").select(F.regexp_replace("p", r"\[\d+\]", "[]").alias("path"))
    return paths.groupBy("path").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "path").limit(top)


def census_meta(traces: DataFrame, top: int = 30) -> DataFrame:
    """(name, n): the most frequent last parts of metadata paths. Ties: by name."""
    names = _each(traces, "claves_meta").select(F.element_at(F.split("p", r"\."), -1).alias("name"))
    return names.groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(top)


def census_tiers(traces: DataFrame) -> DataFrame:
    """(tier, n, n_ndjson): a histogram of extraction tiers."""
    return traces.groupBy("tier").agg(F.count("*").alias("n"), F.count_if(F.col("carga") == "ndjson").alias("n_ndjson"))


def reading_order(blocks: DataFrame, threshold: int = 0) -> DataFrame:
    """(doc_id, text): blocks of each page by rounded top, then left edge, joined by line feeds; pages by empty lines.

    blocks: (doc_id, page, ordinal, x0, y0, text). Blank blocks are left out; a document's blocks fit in a row.
    """
    from ..functions.text import strip

    rows = blocks.select("doc_id", "page", F.struct(F.round("y0", 1).alias("y"), F.round("x0", 1).alias("x"), "ordinal", strip(F.col("text")).alias("t")).alias("b"))
    pages = rows.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list("b")).alias("b"))
    joined = pages.select("doc_id", F.struct("page", F.array_join(F.filter(F.transform("b", lambda b: b["t"]), lambda t: t != ""), "\n").alias("t")).alias("p"))
    return joined.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["t"]), "\n\n").alias("text"))


def ocr_words(words_table: DataFrame) -> DataFrame:
    """(doc_id, text, confidence): words that are not blank, and the mean of their whole, non-negative confidences, 0.0 without any.

    words_table: (doc_id, ordinal, word, conf). A confidence with a decimal point is not counted.
    """
    from ..functions.text import strip

    rows = words_table.where(strip(F.col("word")) != "")
    counted = F.when(F.col("conf").rlike(r"^-*\d+$"), F.col("conf").try_cast("int"))
    agg = rows.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("ordinal", "word"))).alias("w"),
        F.coalesce(F.bround(F.avg(F.when(counted >= 0, counted)), 1), F.lit(0.0)).alias("confidence"),
    )
    return agg.select("doc_id", F.array_join(F.transform("w", lambda w: w["word"]), " ").alias("text"), "confidence")


def ocr_choice(text: Column, ocr: Column, least: int = 50) -> Column:
    """OCR's text where the extracted one is too short and OCR gives more, white space around both apart."""
    from ..functions.text import strip

    own = F.length(strip(text))
    return F.when((own < least) & (F.length(strip(ocr)) > own), ocr).otherwise(text)


def patch_outcomes(listed: DataFrame, changes: DataFrame, least: int = 50) -> DataFrame:
    """(fuente, outcome) of each listed source: ok, still_empty (under `least` characters), error, or missing.

    listed: (fuente), changes: (fuente, texto, error).
    """
    from ..functions.text import strip

    tried = one_change(changes.select("fuente", "texto", "error")).withColumn("_hit", F.lit(True))
    rows = listed.select("fuente").distinct().join(tried, "fuente", "left")
    outcome = F.when(F.col("_hit").isNull(), "missing").when(F.col("error").isNotNull(), "error").when(
        F.length(strip(F.coalesce("texto", F.lit("")))) >= least,
        "ok"
    ).otherwise("still_empty")
    return rows.select("fuente", outcome.alias("outcome"))
