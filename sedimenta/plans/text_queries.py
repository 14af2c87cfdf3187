"""Queries on texts: cleaning, counting, languages, pages, rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import text_udf as tu
from ..functions.language import LanguageModel, detect
from ..operators import language
from ..operators.corpus import chunk_words as chunks_of
from ..operators.corpus import ocr_choice
from .durable import spread
from .registry import query, table

NBSP, ZWSP, BELL, WIDE, ACUTE = " ", "​", "\x07", "　", "́"
TAIL = f"\n\n\n\nMenu\ne{ACUTE}te  x\t\ty\n Menu \n \nMenu\n{WIDE}end"


def dirty(c: Column) -> Column:
    """A text with what cleaning is there for: the test tables have none of it."""
    c = F.replace(F.replace(c, F.lit(" de "), F.lit(f" {NBSP}de{ZWSP} ")), F.lit(". "), F.lit(f".{WIDE} "))
    return F.concat(F.lit(BELL), c, F.lit(TAIL))


# ---------------------------------------------------------------- SQL pieces

_WS = r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def s_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def s_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{_WS}]+'), lambda w: w <> '')"


S_TAIL = "chr(10)||chr(10)||chr(10)||chr(10)||'Menu'||chr(10)||'e'||chr(769)||'te  x'||chr(9)||chr(9)||'y'||chr(10)||' Menu '||chr(10)||' '||chr(10)||'Menu'||chr(10)||chr(12288)||'end'"
S_DIRTY = f"dirty AS (SELECT doc_id, source, chr(7) || replace(replace(text, ' de ', ' '||chr(160)||'de'||chr(8203)||' '), '. ', '.'||chr(12288)||' ') || {S_TAIL} AS text FROM documents)"


def s_control(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '[\x{{A0}}\x{{200B}}\x{{200C}}\x{{200D}}\x{{FEFF}}]', ' ', 'g'), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{{9F}}]', '', 'g')"


def s_collapse(x: str) -> str:
    inner = rf"regexp_replace(regexp_replace({x}, '[ \t]{{2,}}', ' ', 'g'), '\n{{3,}}', chr(10)||chr(10), 'g')"
    return s_strip(f"array_to_string(list_transform(string_split({inner}, chr(10)), lambda l: {s_strip('l')}), chr(10))")


def s_repeated(source: str, extra: str = "") -> str:
    """CTEs: `kept` (doc_id, text) of (doc_id, text) in source."""
    return f"""
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM {source}),
counted AS (SELECT doc_id, l, i, {s_strip("l")} AS b, count(*) OVER (PARTITION BY doc_id, {s_strip("l")}) AS n FROM lines),
kept AS (SELECT doc_id, coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE b = '' OR n < 3 OR length(b) > 80), '') AS text FROM counted GROUP BY doc_id)"""


S_CLEAN = f"{S_DIRTY}, ready AS (SELECT doc_id, nfc_normalize({s_control('text')}) AS text FROM dirty), {s_repeated('ready')}"


def _dirty_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).withColumn("text", dirty(F.col("text")))


# ---------------------------------------------------------------- queries


@query(f"WITH {S_DIRTY} SELECT doc_id, {s_control('text')} AS text FROM dirty")
def remove_control_chars(spark, sf_dir):
    return _dirty_docs(spark, sf_dir).select("doc_id", tx.remove_control_chars(F.col("text")).alias("text"))


@query(f"WITH {S_DIRTY} SELECT doc_id, nfc_normalize(text) AS text FROM dirty")
def normalize_nfc(spark, sf_dir):
    return _dirty_docs(spark, sf_dir).select("doc_id", tu.normalize_nfc("text").alias("text"))


@query(f"WITH {S_DIRTY} SELECT doc_id, {s_collapse('text')} AS text FROM dirty")
def collapse_whitespace(spark, sf_dir):
    return _dirty_docs(spark, sf_dir).select("doc_id", tx.collapse_whitespace(F.col("text")).alias("text"))


@query(f"WITH {S_DIRTY}, {s_repeated('dirty')} SELECT doc_id, text FROM kept")
def remove_repeated_lines(spark, sf_dir):
    return _dirty_docs(spark, sf_dir).select("doc_id", tx.remove_repeated_lines(F.col("text")).alias("text"))


@query(f"WITH {S_CLEAN} SELECT doc_id, {s_collapse('text')} AS text FROM kept")
def clean_text(spark, sf_dir):
    return _dirty_docs(spark, sf_dir).select("doc_id", tu.clean_text("text").alias("text"))


@query(f"WITH {S_CLEAN} SELECT printf('DOC-%04d', doc_id + 1) AS doc_id, source || '/' || doc_id || '.txt' AS fuente, 'txt' AS formato, CAST(NULL AS INTEGER) AS fenomeno, {s_collapse('kept.text')} AS texto_limpio FROM kept JOIN (SELECT doc_id, source FROM documents) USING (doc_id)")
def unified_documents(spark, sf_dir):
    """The flagship: documents of the unified schema with cleaned text."""
    fuente = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return _dirty_docs(spark, sf_dir).select(
        F.format_string("DOC-%04d", F.col("doc_id") + 1).alias("doc_id"),
        fuente.alias("fuente"),
        F.lit("txt").alias("formato"),
        tx.category_from_path(fuente).alias("fenomeno"),
        tu.clean_text("text").alias("texto_limpio"),
    )


@query(f"WITH {S_CLEAN}, u AS (SELECT source AS formato, {s_collapse('kept.text')} AS t FROM kept JOIN (SELECT doc_id, source FROM documents) USING (doc_id)) SELECT formato, count(*) AS n, count(*) FILTER (WHERE length(t) < 200) AS short FROM u GROUP BY formato")
def corpus_summary(spark, sf_dir):
    cleaned = _dirty_docs(spark, sf_dir).select(F.col("source").alias("formato"), tu.clean_text("text").alias("t"))
    return cleaned.groupBy("formato").agg(F.count("*").alias("n"), F.count_if(F.length("t") < 200).alias("short"))


@query("SELECT doc_id, CAST(length(text) AS INTEGER) AS num_caracteres FROM documents")
def char_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("num_caracteres"))


@query(f"SELECT doc_id, CAST(len({s_words('text')}) AS INTEGER) AS n FROM documents")
def word_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.word_count(F.col("text")).alias("n"))


@query(f"WITH d AS (SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN ' ' || chr(20013) || chr(25991) || chr(12354) ELSE '' END AS text FROM documents) SELECT doc_id, CAST(len({s_words('text')}) + len(regexp_extract_all(text, '[\\x{{3040}}-\\x{{30FF}}\\x{{3400}}-\\x{{4DBF}}\\x{{4E00}}-\\x{{9FFF}}\\x{{F900}}-\\x{{FAFF}}]')) AS INTEGER) AS n FROM d")
def word_count_cjk(spark, sf_dir):
    text = F.concat("text", F.when(F.col("doc_id") % 3 == 0, F.lit(" 中文あ")).otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", tx.word_count_cjk(text).alias("n"))


@query("SELECT doc_id, CAST(len(string_split(text, chr(10))) AS INTEGER) AS num_lineas, 'utf-8' AS codificacion FROM documents")
def text_line_count(spark, sf_dir):
    text, encoding = tx.decode_text(F.col("text").cast("binary"))
    return table(spark, sf_dir, "documents").select("doc_id", tx.line_count(text).alias("num_lineas"), encoding.alias("codificacion"))


@query(f"WITH l AS (SELECT doc_id, {s_strip('unnest(string_split(text, chr(10)))')} AS line FROM documents) SELECT doc_id, line, count(*) AS n FROM l WHERE line <> '' GROUP BY ALL")
def line_frequency(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("l")).select("doc_id", tx.strip(F.col("l")).alias("line"))
    return lines.where("line <> ''").groupBy("doc_id", "line").agg(F.count("*").alias("n"))


#: The sample of the registered queries, so that there are texts outside it in small tables too.
_LANG_SAMPLE, _LANG_GRAMS = 60, 3000
_LANG = f"""
sizes AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY lang),
d AS (SELECT doc_id, d.lang, coalesce(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS HUGEINT) * n < CAST({_LANG_SAMPLE} AS HUGEINT) * 4294967296, false) AS own, {s_strip("substr(text, 1, 2000)")} AS head FROM documents d LEFT JOIN sizes USING (lang)),
w AS (SELECT doc_id, lang, own, length(head) AS n, regexp_replace(' ' || lower(head) || ' ', '[^\\p{{L}}]+', ' ', 'g') AS t FROM d),
g AS (SELECT doc_id, lang, own, g, count(*) AS n FROM (SELECT doc_id, lang, own, unnest(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) AS g FROM w) GROUP BY ALL),
vocabulary AS (SELECT g, sum(n) AS total FROM g WHERE own GROUP BY g ORDER BY total DESC, g LIMIT {_LANG_GRAMS}),
counts AS (SELECT lang, g, sum(n) AS c FROM g JOIN vocabulary USING (g) WHERE own GROUP BY lang, g),
totals AS (SELECT lang, sum(c) AS t FROM counts GROUP BY lang),
weights AS (SELECT v.g, t.lang AS code, ln((coalesce(c, 0) + 1) / (t + (SELECT count(*) FROM vocabulary))) AS weight FROM vocabulary v CROSS JOIN totals t LEFT JOIN counts c ON c.g = v.g AND c.lang = t.lang),
scores AS (SELECT doc_id, code, sum(n * weight) AS score FROM g JOIN weights USING (g) GROUP BY doc_id, code),
best AS (SELECT doc_id, arg_max(code, score) AS code FROM scores GROUP BY doc_id),
told AS (SELECT w.doc_id, w.lang, w.own, CASE WHEN n < 20 OR code IS NULL THEN 'und' ELSE code END AS idioma FROM w LEFT JOIN best ON w.doc_id = best.doc_id)"""


def _language_model(spark: SparkSession, sf_dir: str) -> LanguageModel:
    return language.fit(table(spark, sf_dir, "documents"), _LANG_SAMPLE, _LANG_GRAMS)


@query(f"WITH {_LANG} SELECT doc_id, idioma FROM told")
def lang_detect(spark, sf_dir):
    """A model fitted to a sample of the labelled documents, and the language of all."""
    model = _language_model(spark, sf_dir)
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", detect("text", model).alias("idioma"))


@query(f"WITH {_LANG} SELECT lang, count(*) AS n, CAST(count(*) FILTER (WHERE idioma = lang) AS BIGINT) AS n_right FROM told WHERE NOT own GROUP BY lang")
def lang_accuracy(spark, sf_dir):
    """How many documents outside the sample the model tells right, by language."""
    model, docs = _language_model(spark, sf_dir), table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    inside = language.sampled(docs, _LANG_SAMPLE).select("doc_id").distinct()
    rest = spread(docs.join(inside, "doc_id", "left_anti")).select("lang", detect("text", model).alias("idioma"))
    return rest.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("idioma") == F.col("lang")).alias("n_right"))


@query(f"SELECT doc_id, length({s_strip('substr(text, 1, 2000)')}) < 20 AS und FROM documents")
def lang_und_gate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", (F.length(tx.strip(F.substring("text", 1, tx.LANGUAGE_SAMPLE))) < tx.LANGUAGE_LEAST).alias("und"))


@query(f"SELECT doc_id, length({s_strip('text')}) < 50 AS pdf_empty, length({s_strip('text')}) < 30 AS image_empty, length({s_strip('text')}) >= 50 AS ocr_ok, len({s_words('text')}) >= 30 AS json_ok FROM documents")
def signal_thresholds(spark, sf_dir):
    n = F.length(tx.strip(F.col("text")))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        (n < tx.PDF_SIGNAL).alias("pdf_empty"),
        (n < tx.IMAGE_SIGNAL).alias("image_empty"),
        (n >= tx.OCR_SIGNAL).alias("ocr_ok"),
        (tx.word_count_cjk(F.col("text")) >= tx.JSON_WORDS).alias("json_ok")
    )


_VARIANTS = "v AS (SELECT doc_id, 0 AS variant, text FROM documents UNION ALL SELECT doc_id, 1, substr(text, 1, 10 + doc_id % 80) FROM documents)"


def _variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, and beside them short ones of lengths around the thresholds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    short = docs.select("doc_id", F.lit(1).alias("variant"), F.substring("text", F.lit(1), (10 + F.col("doc_id") % 80).cast("int")).alias("text"))
    return docs.select("doc_id", F.lit(0).alias("variant"), "text").unionByName(short)


@query(f"WITH {_VARIANTS} SELECT doc_id, variant, CASE WHEN length({s_strip('text')}) < 30 THEN '' ELSE text END AS text FROM v")
def ocr_min_signal(spark, sf_dir):
    return _variants(spark, sf_dir).select(
        "doc_id",
        "variant",
        F.when(F.length(tx.strip(F.col("text"))) < tx.IMAGE_SIGNAL, "").otherwise(F.col("text")).alias("text")
    )


@query(
    f"WITH {_VARIANTS}, o AS (SELECT *, CASE doc_id % 5 WHEN 0 THEN text || ' and more' WHEN 1 THEN text WHEN 2 THEN repeat(chr(10), 90) WHEN 3 THEN repeat(' ', 60) || 'y' || chr(9) END AS ocr FROM v)"
    f" SELECT doc_id, variant, CASE WHEN length({s_strip('text')}) < 50 AND length({s_strip('ocr')}) > length({s_strip('text')}) THEN ocr ELSE text END AS text FROM o"
)
def ocr_fallback_choice(spark, sf_dir):
    """OCR gives more, the same, white space only, next to nothing between white space, or fails."""
    case = F.col("doc_id") % 5
    ocr = F.when(case == 0, F.concat("text", F.lit(" and more"))).when(case == 1, F.col("text"))
    ocr = ocr.when(case == 2, F.repeat(F.lit("\n"), 90)).when(case == 3, F.lit(" " * 60 + "y\t"))
    return _variants(spark, sf_dir).select("doc_id", "variant", ocr_choice(F.col("text"), ocr).alias("text"))


@query(
    r"""
WITH s AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'https://e.org/' || event_id WHEN 1 THEN '2024-01-0' || (event_id % 9 + 1) || 'T10:00' WHEN 2 THEN ' ' || event_id || '.5 % ' WHEN 3 THEN 'DEADBEEF' || printf('%016d', event_id)
  WHEN 4 THEN '01234567-abcd-' || event_id WHEN 5 THEN 'text/' || event_type WHEN 6 THEN event_type || '.PDF' WHEN 7 THEN 'a note on ' || event_type ELSE event_type END AS s FROM events)
SELECT event_id, s FROM s WHERE NOT regexp_matches(trim(s), '(?i)^(?:https?://\S+|\d{4}-\d{2}-\d{2}(?:[T ]\S*)?|[\d\s.,%+-]+|[0-9a-f]{16,}|[0-9a-f]{8}-[0-9a-f]{4}-\S+|\w+/[\w.+-]+|\S+\.(?:pdf|json|html?|jpe?g|png|pbf|csv|xlsx))$')
"""
)
def junk_filter(spark, sf_dir):
    case = F.col("event_id") % 9
    n, kind = F.col("event_id").cast("string"), F.col("event_type")
    s = (
        F.when(case == 0, F.concat(F.lit("https://e.org/"), n))
        .when(case == 1, F.concat(F.lit("2024-01-0"), (case + 1).cast("string"), F.lit("T10:00")))
        .when(case == 2, F.concat(F.lit(" "), n, F.lit(".5 % ")))
        .when(case == 3, F.concat(F.lit("DEADBEEF"), F.format_string("%016d", F.col("event_id"))))
        .when(case == 4, F.concat(F.lit("01234567-abcd-"), n))
        .when(case == 5, F.concat(F.lit("text/"), kind))
        .when(case == 6, F.concat(kind, F.lit(".PDF")))
        .when(case == 7, F.concat(F.lit("a note on "), kind))
        .otherwise(kind)
    )
    return table(spark, sf_dir, "events").select("event_id", s.alias("s")).where(~tx.is_junk(F.col("s")))


@query("SELECT doc_id, substr(text, 1, 300) AS meta FROM documents")
def meta_truncate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.substring("text", 1, tx.META_LENGTH).alias("meta"))


@query("SELECT doc_id, 'query: ' || text AS q, 'passage: ' || text AS p FROM documents")
def prefix_texts(spark, sf_dir):
    from ..functions.vectors import prefixed

    return table(spark, sf_dir, "documents").select("doc_id", prefixed(F.col("text"), "query").alias("q"), prefixed(F.col("text"), "passage").alias("p"))


@query(
    f"""
WITH w AS (SELECT doc_id, {s_words("text")} AS ws FROM documents),
c AS (SELECT doc_id, ws, unnest(range(0, len(ws), 40)) AS s FROM w)
SELECT doc_id, CAST(s // 40 AS INTEGER) AS chunk_ix, array_to_string(ws[s + 1:s + 50], ' ') AS chunk FROM c
"""
)
def chunk_words(spark, sf_dir):
    return chunks_of(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), size=50, overlap=10)


@query("SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def exact_dedupe(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text")


_ENTITIES = [("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")]


def _s_entities(x: str) -> str:
    for pattern, to in _ENTITIES:
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'g')"
    return x


_TOKEN = f"""CASE
  WHEN regexp_matches(t, '^<h[1-6][ >]') THEN chr(10)||chr(10)||repeat('#', CAST(t[3] AS INTEGER))||' '
  WHEN regexp_matches(t, '^<li[ >]') THEN chr(10)||'- '
  WHEN regexp_matches(t, '^<(p|div|tr|section|article|br)[ />]') THEN chr(10)||chr(10)
  WHEN t[1] = '<' THEN ''
  WHEN {s_strip("t")} = '' THEN ''
  ELSE {s_strip(_s_entities("t"))} || ' ' END"""


@query(
    f"""
WITH p AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<head>.*?</head>', '', 'g'), '(?s)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>', '', 'g') AS h FROM pages)
SELECT page_id, array_to_string(list_transform(regexp_extract_all(h, '<[^>]*>|[^<]+'), lambda t: {_TOKEN}), '') AS text FROM p
"""
)
def html_to_text(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", tu.html_to_text("html").alias("text"))


@query("SELECT c_custkey, 'c_custkey: ' || c_custkey || ' | c_name: ' || c_name || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' | seg: ' || c_mktsegment END AS text FROM customer")
def row_to_text(spark, sf_dir):
    blank = F.when(F.col("c_custkey") % 3 == 0, F.when(F.col("c_custkey") % 2 == 0, F.lit(" \t")).otherwise("NaN")).otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        tx.row_to_text([("c_custkey", F.col("c_custkey")), ("c_name", F.col("c_name")), ("seg", blank)]).alias("text")
    )


@query("SELECT p_partkey, 'capa: ' || p_brand || ' | name: ' || p_name || CASE WHEN p_size > 10 THEN ' | size: ' || p_size ELSE '' END || ' | type: ' || p_type AS text FROM part")
def feature_text(spark, sf_dir):
    size = F.when(F.col("p_size") > 10, F.col("p_size").cast("string")).when(F.col("p_size") > 5, F.lit("  "))
    attrs = F.create_map(F.lit("name"), F.col("p_name"), F.lit("size"), size, F.lit("type"), F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", tx.feature_text(F.col("p_brand"), attrs).alias("text"))


@query(f"WITH ready AS (SELECT doc_id, nfc_normalize({s_control('text')}) AS text FROM documents), {s_repeated('ready')} SELECT doc_id, {s_collapse('text')} AS texto_limpio, CAST(length({s_collapse('text')}) AS BIGINT) AS num_caracteres FROM kept")
def stream_ingest(spark, sf_dir):
    """Structured Streaming over the documents table, all available files, into Parquet."""
    from ..streaming.ingest import ingested

    return ingested(spark, f"{sf_dir}/documents.parquet")
