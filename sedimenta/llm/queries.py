"""The opN_ queries over the driver's tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .base import table


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score

    return score(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_dedup

    return simhash_dedup(table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import embedding_top_k

    return embedding_top_k(table(spark, sf_dir, "embeddings"))


def op5_pieces(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    from .pieces import digests

    return digests(table(spark, sf_dir, "documents"), model or public_tokenizer("piece_bpe_32k.model"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import scan

    return scan(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    return shard(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    from .token_files import token_digests

    return token_digests(table(spark, sf_dir, "documents"), tokenizer or public_tokenizer("word_bpe_49k.json"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .audit import filter_audit

    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import manifest

    return manifest(table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urls import rules, verdicts

    return verdicts(table(spark, sf_dir, "pages"), rules(spark))


# ---------------------------------------------------------------- SQL counterparts that are composed


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets_sql() -> str:
    from .secrets import ALLOWED, BASE, CLASSES, CUT

    kinds = [*BASE, *CLASSES]
    finds, held = [], []
    for n, (pattern, group, least) in enumerate(BASE.values()):
        finds.append((n, pattern, f"length(regexp_extract(m, {_quote(pattern)}, {group})) >= {least}"))
    for n, (alphabet, width, _, needs) in enumerate(CLASSES.values(), len(BASE)):
        inside = "".join("\\" + c if c in "+/-_" else c for c in alphabet)
        finds.append((n, f"[{inside}]{{{width},}}", " AND ".join(f"NOT regexp_matches(m, {_quote(p)})" for p in ALLOWED)))
        held.append(f"(kind = {n} AND " + " AND ".join(f"regexp_matches(m, {_quote(p)})" for p in needs) + ")")
    raw = " UNION ALL ".join(
        f"SELECT * FROM (SELECT doc_id, {n} AS kind, unnest(regexp_extract_all(text, {_quote(p)})) AS m, unnest(regexp_split_to_array(text, {_quote(p)})[:-2]) AS gap, generate_subscripts(regexp_extract_all(text, {_quote(p)}), 1) AS i FROM d)" for n, p, _ in finds
    )
    keep = " OR ".join(f"(kind = {n} AND {test})" for n, _, test in finds)
    widths = " ".join(f"WHEN {n} THEN {c[1]}" for n, c in enumerate(CLASSES.values(), len(BASE)))
    bits = " ".join(f"WHEN {n} THEN {c[2]}" for n, c in enumerate(CLASSES.values(), len(BASE)))
    names = "[" + ", ".join(_quote(k) for k in kinds) + "]"
    told = f"string_agg({names}[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {n}) AS n_{k}" for n, k in enumerate(BASE))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
raw AS ({raw}),
placed AS (SELECT doc_id, kind, m, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS e FROM raw),
good AS (SELECT doc_id, kind, m, e - length(m) AS s, e FROM placed WHERE {keep}),
base AS (SELECT doc_id, kind, s, e FROM good WHERE kind < {len(BASE)}),
cuts AS (SELECT *, regexp_split_to_array(m, {_quote(CUT)}) AS parts, list_concat([''], regexp_extract_all(m, {_quote(CUT)})) AS before FROM good WHERE kind >= {len(BASE)}),
parts AS (SELECT doc_id, kind, s AS s0, unnest(parts) AS m, unnest(before) AS gap, generate_subscripts(parts, 1) AS i FROM cuts),
pieces AS (SELECT doc_id, kind, s0, m, CAST(s0 + sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind, s0 ORDER BY i) - length(m) AS BIGINT) AS s FROM parts),
wins AS (SELECT doc_id, kind, s, m, CASE kind {widths} END AS w, CASE kind {bits} END AS bits, unnest(range(0, length(m) - CASE kind {widths} END + 1)) AS at0 FROM pieces WHERE {" OR ".join(held)}),
hot AS (SELECT doc_id, kind, s + at0 AS a, s + at0 + w AS b, s FROM wins WHERE list_aggregate(string_split(substr(m, at0 + 1, w), ''), 'entropy') >= bits - 1e-9),
more AS (SELECT doc_id, kind, min(a) AS s, max(b) AS e FROM hot GROUP BY doc_id, kind, hot.s),
added AS (SELECT * FROM more WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.doc_id = more.doc_id AND base.s <= more.s AND more.e <= base.e)),
b AS (SELECT doc_id, {counts}, {told} AS spans FROM base GROUP BY doc_id),
a AS (SELECT doc_id, {told} AS spans, count(*) FILTER (WHERE kind >= {len(BASE)}) AS n_added FROM (SELECT * FROM base UNION ALL SELECT * FROM added) GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(b.spans, '')) AS base_sha256, coalesce(a.spans, '') AS spans, coalesce(n_added, 0) AS n_added
FROM d LEFT JOIN b ON d.doc_id = b.doc_id LEFT JOIN a ON d.doc_id = a.doc_id
"""


def _licenses_sql() -> str:
    from .licenses import BLOCK, PHRASES, STRIDE, TEMPLATES, THRESHOLD

    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    places = " UNION ALL ".join(
        f"SELECT doc_id, {_quote(label)} AS label, unnest(list_filter(range(1, len(ws) + 1), lambda i: {' AND '.join(f'ws[i + {k}] = {_quote(w)}' for k, w in enumerate(p.split()))})) - 1 AS pos FROM d" for p, label in PHRASES.items()
    )
    templates = ", ".join(
        f"({k}, {_quote(label)}, {sorted(set(t.split()))}, {len(t.split())})" for k,
        (label, t) in enumerate((label, t) for label, texts in TEMPLATES.items() for t in texts)
    )
    return f"""
WITH l AS (SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, {word}) AS ws FROM l),
p AS ({places}),
b AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY doc_id),
lines AS (SELECT doc_id, regexp_extract_all(line, {word}) AS ws FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM l)),
blocks AS (SELECT doc_id, ws[s + 1:s + {BLOCK}] AS ws FROM (SELECT doc_id, ws, unnest(range(0, greatest(1, len(ws) - {BLOCK - STRIDE}), {STRIDE})) AS s FROM lines)),
templates(k, label, own, most) AS (VALUES {templates}),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM d),
marked AS (SELECT doc_id, k, w, pos, coalesce(lag(pos) OVER (PARTITION BY doc_id, k, w ORDER BY pos), -1) AS before FROM words JOIN (SELECT k, unnest(own) AS w FROM templates) USING (w)),
enough AS (SELECT doc_id, k FROM marked JOIN templates USING (k) GROUP BY doc_id, k HAVING count(DISTINCT w) >= {THRESHOLD} * any_value(len(own)) - 1e-9),
few AS (SELECT marked.* FROM marked JOIN enough USING (doc_id, k)),
wrapped AS (SELECT a.doc_id, k, a.pos, count(*) AS n FROM few a JOIN templates USING (k) JOIN few b USING (doc_id, k) WHERE b.pos >= a.pos AND b.pos < a.pos + most AND b.before < a.pos GROUP BY a.doc_id, k, a.pos),
shares AS (SELECT doc_id, label, len(list_intersect(own, ws)) / len(own) AS share FROM blocks CROSS JOIN templates
  UNION ALL SELECT doc_id, label, n / len(own) FROM wrapped JOIN templates USING (k)),
found AS (SELECT doc_id, label, max(share) AS share FROM shares WHERE share >= {THRESHOLD} - 1e-9 GROUP BY ALL),
labels AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM found UNION ALL SELECT doc_id, label FROM p) GROUP BY doc_id),
scores AS (SELECT doc_id, max(share) AS score FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN b ON d.doc_id = b.doc_id LEFT JOIN labels ON d.doc_id = labels.doc_id LEFT JOIN scores ON d.doc_id = scores.doc_id
"""


def _sharding_sql() -> str:
    def jump(shards: int) -> str:
        step = "(s[1] * 2862933555777941757 + 1) % 18446744073709551616"
        jumped = f"CAST(floor(CAST(s[3] + 1 AS DOUBLE) * (2147483648.0 / CAST((({step}) // 8589934592) + 1 AS DOUBLE))) AS HUGEINT)"
        walk = f"list_reduce(list_transform(range({shards + 1}), lambda x: [CAST(0 AS HUGEINT)]), lambda s, x: CASE WHEN s[3] >= {shards} THEN s ELSE [{step}, s[3], {jumped}] END, [CAST(key AS HUGEINT), CAST(-1 AS HUGEINT), CAST(0 AS HUGEINT)])"
        return f"CAST(({walk})[2] AS INTEGER)"

    return f"""
WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS crc),
d AS (SELECT doc_id, encode(coalesce(text, '')) AS raw, (coalesce(doc_id, 0) + CAST(18446744073709551616 AS HUGEINT)) % 18446744073709551616 AS key FROM documents),
r AS (SELECT doc_id, CAST(octet_length(raw) + 1 AS BIGINT) AS size,
  xor(list_reduce(list_transform(regexp_extract_all(hex(raw), '..'), lambda x: CAST(CAST('0x' || x AS INTEGER) AS BIGINT)), lambda c, b: xor(c >> 8, t.crc[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS text_crc32,
  {jump(8)} AS shard, {jump(9)} AS grown_shard FROM d, t)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, grown_shard FROM r
"""


def _audit_sql() -> str:
    from .audit import FILTERS, LEAST_DISTINCT, LEAST_WORDS, MOST_CAPITALS

    fails = {
        "A": f"len(ws) < {LEAST_WORDS}",
        "B": f"100 * len(list_distinct(ws)) < {LEAST_DISTINCT} * len(ws)",
        "C": f"100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(t)",
        "D": "regexp_matches(t, '[#$%&*|]')",
        "E": "coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)",
    }
    told = " || ".join(f"CASE WHEN {fails[x]} THEN '{x}' ELSE '' END" for x in FILTERS)
    letters = ", ".join(f"('{x}')" for x in FILTERS)
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
f AS (SELECT doc_id, part, {told} AS fails FROM w),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
g AS (SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY ALL),
x(x) AS (VALUES {letters}),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = {len(FILTERS)}),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, filter_order[:step - 1] AS earlier FROM o, range(1, {len(FILTERS) + 1}) r(step)),
h AS (SELECT part, filter_order, step, own, good, toxic, n, fails, contains(fails, own) AS hit, len(list_intersect(string_split(fails, ''), string_split(earlier, ''))) > 0 AND earlier <> '' AS gone FROM g, s),
c AS (SELECT part, filter_order, step, own,
  coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0) AS removed,
  coalesce(sum(n) FILTER (WHERE hit AND gone), 0) AS redundant, coalesce(sum(n) FILTER (WHERE fails = own), 0) AS unique_fails,
  coalesce(sum(n) FILTER (WHERE hit AND NOT gone AND good), 0) AS good_lost, coalesce(sum(n) FILTER (WHERE hit AND NOT gone AND toxic), 0) AS toxic_lost
  FROM h GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, {", ".join(f"CAST({x} AS BIGINT) AS {x}" for x in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM c
"""


def _merkle_sql() -> str:
    from .merkle import FIELDS, WIDTH

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def leaf(text: str) -> str:
        values = [text if c == "text" else f"CAST({c} AS VARCHAR)" for c in FIELDS]
        return "sha256(" + " || ".join(f"CASE WHEN {v} IS NULL THEN '-' ELSE octet_length(encode({v})) || ':' || {v} END" for v in values) + ")"

    crc = "xor(list_reduce(list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), lambda x: CAST(CAST('0x' || x AS INTEGER) AS BIGINT)), lambda c, b: xor(c >> 8, t.crc[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"
    tree = f"""SELECT level + 1, part, pos // {WIDTH}, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + {WIDTH - 1}) // {WIDTH}) FROM XX WHERE n > 1 GROUP BY level, part, pos // {WIDTH}"""
    around = f"""SELECT level, part, pos, digest, n,
  coalesce(string_agg(digest, '') OVER (PARTITION BY level, part, pos // {WIDTH} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
  coalesce(string_agg(digest, '') OVER (PARTITION BY level, part, pos // {WIDTH} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM XX"""
    return f"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS crc),
d AS (SELECT doc_id, coalesce('=' || source, '-') AS part, {leaf("text")} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {leaf(f"translate(text, '{upper}', '{upper.lower()}')")} END AS changed FROM documents, t),
r AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY part) AS n FROM d),
low(level, part, pos, digest, n) AS (SELECT 0, part, pos, leaf, n FROM r UNION ALL {tree.replace("XX", "low")}),
subs AS (SELECT '' AS part, part AS name, digest, row_number() OVER (ORDER BY part) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high(level, part, pos, digest, n) AS (SELECT 0, part, pos, digest, n FROM subs UNION ALL {tree.replace("XX", "high")}),
nodes AS (SELECT 0 AS tree, * FROM ({around.replace("XX", "low")}) UNION ALL SELECT 1 AS tree, * FROM ({around.replace("XX", "high")})),
walk(k, tree, level, part, pos, n, doc_id, leaf, own, proof, folded) AS (
  SELECT row_number() OVER (), 0, 0, part, pos, n, doc_id, leaf, part, '', coalesce(changed, leaf) FROM r
  UNION ALL
  SELECT k, CASE WHEN w.n > 1 THEN w.tree ELSE 1 END, CASE WHEN w.n > 1 THEN w.level + 1 ELSE 0 END, CASE WHEN w.n > 1 THEN w.part ELSE '' END,
    CASE WHEN w.n > 1 THEN w.pos // {WIDTH} ELSE s.pos END, CASE WHEN w.n > 1 THEN (w.n + {WIDTH - 1}) // {WIDTH} ELSE s.n END, doc_id, leaf, own,
    CASE WHEN w.n > 1 THEN proof || x.a || x.b ELSE proof END, CASE WHEN w.n > 1 THEN sha256(x.a || folded || x.b) ELSE folded END
  FROM walk w JOIN nodes x ON x.tree = w.tree AND x.level = w.level AND x.part = w.part AND x.pos = w.pos JOIN subs s ON s.name = w.own
  WHERE w.tree = 0 OR w.n > 1)
SELECT doc_id, leaf, s.digest AS subroot, h.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h.digest AS verified
FROM walk w JOIN subs s ON s.name = w.own JOIN high h ON h.n = 1 WHERE w.tree = 1 AND w.n = 1
"""


def _urls_sql() -> str:
    from .urls import DOMAINS, RULES, SITES

    listed = [(u, v, True) for u, v in RULES] + [(f"{s}.{d}/", "block", False) for s in SITES for d in DOMAINS]
    values = ", ".join(f"({_quote(u.partition('/')[0])}, {_quote(u[u.index('/'):])}, {_quote(v)}, {r})" for u, v, r in listed)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{upper}', '{upper.lower()}') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
l(name, start, verdict, ruled) AS (VALUES {values}),
m AS (SELECT r, max(struct_pack(ruled := ruled, long := length(name || start), wide := length(name), listed := name || start, verdict := verdict)) AS best
  FROM p JOIN l ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY r)
SELECT page_id, host, path, CASE WHEN best.ruled THEN best.listed END AS rule, coalesce(best.verdict, 'allow') AS verdict, CASE WHEN NOT best.ruled THEN best.listed END AS listed
FROM p LEFT JOIN m ON p.r = m.r
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_substring_dedup,
        op3_simhash,
        op4_topk,
        op5_pieces,
        op6_secrets,
        op7_decontamination,
        op8_licenses,
        op9_sharding,
        op10_token_files,
        op11_filter_audit,
        op12_merkle,
        op13_url_filter,
    )
}

ORACLES: dict[str, str] = {
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS pos FROM d WHERE len(ws) >= 50),
h AS (SELECT doc_id, pos, md5(array_to_string(ws[pos:pos + 49], ' ')) AS h FROM p),
c AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY h) AS least FROM h),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS i FROM c WHERE least < doc_id),
w AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
k AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) FILTER (WHERE gone.i IS NULL) AS kept, count(gone.i) AS n FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.i = gone.i GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
""",
    "op4_topk": """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r),
r AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS "rank", vec_id, score FROM r WHERE n <= 5
""",
    "op6_secrets": _secrets_sql(),
    "op8_licenses": _licenses_sql(),
    "op9_sharding": _sharding_sql(),
    "op11_filter_audit": _audit_sql(),
    "op12_merkle": _merkle_sql(),
    "op13_url_filter": _urls_sql(),
}
