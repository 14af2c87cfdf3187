"""Filter audit, Merkle manifest and URL filters against plain Python, and their SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import DATA, differences
from llm_helpers import told
from sedimenta.llm import audit, merkle, queries, urls
from sedimenta.llm.base import PLAIN, Words, binary

LABELS = [(0, 1, 0), (1, 1, 0), (1, 0, 1), (3, 0, 1), (5, 1, 1), (9, None, 1), (10, 0, 0), (None, 1, 1), (99, 1, 1), (15, 1, None)]
LABELLED = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_merkle", "op13_url_filter"])
def test_sql(spark, name):
    assert differences(spark, queries.QUERIES[name], queries.ORACLES[name], str(DATA / "sf0.001")) == ""


# ---------------------------------------------------------------- filter audit


def audited(rows, labels):
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    parts = defaultdict(list)
    for i, text, _, source, *_ in rows:
        t = text or ""
        words = re.findall(rb"[^\x20\x09-\x0D]+", t.encode())
        fails = "".join(
            x
            for x, f in zip(
                "ABCDE",
                (
                    len(words) < 50,
                    100 * len(set(words)) < 65 * len(words),
                    100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                    bool(re.search(r"[#$%&*|]", t)),
                    i is not None and i > least[t],
                ),
            )
            if f
        )
        good = i is not None and any(d == i and q == 1 for d, q, _ in labels)
        toxic = i is not None and any(d == i and x == 1 for d, _, x in labels)
        parts[source or ""].append((fails, good, toxic))
    out = []
    for part, docs in parts.items():
        shapley = Counter()
        found = []
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, x in enumerate(order, 1):
                removed = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                shapley[x] += len(removed)
                redundant = sum(x in f for f, *_ in docs) - len(removed)
                found.append([part, order, step, len(left), len(removed), redundant, sum(f == x for f, *_ in docs), sum(g for _, g, _ in removed), sum(t for *_, t in removed)])
        out += [(*f, shapley[f[1][f[2] - 1]]) for f in found]
    return sorted(out, key=repr)


def some_texts():
    draw = random.Random(3)
    words = [f"{'Ab'[k % 2]}{k}{'é' * (k % 3)}" for k in range(90)]
    made = [" ".join(draw.choice(words[: draw.choice([5, 60, 90])]) for _ in range(draw.choice([10, 49, 50, 51, 200]))) for _ in range(40)]
    made += ["a " * 35 + " ".join(f"w{k}" for k in range(65)), "B" * 5 + "é" * 95, "B" * 6 + "é" * 94, "x | y", "a\x0bb\x1cc", *made[:9]]
    return [(1000 + k, t, "en", [None, "", "s0", "s9"][k % 4], 1) for k, t in enumerate(made)]


def test_filter_audit(spark, documents, rows):
    labels = spark.createDataFrame(LABELS, LABELLED)
    more = some_texts()
    table = documents.unionByName(spark.createDataFrame(more, documents.schema))
    assert told(audit.filter_audit(table, labels)) == audited([*rows, *more], LABELS)


def test_filter_audit_edges(spark, clashing, empty, rows):
    labels = spark.createDataFrame(LABELS, LABELLED)
    odd = clashing.withColumns({c: F.lit("x") for c in ("part", "d1", "d2", "mask", "head", "told", "held", "quality", "toxic")})
    odd_labels = labels.withColumns({c: F.lit("x") for c in ("text", "source", "part", "told", "mask")})
    assert told(audit.filter_audit(odd, odd_labels)) == audited(rows, LABELS)
    assert audit.filter_audit(empty, labels).count() == 0
    assert told(audit.filter_audit(clashing, labels.limit(0))) == audited(rows, [])


def test_filter_audit_of_one_row_many_times(spark):
    rows = [(7, "the same text", "en", "s", 1)] * 3000 + [(8, "the same text", "en", "s", 1)] * 2000 + [(None, "the same text", "en", "s", 1)] * 1000
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert told(audit.filter_audit(table, spark.createDataFrame(LABELS, LABELLED))) == audited(rows, LABELS)


def test_distinct_words_where_hashes_are_equal(monkeypatch):
    texts = ["a b a c", "", "a", "é é é b", "x x x"]
    words = Words(*binary(pa.array(texts)), PLAIN)
    assert audit.distinct_words(words).tolist() == [3, 0, 1, 2, 1]
    monkeypatch.setattr(Words, "hashes", lambda self, seed=0: np.zeros(len(self), np.uint64))
    assert audit.distinct_words(words).tolist() == [3, 0, 1, 2, 1]


# ---------------------------------------------------------------- Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    i, text, lang, source, n = row
    if lower and text is not None:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def manifested(rows, width=16):
    """Level by level, each leaf by itself."""

    def levels(nodes):
        found = [nodes]
        while len(found[-1]) > 1:
            found.append([sha("".join(found[-1][k : k + width])) for k in range(0, len(found[-1]), width)])
        return found

    def path(tree, at):
        out = []
        for level in tree[:-1]:
            first = at // width * width
            out.append(("".join(level[first:at]), "".join(level[at + 1 : first + width])))
            at //= width
        return out

    parts = defaultdict(list)
    for r in rows:
        parts[r[3]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        parts[name].sort(key=lambda x: x[:3])
        trees[name] = levels([x[2] for x in parts[name]])
    top = levels([trees[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for at, (_, _, digest, r) in enumerate(parts[name]):
            way = path(trees[name], at) + path(top, k)
            folded = leaf(r, True) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else digest
            for a, b in way:
                folded = sha(a + folded + b)
            root = top[-1][0]
            out.append((r[0], digest, trees[name][-1][0], root, sha("".join(a + b for a, b in way)), folded, folded == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width, levels", [(16, 3), (2, 1), (2, 2), (3, 2)])
def test_manifest(documents, rows, width, levels):
    assert told(merkle.manifest(documents, width, levels)) == manifested(rows, width)


@pytest.mark.parametrize("n", [1, 4, 5, 16, 17, 33])
def test_manifest_by_number_of_leaves(spark, n):
    rows = [(k, f"Text {k}", "en", None if k % 7 == 0 else "é" if k % 7 == 1 else "", k) for k in range(n)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert told(merkle.manifest(table, 4, 1)) == manifested(rows, 4)


def test_manifest_of_many_parts(spark):
    rows = [(k, "T", None, f"s{k % 40}" if k % 41 else None, None) for k in range(300)] + [(5, "T", None, "s5", None)] * 50
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert told(merkle.manifest(table, 2, 2)) == manifested(rows, 2)


def test_manifest_edges(clashing, empty, rows):
    odd = clashing.withColumns({c: F.lit("x") for c in ("part", "pos", "leaf", "changed", "spread", "at", "first", "block", "held", "digest", "above", "root")})
    assert told(merkle.manifest(odd)) == manifested(rows)
    assert merkle.manifest(empty).collect() == []


def test_each_change_shows(spark, rows):
    """Whatever field of a leaf changes, the folded root is another one."""
    base = (2, "Text", "en", "s", 4)
    digests = {leaf(base)} | {leaf(base[:k] + (v,) + base[k + 1 :]) for k, v in ((0, 3), (0, None), (1, "text"), (1, None), (1, ""), (2, None), (3, "t"), (4, 5))}
    assert len(digests) == 9
    table = spark.createDataFrame([base], "doc_id long, text string, lang string, source string, n_chars long")
    assert merkle.leaves(table).first()["leaf"] == leaf(base)


# ---------------------------------------------------------------- URL filters

ODD_URLS = [
    None,
    "",
    "no scheme/org/",
    "http://",
    "http://org",
    "http://org/",
    "HTTP://Example.ORG/es/x?q#f",
    "http://example.org/en/1",
    "http://example.org/en/12/3",
    "http://example.org/en/21",
    "http://badexample.org/es/",
    "http://a.b.example.org/es/1",
    "http://a.com/fr/?x",
    "http://a.com/fr",
    "http://a.com#/fr/",
    "http://a.com/de/1://b.org/",
    "x\ny://c.com\n/de/",
    "http://.org/",
    "http://org./",
    "http://a..org/",
    "http://user@a.org:80/",
    "http://m.casino-win.example.com/en/1",
    "http://casino-win.example.org/es/1",
    "http://casino-win.example.net",
    "http://" + "a." * 3000 + "org/" + "p" * 5000,
    "://org/",
]


def judged(pages, listed):
    out = []
    for i, url, *_ in pages:
        host = path = ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        best = None
        for entry, verdict, ruled in listed:
            name, _, start = entry.partition("/")
            start = "/" + start if "/" in entry else start
            if (host == name or host.endswith("." + name)) and path.startswith(start):
                best = max(best or (), (ruled, len(entry), len(name), entry, verdict))
        rule = best[3] if best and best[0] else None
        out.append((i, host, path, rule, best[4] if best else "allow", best[3] if best and not best[0] else None))
    return sorted(out, key=repr)


def default_list():
    return [(u, v, True) for u, v in urls.RULES] + [(f"{s}.{d}/", "block", False) for s in urls.SITES for d in urls.DOMAINS]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, u) for k, u in enumerate(ODD_URLS)] + [(3, "http://x.org/"), (3, "http://x.org/"), (None, "http://x.com/de/"), (None, None)]
    return rows, spark.createDataFrame(rows, "page_id long, url string")


def test_urls(spark, pages):
    rows, table = pages
    assert told(urls.verdicts(table, urls.rules(spark))) == judged(rows, default_list())


@pytest.mark.parametrize("blocks, broadcast", [(1, 0), (1, 1 << 20), (7, 0)])
def test_urls_with_a_long_list(spark, blocks, broadcast):
    """A filter that is too small lets more through; the exact join, here with salts too, gives the same rows."""
    draw = random.Random(5)
    hosts = [".".join(draw.choice(["a", "bb", "c1", "org"]) for _ in range(draw.randint(1, 5))) for _ in range(300)]
    paths = ["/" + "/".join(draw.choice(["x", "yy", "é"]) for _ in range(draw.randint(0, 3))) for _ in range(300)]
    listed = sorted({(draw.choice(hosts) + draw.choice(paths), draw.choice([True, False])) for _ in range(400)})
    listed = [(u, draw.choice(["allow", "block"]), r) for u, r in listed]
    rows = [(k, "http://" + draw.choice(hosts) + draw.choice(paths)) for k in range(500)] + [(1, f"http://{hosts[0]}{paths[0]}")] * 300
    got = urls.verdicts(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(listed, "listed string, verdict string, ruled boolean"), most_blocks=blocks, broadcast=broadcast)
    assert told(got) == judged(rows, listed)


def test_urls_edges(spark, pages):
    rows, table = pages
    odd = table.withColumns({c: F.lit("x") for c in ("key", "keys", "rank", "host", "path", "rule", "listed", "block", "h", "own", "rows", "copy", "_blocked")})
    assert told(urls.verdicts(odd, urls.rules(spark))) == judged(rows, default_list())
    assert urls.verdicts(table.limit(0), urls.rules(spark)).count() == 0
    assert told(urls.verdicts(table, urls.rules(spark, [], []))) == judged(rows, [])
    nulls = spark.createDataFrame([(None, "block", True), ("org", "block", True), ("org", "allow", True)], "listed string, verdict string, ruled boolean")
    assert told(urls.verdicts(table, nulls)) == judged(rows, [("org", "allow", True)])


def test_keep_allowed(spark, pages):
    rows, table = pages
    blocked = {x[0:1] + (x[1], x[2]) for x in judged(rows, default_list()) if x[4] == "block"}
    kept = urls.keep_allowed(table.withColumn("_x", F.lit("kept")), urls.rules(spark))
    assert kept.columns == ["page_id", "url", "_x"] and kept.count() == len(rows) - len([r for r in judged(rows, default_list()) if r[4] == "block"])
    assert blocked


def test_urls_stay_in_the_jvm(spark, pages):
    plan = urls.verdicts(pages[1], urls.rules(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_bloom_filter_holds_every_key_and_few_others(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    held = urls.bloom(keys, 94)
    probe = spark.range(20000).select("id", F.concat(F.lit("k"), "id").alias("key"))
    probe = probe.withColumns({"block": F.pmod(F.xxhash64("key"), F.lit(94)).cast("int"), "h": F.xxhash64("key", F.lit(1))}).join(held, "block").where(urls.passes())
    told_ = [r["id"] for r in probe.collect()]
    assert set(range(3000)) <= set(told_) and len(told_) - 3000 < 170
