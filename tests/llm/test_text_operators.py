"""Substring dedup, SimHash, secrets, licenses against plain Python."""

import hashlib
import math
import random
import re
import time
from collections import Counter
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from llm_helpers import told
from sedimenta.llm import licenses, near_copies, secrets, simhash
from sedimenta.llm.components import components
from sedimenta.llm.substring_dedup import once, repeated_spans, substring_dedup


def removed(rows, window):
    """(doc_id, n_words, n_removed, digest) of each row by comparing all windows."""
    first = {}
    for i, text, *_ in rows:
        words = (text or "").encode().split()
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text, *_ in rows:
        words = (text or "").encode().split()
        keep = [True] * len(words)
        for p in range(len(words) - window + 1):
            if i is not None and first[tuple(words[p : p + window])] < i:
                keep[p : p + window] = [False] * window
        out.append((i, len(words), keep.count(False), hashlib.sha256(b" ".join(w for w, k in zip(words, keep) if k)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window, node", [(50, 25), (8, 3), (3, 3), (2, 1)])
def test_substring_dedup(documents, rows, window, node):
    assert told(substring_dedup(documents, window, node, with_text=False)) == removed(rows, window)


def test_substring_dedup_random(spark):
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choice("ab") for _ in range(draw.randint(0, 40)))) for i in range(60)]
    got = substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), 9, 4)
    assert told(got.drop("kept_text")) == removed(rows, 9)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got.collect())


def test_substring_dedup_tells_like_hashes_apart(spark):
    """A Thue-Morse word and its complement have the same sum of powers modulo 2**64, whatever the base; so have such runs of words."""
    bits = [bin(k).count("1") & 1 for k in range(2048)]
    word, other = ("".join("ab"[b ^ c] for b in bits) for c in (0, 1))
    same = " ".join(f"w{k}" for k in range(49))
    texts = [f"{same} {word}", f"{same} {other}", " ".join("ab"[b] for b in bits), " ".join("ba"[b] for b in bits), f"{same} {word} end"]
    rows = list(enumerate(texts))
    got = told(substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), with_text=False))
    assert got == removed(rows, 50) and got[1][2] == 0 and got[4][2] == 50


def test_substring_dedup_edges(clashing, empty, rows):
    assert told(substring_dedup(clashing, with_text=False)) == removed(rows, 50)
    assert substring_dedup(empty).count() == 0


@pytest.mark.parametrize("copies", [100, 20000])
def test_substring_dedup_of_one_row_many_times(spark, copies):
    """Repetitions of a row are judged once: spans don't grow with them, and time only as rows do."""
    words = [f"w{k}" for k in range(402)]
    first, again = " ".join(words[:300]), " ".join(words)
    rows = [(1, first)] + [(2, again)] * copies + [(2, first), (3, again), (None, again), (None, again)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    began = time.time()
    got = Counter(tuple(r) for r in substring_dedup(table, with_text=False).collect())
    assert time.time() - began < 60
    assert got == Counter(removed([*rows[:2], *rows[copies + 1 :]], 50)) + Counter({removed(rows[:2], 50)[1]: copies - 1})
    assert repeated_spans(once(table)).count() < 1000


def print_of(text, width):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(rows, radius, width):
    """Each row's fingerprint and class, and each class's smallest doc_id."""
    prints = [print_of(t, width) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            root[find(a)] = find(b)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return prints, [find(k) for k in range(len(rows))], least


def classes(rows, radius, width):
    prints, own, least = linked(rows, radius, width)
    return sorted(((i, f"{p:016x}", least.get(r)) for (i, *_), p, r in zip(rows, prints, own)), key=repr)


@pytest.mark.parametrize("radius, block", [(4, 8192), (8, 8192), (7, 2), (0, 8192)])
def test_simhash(documents, rows, radius, block):
    assert told(simhash.simhash_dedup(documents, radius, block=block)) == classes(rows, radius, 4)


def test_simhash_edges(clashing, empty, rows):
    assert told(simhash.simhash_dedup(clashing)) == classes(rows, 4, 4)
    assert simhash.simhash_dedup(empty).count() == 0
    kept = simhash.one_of_each(clashing)
    assert kept.columns == clashing.columns
    stays = [tuple(r)[:5] for r in kept.collect()]
    assert sorted(r[0] for r in stays if r[0] is not None) == sorted(linked(rows, 4, 4)[2].values())
    assert sum(r[0] is None for r in stays) == sum(r[0] is None for r in rows) and set(stays) <= set(rows)


def test_one_of_each_keeps_texts_that_share_an_id(spark):
    """Each row is judged by its own text; of equal rows one stays, whatever their order."""
    texts = [" ".join(f"{c}{k}" for k in range(60)) for c in "abc"]
    rows = [(1, texts[0], "x"), (1, texts[1], "x"), (1, texts[1], "y"), (2, texts[0], "x"), (2, texts[2], "x"), (None, texts[2], "x"), (None, texts[2], "x")]
    for of in (simhash, near_copies):
        found = {tuple(told(of.one_of_each(spark.createDataFrame(some, "doc_id long, text string, lang string").repartition(2)))) for some in (rows, rows[::-1])}
        assert len(found) == 1
        got = [r[:2] for r in found.pop()]
        assert sorted(got, key=repr) == sorted([rows[0][:2], rows[1][:2], rows[4][:2], (None, texts[2]), (None, texts[2])], key=repr)


@pytest.mark.parametrize("radius", [1, 3, 4])
def test_masks_cover(radius):
    """Any differences up to the radius leave some mask untouched."""
    draw = random.Random(radius)
    own = simhash.masks(radius)
    assert len(own) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        difference = sum(1 << b for b in draw.sample(range(64), radius))
        assert any(m & difference == 0 for m in own)


def test_components(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(40)] + [(5000, 5001 + k) for k in range(50)]
    root = {x: x for e in edges for x in e}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(x, find(x)) for x in linked}


def secret_spans(text):
    text, base, added = text or "", [], []
    for kind, (pattern, group, least) in enumerate(secrets.BASE.values()):
        base += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    for kind, (alphabet, width, bits, needs) in enumerate(secrets.CLASSES.values(), len(secrets.BASE)):
        for m in re.finditer("[" + re.escape(alphabet) + "]{%d,}" % width, text):
            if any(re.search(p, m.group()) for p in secrets.ALLOWED):
                continue
            cuts = [(0, 0), *((c.start(), c.end()) for c in re.finditer(secrets.CUT, m.group())), (len(m.group()),) * 2]
            for (_, begin), (end, _) in zip(cuts, cuts[1:]):
                run = m.group()[begin:end]
                if not all(re.search(p, run) for p in needs):
                    continue
                good = []
                for at in range(len(run) - width + 1):
                    part = run[at : at + width]
                    if -sum(part.count(c) / width * math.log2(part.count(c) / width) for c in set(part)) >= bits - 1e-9:
                        good.append(at)
                if good:
                    added.append((m.start() + begin + good[0], kind, m.start() + begin + good[-1] + width))
    added = [a for a in added if not any(b[0] <= a[0] and a[2] <= b[2] for b in base)]
    return sorted(base), sorted(base + added)


def redacted(text):
    if text is None:
        return None
    out, at = "", 0
    for s, _, e in secret_spans(text)[1]:
        if s >= at:
            out += text[at:s] + "[SECRET]"
        at = max(at, e)
    return out + text[at:]


def test_secrets(spark):
    draw = random.Random(3)
    make = lambda of, n: "".join(draw.choice(of) for _ in range(n))
    hexa, b64 = "0123456789abcdef", secrets.CLASSES["entropy_base64"][0]
    texts = [
        None,
        "",
        "token",
        "é😀 password: hunter22 API_key=\"abc.def=\" AKIA" + "Q" * 16 + " AKIA12 token=abc token = token=abcdef",
        make(b64, 300),
        "k=" + make(hexa, 41) + " " + make(hexa.upper(), 41),
        "a" * 40 + make(hexa + "ABCDEF", 50),
        "AbCdEfGhIj0123456789" * 4,
        "ToKeN:x" + make(b64, 40) + "\nSECRET = '" + make(b64, 20),
        "123e4567-e89b-12d3-a456-426614174000",
        "passwd=short",
        "a" * 100,
        make("ab1", 90)
    ]
    texts += [
        "/sample/config/" + make(b64, 40) + "/example",
        make(b64, 30) + "Example" + make(b64, 21) + "example" + make(b64, 25),
        make(b64, 22),
        make(hexa, 23) + "x token: " + make(b64, 60) + "é" + make(hexa, 30),
        "password=" + make(b64, 30) + " " + make(b64, 28)
    ]
    texts += [" ".join(draw.choice([
        "token=" + make(b64, 24),
        make(hexa, 26),
        make(b64, 24),
        "é" * draw.randint(1, 9),
        "AKIA" + make("ABC1", 16)
    ]) for _ in range(n)) for n in (7, 64, 65, 700)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(1, texts[3]), (None, texts[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names = [*secrets.BASE, *secrets.CLASSES]
    say = lambda spans: ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
    want = []
    for i, t in rows:
        base, every = secret_spans(t)
        want.append((i, *(sum(k == n for _, k, _ in base) for n in range(3)), hashlib.sha256(say(base).encode()).hexdigest(), say(every), len(every) - len(base)))
    assert told(secrets.scan(docs)) == sorted(want, key=repr)
    assert told(secrets.redact(docs)) == sorted(((i, redacted(t)) for i, t in rows), key=repr)


def test_secrets_edges(spark, clashing, empty):
    assert secrets.scan(empty).count() == 0
    names = ["found", "found_", "FOUND__", "base", "spans", "_hex", "_base", "f", "m", "x", "acc", *secrets.BASE, *secrets.CLASSES]
    docs = clashing.withColumns({c: F.lit(f"own {c}") for c in names})
    out = secrets.redact(docs)
    assert out.columns == docs.columns
    assert told(out.drop("text")) == told(docs.drop("text"))
    assert told(out.select("text")) == sorted(((redacted(r.text),) for r in docs.select("text").collect()), key=repr)


def test_secrets_in_linear_time(spark):
    """A candidate of a megabyte and 100,000 matches in one text."""
    draw = random.Random(8)
    long = "".join(draw.choices("GHIJKLMNOPQRSTUVWXYZghijklmnopqrstuvwxyz0123456789+/", k=1 << 20))
    many = " ".join(f"token=é{k} token=abcdef{k:06}" for k in range(100_000))
    began = time.time()
    got = told(secrets.scan(spark.createDataFrame([(1, long), (2, many)], "doc_id long, text string")))
    kind, first, last = got[0][5].split(":")
    assert kind == "entropy_base64" and int(first) < 50 and int(last) > len(long) - 50 and got[1][1] == 100_000
    out = told(secrets.redact(spark.createDataFrame([(1, long), (2, many)], "doc_id long, text string")))
    assert out[0][1] == long[: int(first)] + "[SECRET]" + long[int(last) :] and out[1][1] == " ".join(f"token=é{k} [SECRET]" for k in range(100_000))
    assert time.time() - began < 60


def license_row(doc_id, text, order):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = word.findall(lowered)
    places = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
    base = {label for _, label in places}
    found, best = set(), 0.0
    for line in lowered.split("\n"):
        own = word.findall(line)
        for s in range(0, max(1, len(own) - (licenses.BLOCK - licenses.STRIDE)), licenses.STRIDE):
            block = set(own[s : s + licenses.BLOCK])
            for label, texts in licenses.TEMPLATES.items():
                for t in texts:
                    share = len(set(t.split()) & block) / len(set(t.split()))
                    if share >= licenses.THRESHOLD - 1e-9:
                        found.add(label)
                        best = max(best, share)
    for label, texts in licenses.TEMPLATES.items():
        for t in texts:
            own, most = set(t.split()), len(t.split())
            shares = [len(own & set(words[s : s + most])) / len(own) for s in range(len(words)) if words[s] in own]
            if max(shares, default=0) >= licenses.THRESHOLD - 1e-9:
                found.add(label)
                best = max(best, *shares)
    at = [p for p, _ in places]
    return doc_id, len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | found)), best


def test_licenses(spark, rows):
    draw = random.Random(2)
    templates = [t for texts in licenses.TEMPLATES.values() for t in texts]
    more = []
    for k in range(60):
        words = draw.choice(templates).split()
        for _ in range(draw.randint(0, 5)):
            words[draw.randrange(len(words))] = draw.choice(["zzz", "the", "MIT", "license"])
        filler = ["word"] * draw.randint(0, 120)
        if k % 3 == 0:
            words = [w + draw.choice([" ", "\n", "\n# "]) for w in words]
        more.append((1000 + k, " ".join(filler + words) + draw.choice(["", "\n", ", "]) + "MIT License mit license; CC-BY"))
    every = [(r[0], r[1]) for r in rows] + more
    got = told(licenses.license_scan(spark.createDataFrame(every, "doc_id long, text string")))
    assert got == sorted((license_row(i, t, None) for i, t in every), key=repr)


def test_licenses_over_line_feeds(spark):
    notices = {
        "bsd": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:\n",
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\n",
        "lgpl": "# This library is free software; you can redistribute it and/or\r\n# modify it under the terms of the GNU Lesser General Public\r\n# License as published by the Free Software Foundation\r\n",
        "mpl": "rem This Source Code Form is subject to the terms of the Mozilla Public\nrem License, v. 2.0. If a copy of the MPL was not distributed\n",
    }
    texts = [before + notice + "some more words\n" * 30 for before in ("", "a line before\n" * 100) for notice in notices.values()]
    texts += ["\n".join(notice.split()) for notice in notices.values()] + ["word\n" * 90 + "released word\n" * 9 + "under\nthe word word word word\nlicense"]
    got = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k in range(12):
        assert [*notices][k % 4] in got[k].labels.split(",") and got[k].score >= licenses.THRESHOLD
    assert (got[12].labels, got[12].score) == ("", 0.0)
    for k, r in got.items():
        assert tuple(r) == license_row(k, texts[k], None)


def test_licenses_of_long_texts(spark):
    """A megabyte of whole licenses, wrapped and one after another, and of their rarest words alone."""
    mit = licenses.TEMPLATES["mit"][-1].split()
    lines = "\n".join(" ".join(mit[k : k + 11]) for k in range(0, len(mit), 11))
    texts = ["\n".join([lines] * 1000), "noninfringement sublicense merchantability\n" * 20_000, lines.replace("noninfringement", "x").replace("sublicense", "y")]
    began = time.time()
    got = told(licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert [r[6] for r in got] == ["mit", "", "mit"] and [r[7] for r in got][:2] == [1.0, 0.0] and got[2][7] > 0.9
    assert time.time() - began < 60


def test_licenses_edges(clashing, empty, rows):
    assert licenses.license_scan(empty).count() == 0
    assert told(licenses.license_scan(clashing)) == sorted((license_row(r[0], r[1], None) for r in rows), key=repr)
