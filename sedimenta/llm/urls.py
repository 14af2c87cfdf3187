"""URL filters: a blocked Bloom filter of listed canonical URLs, and an exact join of what it lets through.

A listed URL is a host and the beginning of a path; it fits its host, all subdomains, and every path that begins so.
From a URL come its keys: each suffix of the host at a dot, with each beginning of the path whose length stands in the
list. The filter holds blocks of eight 64-bit words; a key's hash names a block and one bit in each word. It is built
by an aggregate (bit_or), has a bounded size whatever the list's (a list too long for it lets more keys through, never
fewer), and is broadcast. Only keys that it lets through are joined with the list itself, which removes false
positives: by broadcast up to a size that is checked, beyond it by a shuffle whose keys are salted.
Of the listed URLs that fit, a rule goes before an entry of the block list, then the longest counts. Built-in functions only.

Defined results. Null URLs and those without '://': host and path empty, no rule, allowed, unless the list says
otherwise. Hosts are compared as they stand, ports and user names included, but for A-Z in lower case. Repeated pages
each get a row. Equal lengths: the longer host counts. An empty list allows everything; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules of the registered query: (host and path, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Its block list: sites of advertisement, gambling, medicine and adult content below the reserved example domains.
SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
DOMAINS = ("example.com", "example.net", "example.org")

WORDS = 8
#: Most blocks of 64 bytes that a filter has: 8 MB.
MOST_BLOCKS = 1 << 17
KEYS_A_BLOCK = 32
#: A list of at most so many characters is broadcast.
BROADCAST = 16 << 20
SALTS = 16
_OWN = "\n\n"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host(url: Column) -> Column:
    """What stands after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; empty without it."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _UPPER.lower())


def path(url: Column) -> Column:
    """What follows the host up to '?', '#' or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rules(spark: SparkSession, ruled=RULES, blocked=None) -> DataFrame:
    """(listed, verdict, ruled): rules, and entries of a block list, which stands behind every rule."""
    blocked = [f"{s}.{d}/" for s in SITES for d in DOMAINS] if blocked is None else blocked
    rows = [(u, v, True) for u, v in ruled] + [(u, "block", False) for u in blocked]
    entries = F.array(*[F.struct(F.lit(u).alias("listed"), F.lit(v).alias("verdict"), F.lit(r).alias("ruled")) for u, v, r in rows])
    return spark.range(1).select(F.inline(entries.cast("array<struct<listed:string,verdict:string,ruled:boolean>>")))


def _split(listed: Column) -> tuple[Column, Column]:
    """Host and path of a listed URL: 'host/path'."""
    name = F.regexp_extract(listed, r"(?s)^([^/]*)", 1)
    return F.translate(name, _UPPER, _UPPER.lower()), F.substring(listed, F.length(name) + 1, F.length(listed))


def canonical(listed: DataFrame) -> DataFrame:
    """(key, labels, wide, reach, ruled, listed, verdict): each key once for rules and once for the block list; of several verdicts 'allow' counts."""
    name, rest = _split(F.col("listed"))
    rows = listed.where("listed is not null").select(
        F.concat(name, F.lit("\n"), rest).alias("key"),
        F.size(F.split(name, r"\.")).alias("labels"),
        F.length(name).alias("wide"),
        F.length(rest).alias("reach"),
        "ruled",
        "verdict",
        F.concat(name, rest).alias("listed")
    )
    return rows.groupBy("key", "labels", "wide", "reach", "ruled", "listed").agg(F.min("verdict").alias("verdict"))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bit(word: int) -> Column:
    """The bit of a key in a word of its block, from its second hash `h`."""
    return F.shiftrightunsigned("h", 6 * word).bitwiseAND(F.lit(63).cast("long")).cast("int")


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0, w1, ...): a blocked Bloom filter of `key`; blocks without a key have no row."""
    bits = keys.select(_block(F.col("key"), blocks).alias("block"), F.xxhash64("key", F.lit(1)).alias("h"))
    one = F.lit(1).cast("long")
    words = [F.bit_or(F.call_function("shiftleft", one, _bit(w))).alias(f"w{w}") for w in range(WORDS)]
    return bits.groupBy("block").agg(*words)


def passes() -> Column:
    """Whether the block (w0, w1, ...) may hold the key with the second hash `h`."""
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftrightunsigned", F.col(f"w{w}"), _bit(w)).bitwiseAND(one) == one for w in range(WORDS)]
    return reduce(lambda a, b: a & b, bits)


def keys_of(name: Column, rest: Column, labels: int, reaches: list[int]) -> Column:
    """Suffixes of the host, of at most `labels` parts, each with each beginning of the path of a listed length."""
    parts = F.split(name, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))), lambda k: F.array_join(F.slice(parts, -k, k), "."))
    lengths = F.filter(F.array(*[F.lit(r) for r in reaches]).cast("array<int>"), lambda n: n <= F.length(rest))
    starts = F.transform(lengths, lambda n: F.substring(rest, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, F.lit("\n"), p))))


def verdicts(pages: DataFrame, listed: DataFrame, default: str = "allow", most_blocks: int = MOST_BLOCKS, broadcast: int = BROADCAST) -> DataFrame:
    """Per page: page_id, host, path, rule (that decides; null without one), verdict, listed (the entry of the block list, if that decides).

    listed: (listed, verdict, ruled), see rules().
    """
    known = canonical(listed)
    told = known.agg(
        F.count("*").alias("n"),
        F.coalesce(F.max("labels"), F.lit(1)).alias("labels"),
        F.sum(F.length("listed") + 32).alias("size"),
        F.array_sort(F.collect_set("reach")).alias("reaches"),  # as many as a path has lengths
    ).first()
    blocks = min(most_blocks, max(1, -(-told["n"] // KEYS_A_BLOCK)))
    rows = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    # a page's own row, which no filter drops: no key begins so, as a path is empty or begins with '/'
    own = F.concat(F.lit(_OWN), F.xxhash64("page_id", "url").cast("string"))
    keys = keys_of(F.col("host"), F.col("path"), told["labels"], told["reaches"])
    each = rows.select("page_id", "url", "host", "path", F.explode(F.array_append(keys, own)).alias("key"))
    each = each.withColumns({"block": _block(F.col("key"), blocks), "h": F.xxhash64("key", F.lit(1)), "own": F.col("key").startswith(_OWN)})
    possible = each.join(F.broadcast(bloom(known, blocks)), "block", "left").where(F.col("own") | passes())
    possible = possible.select("page_id", "url", "host", "path", "key", "own")
    rank = F.struct("ruled", F.length("listed").alias("long"), "wide", "listed", "verdict")
    exact = known.select("key", rank.alias("rank"))
    if (told["size"] or 0) <= broadcast:
        joined = possible.join(F.broadcast(exact), "key", "left")
    else:
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
        spread = exact.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = possible.withColumn("salt", salt).join(spread, ["key", "salt"], "left")
    # a page's rows meet again by page and URL; those of repeated pages meet too and are told apart by their number
    best = joined.groupBy("page_id", "url", "host", "path").agg(F.max("rank").alias("rank"), F.count_if("own").alias("rows"))
    ruled = F.coalesce("rank.ruled", F.lit(False))
    return best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).select(
        "page_id",
        "host",
        "path",
        F.when(ruled, F.col("rank.listed")).alias("rule"),
        F.coalesce("rank.verdict", F.lit(default)).alias("verdict"),
        F.when(~ruled, F.col("rank.listed")).alias("listed"),
    )


def keep_allowed(pages: DataFrame, listed: DataFrame, url: str = "url") -> DataFrame:
    """The pages whose URL is not blocked, with all their columns. URLs are judged once each."""
    named = pages.select(F.col(url).alias("url")).where("url is not null").distinct()
    judged = verdicts(named.withColumn("page_id", F.col("url")), listed)
    blocked = judged.where("verdict = 'block'").select(F.col("page_id").alias("_blocked"))
    return pages.join(blocked, F.col(url) == F.col("_blocked"), "left_anti")
