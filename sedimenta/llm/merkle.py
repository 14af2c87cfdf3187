"""A Merkle manifest of a dataset: a digest of each row, a root for each part and for all, and a proof for each row.

Rows become leaves, numbered within their part (the source) by dealing them into ranges of (part, doc_id), counting
these by part and numbering from the sums before. Aligned blocks of 16**3 leaves are traversed apart: the recursion
goes down to the leaves in postorder, returns each subtree's digest, and appends the siblings to the leaves that a
subtree holds while it unwinds. The blocks' roots are the leaves of the next, again distributed traversal, until a
part has one root; the parts' roots, in the order of their names, make a tree of their own by the same steps. On the way
down each block gets the siblings above its root, and every leaf its proof and the root that follows from it.

Defined results. Null fields are told from empty ones; null sources are a part of their own, the first. Leaves with
one doc_id are ordered by their digests; a null doc_id comes first and is never tampered with. Repeated rows are equal
leaves. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import materialize

WIDTH = 16
#: Levels of a block; it holds WIDTH ** LEVELS leaves.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_MANIFEST = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_UP = "part string, pos long, digest string"
_LEVEL = "array<struct<before:string,after:string>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[_field(fields[c]) for c in FIELDS]), 256)


def leaves(documents: DataFrame, every: int = 5) -> DataFrame:
    """(part, doc_id, leaf, changed): `changed` is the digest with the text's A-Z lower-cased, where the id is dealt out to be tampered with."""
    fields = {c: F.col(c) for c in FIELDS}
    tampered = F.crc32(F.col("doc_id").cast("string")) % every == 0
    changed = leaf_digest(fields | {"text": F.translate("text", _UPPER, _UPPER.lower())})
    # '-' sorts before '=': a null source comes first, the others by their bytes
    part = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    return documents.select(part.alias("part"), "doc_id", leaf_digest(fields).alias("leaf"), F.when(tampered, changed).alias("changed"))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows and pos (from 0 in each part, by `order`), n (rows of the part). Equal rows are dealt to several ranges too."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("spread", F.rand(1)).repartitionByRange(n, "part", *order, "spread").sortWithinPartitions("part", *order, "spread")
    # the row's number within its range is the lower half of this id
    at = F.monotonically_increasing_id()
    dealt = materialize(dealt.drop("spread").withColumns({"range": F.spark_partition_id(), "at": at}))
    before = Window.partitionBy("part").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy("part", "range").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    firsts = firsts.select("part", "range", (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    total = dealt.groupBy("part").agg(F.count("*").alias("n"))
    placed = firsts.join(total, "part")
    return dealt.join(placed, ["part", "range"]).select(*rows.columns, (F.col("at") + F.col("shift")).alias("pos"), "n")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def traverse(digests: list[str], levels: int, width: int = WIDTH) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root of a tree of `levels` levels over at most width ** levels digests, and for each of them the siblings before and after, level by level."""
    paths: list[list[tuple[str, str]]] = [[] for _ in digests]

    def visit(first: int, level: int) -> str:
        if not level:
            return digests[first]
        reach = width ** (level - 1)
        starts = range(first, min(first + reach * width, len(digests)), reach)
        below = [visit(s, level - 1) for s in starts]
        for k, s in enumerate(starts):
            siblings = "".join(below[:k]), "".join(below[k + 1 :])
            for path in paths[s : s + reach]:
                path.append(siblings)
        return sha("".join(below))

    return visit(0, levels), paths


def levels_of(n: int, width: int = WIDTH, most: int = LEVELS) -> int:
    """Levels of a block of a part with n leaves: all if it has several blocks, else those that leave one node."""
    levels = 0
    while levels < most and width**levels < n:
        levels += 1
    return levels


def _rows(batches, *names: str):
    """The values of each row by themselves: a row is a whole block."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield [batch.column(c)[k].as_py() for c in names]


def _up(width: int, most: int):
    def up(batches):
        for part, block, held, n in _rows(batches, "part", "block", "held", "n"):
            root, _ = traverse([x["digest"] for x in held], levels_of(n, width, most), width)
            yield pa.RecordBatch.from_pydict({"part": [part], "pos": [block], "digest": [root]})

    return up


def _down(width: int, most: int):
    """The siblings of each node of a block, its own and then those above the block."""

    def down(batches):
        for part, held, n, above, subroot, root in _rows(batches, "part", "held", "n", "above", "subroot", "root"):
            _, paths = traverse([x["digest"] for x in held], levels_of(n, width, most), width)
            for x, path in zip(held, paths, strict=True):
                siblings = [*[{"before": a, "after": b} for a, b in path], *above]
                node = {"part": part, "pos": x["pos"], "digest": x["digest"], "above": siblings, "subroot": subroot, "root": root}
                yield pa.RecordBatch.from_pylist([node], schema=_NODE)

    return down


_NODE = pa.schema(
    [
        ("part", pa.string()),
        ("pos", pa.int64()),
        ("digest", pa.string()),
        ("above", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))),
        ("subroot", pa.string()),
        ("root", pa.string()),
    ]
)
_DOWN = f"part string, pos long, digest string, above {_LEVEL}, subroot string, root string"


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    for before, after in path:
        leaf = sha(before + leaf + after)
    return leaf


def _proofs(width: int, most: int):
    def prove(batches):
        for held, n, above, subroot, root in _rows(batches, "held", "n", "above", "subroot", "root"):
            _, paths = traverse([x["digest"] for x in held], levels_of(n, width, most), width)
            above = [(x["before"], x["after"]) for x in above]
            rest = "".join(a + b for a, b in above)
            folded = [fold(x["changed"] or x["digest"], [*path, *above]) for x, path in zip(held, paths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x["doc_id"] for x in held], pa.int64()),
                    pa.array([x["digest"] for x in held], pa.string()),
                    pa.array([subroot] * len(held), pa.string()),
                    pa.array([root] * len(held), pa.string()),
                    pa.array([sha("".join(a + b for a, b in path) + rest) for path in paths], pa.string()),
                    pa.array(folded, pa.string()),
                    pa.array([f == root for f in folded], pa.bool_()),
                ],
                names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    return prove


def blocks(nodes: DataFrame, size: int) -> DataFrame:
    """(part, block, n, held): runs of `size` nodes of a part, in order. nodes: part, pos, n, digest and more."""
    held = F.struct("pos", *[c for c in nodes.columns if c not in ("part", "pos", "n")])
    grouped = nodes.withColumn("block", F.expr(f"pos div {size}")).groupBy("part", "block")
    return materialize(grouped.agg(F.max("n").alias("n"), F.array_sort(F.collect_list(held)).alias("held")))


def _raised(first: DataFrame, size: int, width: int, most: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all rounds above `first`, and the roots of the parts: (part, digest)."""
    rounds = [first]
    while True:
        roots = materialize(rounds[-1].select("part", "block", "n", "held").mapInArrow(_up(width, most), _UP))
        if not roots.where("pos > 0").limit(1).count():  # each part has one root
            return rounds, roots.select("part", "digest")
        total = roots.groupBy("part").agg(F.count("*").alias("n"))
        rounds.append(blocks(roots.join(total, "part"), size))


def _below(rounds: list[DataFrame], top: DataFrame, width: int, most: int) -> DataFrame:
    """The blocks of the first round with `above`, `subroot` and `root`; top: these for each part's root."""
    known = top.withColumn("block", F.lit(0).cast("long"))
    for held in reversed(rounds[1:]):
        nodes = held.join(known, ["part", "block"]).mapInArrow(_down(width, most), _DOWN)
        known = materialize(nodes.select("part", F.col("pos").alias("block"), "above", "subroot", "root"))
    return rounds[0].join(known, ["part", "block"])


def manifest(documents: DataFrame, width: int = WIDTH, levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root (of the tampered row, where it is), verified."""
    size = width**levels
    spark = documents.sparkSession
    rows = materialize(leaves(documents))
    placed = numbered(rows, "doc_id", "leaf").select("part", "pos", "n", F.col("leaf").alias("digest"), "doc_id", "changed")
    rounds, subroots = _raised(blocks(placed, size), size, width, levels)
    # the tree over the parts: its one part is '', its leaves are the parts in their order
    names = numbered(subroots.select(F.lit("").alias("part"), F.col("part").alias("name"), "digest"), "name")
    names = materialize(names)
    tops, roots = _raised(blocks(names.select("part", "pos", "n", "digest"), size), size, width, levels)
    root = roots.first()
    if root is None:
        return spark.createDataFrame([], _MANIFEST)
    start = F.array().cast(_LEVEL)
    top = roots.select("part", start.alias("above"), F.lit(None).cast("string").alias("subroot"), F.lit(root["digest"]).alias("root"))
    nodes = _below(tops, top, width, levels).mapInArrow(_down(width, levels), _DOWN)
    known = nodes.drop("part").join(names.select("pos", F.col("name").alias("part")), "pos")
    known = materialize(known.select("part", "above", F.col("digest").alias("subroot"), "root"))
    return _below(rounds, known, width, levels).mapInArrow(_proofs(width, levels), _MANIFEST)
