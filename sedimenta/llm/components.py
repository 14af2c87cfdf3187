"""Connected components of undirected edges by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import fresh, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root): each node that has an edge, with the smallest node that it reaches. Null ends are ignored.

    Each round writes its edges to the shared folder; the last one is that which leaves stars. Nodes with many edges: their
    minimum is pre-aggregated before the shuffle and written, so that the join that hands it out is one of two plain
    shuffles, which Spark splits where it is skewed.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    now = materialize(now)
    for _ in range(rounds):
        # large star: each node's larger neighbours go to its smallest neighbour
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # small star: each node and its smaller neighbours go to the smallest of them
        large = materialize(large)
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        joined = large.join(least, "u")
        now = joined.select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e"))
        now = materialize(now.select("e.u", "e.v").where("u > v").distinct())
        # stars: no node has two smaller neighbours, or a smaller and a larger one
        ends = now.select(
            F.col("u").alias("node"),
            F.lit(1).alias("up"),
            F.lit(0).alias("down")
        ).unionByName(now.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        degrees = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if degrees.where("up > 1 OR up = 1 AND down = 1").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def dealt(keyed: DataFrame, keys: list[str], by: str, block: int, counts: DataFrame | None = None) -> DataFrame:
    """Rows of keyed whose key stands more than once, each with (i, j): a key of over `block` rows is dealt out in pairs of blocks.

    counts: (key, count) of those keys, where they are known.
    """
    if counts is None:
        counts = materialize(keyed.groupBy(*keys).count().where("count > 1"))
    shared = counts.select(*keys, F.ceil(F.col("count") / block).cast("int").alias("n"))
    split = keyed.join(shared, keys).withColumn("p", F.pmod(F.xxhash64(by), F.col("n")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda x: F.struct(F.least(x, "p").alias("i"), F.greatest(x, "p").alias("j")))
    return split.select(*keyed.columns, F.explode(pairs).alias("b")).select(*keyed.columns, "b.i", "b.j")


def heads(rows: DataFrame, smallest: DataFrame) -> DataFrame:
    """(doc_id, digest, n): each group's head, of smallest.head, with its number of rows among (doc_id, digest); written."""
    own = smallest.where("head is not null").select("head.doc_id", "head.digest")
    return materialize(rows.select("doc_id", "digest").join(own, ["doc_id", "digest"]).groupBy("doc_id", "digest").agg(F.count("*").alias("n")))


def keep_heads(documents: DataFrame, heads: DataFrame) -> DataFrame:
    """The documents, with all their columns, that are (doc_id, digest) of a head, and those without a doc_id.

    Of rows that repeat a head's doc_id and text, the one with the least hash of all columns stays.
    """
    digest, n = fresh(documents, "digest"), fresh(documents, "n")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    named = heads.select("doc_id", F.col("digest").alias(digest), F.col("n").alias(n))
    stays = documents.withColumn(digest, F.xxhash64("text")).join(named, ["doc_id", digest])
    out = stays.where(F.col(n) == 1).select(*columns)
    if not heads.where("n > 1").isEmpty():
        row = F.struct(*columns)
        first = stays.where(F.col(n) > 1).groupBy("doc_id", digest).agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("row"))
        out = out.unionByName(first.select("row.*"))
    return out.unionByName(documents.where("doc_id is null"))
