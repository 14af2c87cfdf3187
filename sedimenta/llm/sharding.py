"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in built-in functions only.

The law is `key`: doc_id and the number of shards decide; with one more shard a row stays or moves into the new one.
The 64-bit generator state is kept in two 32-bit halves and multiplied by 16-bit limbs, as Spark's integers don't wrap
around. Slots: rows are dealt into ranges of doc_id, counted by shard within each range, and numbered from the sums of
the ranges before; no shard has to pass through one task.

Defined results. Null doc_id: the key 0. Null text: as empty, size 1. Repeated rows each get a slot of their own; ties
in doc_id are ordered by text_crc32, then size. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import fresh, materialize

#: Fixed values of the published generator: multiplier 2862933555777941757, split into 32-bit halves.
_HIGH, _LOW = 2862933555777941757 >> 32, 2862933555777941757 & 0xFFFFFFFF
_M32, _M16 = 0xFFFFFFFF, 0xFFFF
#: Steps that a walk is given. It takes about ln(shards), so that more than this never happen; if they did, it is an error.
_STEPS = 256


def _and(x: Column, mask: int) -> Column:
    return x.bitwiseAND(F.lit(mask).cast("long"))


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """The halves of state * multiplier + 1 modulo 2**64."""
    c_low, c_high = F.lit(_LOW).cast("long"), F.lit(_HIGH).cast("long")
    p0 = _and(low, _M16) * c_low + 1
    p1 = F.shiftright(low, 16) * c_low
    total = _and(p0, _M32) + F.shiftleft(_and(p1, _M16), 16)
    carry = F.shiftright(p0, 32) + F.shiftright(p1, 16) + F.shiftright(total, 32)
    cross = _and(low * c_high, _M32)
    upper = _and(high, _M16) * c_low + F.shiftleft(_and(F.shiftright(high, 16) * c_low, _M16), 16)
    return _and(carry + cross + _and(upper, _M32), _M32), _and(total, _M32)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard (int) of a 64-bit key among `shards`."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    key = key.cast("long")
    zero = F.struct(
        _and(F.shiftrightunsigned(key, 32), _M32).alias("h"),
        _and(key, _M32).alias("l"),
        F.lit(-1).cast("long").alias("b"),
        F.lit(0).cast("long").alias("j")
    )

    def step(s: Column, _: Column) -> Column:
        high, low = _next(s["h"], s["l"])
        jump = F.floor((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double"))).cast("long")
        moved = F.struct(high.alias("h"), low.alias("l"), s["j"].alias("b"), jump.alias("j"))
        return F.when(s["j"] < shards, moved).otherwise(s)

    steps = F.sequence(F.lit(1), F.lit(min(shards + 1, _STEPS)))
    lost = F.raise_error(F.lit(f"a walk over {shards} shards takes more than {_STEPS} steps")).cast("int")
    return F.aggregate(steps, zero, step, lambda s: F.when(s["j"] < shards, lost).otherwise(s["b"].cast("int")))


def shard(documents: DataFrame, shards: int = 8, ranges: int | None = None) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot (from 0 without gaps in each shard, by doc_id), grown_shard (with one shard more)."""
    key = F.coalesce("doc_id", F.lit(0).cast("long"))
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    order = ["doc_id", "text_crc32", "size"]
    n = ranges or int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = fresh(rows, "spread")  # equal rows are dealt to several ranges too; which of them gets which slot makes no difference
    dealt = rows.withColumn(spread, F.rand(1)).repartitionByRange(n, *order, spread).drop(spread).withColumn("range", F.spark_partition_id())
    dealt = materialize(dealt.withColumns({"shard": jump_hash(key, shards), "grown_shard": jump_hash(key, shards + 1)}))
    counts = dealt.groupBy("shard", "range").count()
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "range").orderBy(*order)
    numbered = dealt.withColumn("n", F.row_number().over(within) - 1).join(offsets, ["shard", "range"])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("n") + F.col("offset")).cast("long").alias("slot"),
        "grown_shard"
    )
