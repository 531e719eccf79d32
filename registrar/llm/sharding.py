"""Shards by jump consistent hashing, with DataFrame functions only.

A key's shard follows from the key and the number of shards: the generator
``key -> key * M + 1 (mod 2**64)`` yields the shard counts at which the key
would move, and the last of them below the count is its shard. One more
shard takes only the rows that jump to it. No ring table is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrar.llm.common import saved

# Fixed value of the published algorithm: the generator's multiplier.
MULTIPLIER = 2862933555777941757
_LOW32 = 0xFFFFFFFF


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """``key * M + 1`` modulo 2**64 on 32-bit halves, no step above 2**63."""
    m_high, m_low = MULTIPLIER >> 32, MULTIPLIER & _LOW32
    m1, m0 = m_low >> 16, m_low & 0xFFFF
    middle = low * F.lit(m1)
    bottom = low * F.lit(m0) + F.shiftleft(middle.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    top = (F.shiftright(bottom, 32) + F.shiftright(middle, 16) + (low * F.lit(m_high)).bitwiseAND(F.lit(_LOW32))
           + high * F.lit(m0) + F.shiftleft((high * F.lit(m1)).bitwiseAND(F.lit(0xFFFF)), 16))
    return top.bitwiseAND(F.lit(_LOW32)), bottom.bitwiseAND(F.lit(_LOW32))


def jumps(key: Column, shards: int) -> Column:
    """Array of the shards a key passes through as the count grows to
    ``shards``; its last element is the key's shard. A null key acts as 0."""
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    start = F.struct(F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(F.lit(_LOW32)).alias("low"),
                     F.lit(0).cast("bigint").alias("next"), F.array().cast("array<int>").alias("passed"))

    def step(s: Column, _: Column) -> Column:
        high, low = _next(s["high"], s["low"])
        draw = F.shiftright(high, 1).cast("double") + F.lit(1.0)  # the generator's upper 31 bits, plus one
        after = F.floor((s["next"] + F.lit(1)).cast("double") * (F.lit(float(1 << 31)) / draw))
        moved = F.struct(high.alias("high"), low.alias("low"), after.alias("next"),
                         F.concat(s["passed"], F.array(s["next"].cast("int"))).alias("passed"))
        return F.when(s["next"] < F.lit(shards), moved).otherwise(s)

    # every step moves on by one shard at least, so ``shards`` steps suffice; most keys need a few
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)["passed"]


def shard(docs: DataFrame, shards: int) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): doc_id, size,
    text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 length of the text (null: 0) plus 8; ``text_crc32``
    of a null text is that of the empty one. A null doc_id acts as key 0;
    repeated rows share a shard and get slots of their own. ``slot`` counts
    from 0 without gaps within a shard, in the order of input splits, then
    doc_id. Other columns are ignored; an empty table gives an empty one.

    Slots come from one written table that notes each row's split: counts
    per (split, shard) give offsets, so no task holds more of a shard than
    one split of the input, however hot a shard or key.
    """
    both = jumps(F.col("doc_id"), shards + 1)
    text = F.coalesce("text", F.lit(""))
    rows = saved(docs.select("doc_id", (F.octet_length(text).cast("bigint") + 8).alias("size"),
                             F.crc32(text).alias("text_crc32"), both.alias("passed"),
                             F.spark_partition_id().alias("split"))
                 .withColumn("shard", F.array_max(F.filter("passed", lambda s: s < F.lit(shards))))
                 .withColumn("grown_shard", F.element_at("passed", -1)).drop("passed"), "shard-rows")
    before = Window.partitionBy("shard").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("split", "shard").count()
               .select("split", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")))
    within = Window.partitionBy("split", "shard").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("place", F.row_number().over(within)).join(offsets, ["split", "shard"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("offset") + F.col("place") - 1).alias("slot"), "grown_shard"))
