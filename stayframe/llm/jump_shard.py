"""Sharding by jump consistent hashing, with DataFrame functions only.

The published generator multiplies a 64-bit state modulo 2^64; here the
state is held as two 32-bit halves so that no product leaves a long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import stage

#: Fixed value: the multiplier of the published jump consistent hash.
MULTIPLIER = 2862933555777941757
#: Steps that every row takes; rows that need more (shard counts beyond it) go on.
FIRST_STEPS = 48
#: Rows of a shard that are numbered in one window.
ROWS_PER_BLOCK = 1 << 16

_LOW32 = (1 << 32) - 1


def _low(x: Column, bits: int) -> Column:
    return x.bitwiseAND(F.lit((1 << bits) - 1))


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """state * MULTIPLIER + 1 modulo 2^64, in halves of 32 bits."""
    m0, m1 = MULTIPLIER & 0xFFFF, MULTIPLIER >> 16 & 0xFFFF
    m2, m3 = MULTIPLIER >> 32 & 0xFFFF, MULTIPLIER >> 48
    p = low * F.lit(m1)
    low_sum = low * F.lit(m0) + F.shiftleft(_low(p, 16), 16) + F.lit(1)
    high_sum = (F.shiftright(low_sum, 32) + F.shiftright(p, 16)
                + low * F.lit(m2) + F.shiftleft(_low(low * F.lit(m3), 16), 16)
                + high * F.lit(m0) + F.shiftleft(_low(high * F.lit(m1), 16), 16))
    return _low(high_sum, 32), _low(low_sum, 32)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard (0 to shards - 1) of a long key; a null key counts as 0."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))

    def state(high, low, shard, jump):
        return F.struct(high.alias("high"), low.alias("low"), shard.alias("shard"), jump.alias("jump"))

    def step(s, _):
        high, low = _next_state(s["high"], s["low"])
        moved = F.transform(F.array(F.struct(high.alias("h"), low.alias("l"))), lambda x: state(
            x["h"], x["l"], s["jump"],
            F.floor((s["jump"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(x["h"], 1) + 1).cast("double")))))
        return F.when(s["jump"] < F.lit(shards), moved[0]).otherwise(s)

    start = state(_low(F.shiftright(key, 32), 32), _low(key, 32), F.lit(-1).cast("long"), F.lit(0).cast("long"))
    n = min(shards, FIRST_STEPS)
    done = F.aggregate(F.sequence(F.lit(1), F.lit(n)), start, step)
    if shards > FIRST_STEPS:  # a jump goes at least one shard further, so no key needs more than ``shards`` steps
        done = F.transform(F.array(done), lambda s: F.when(
            s["jump"] < F.lit(shards), F.aggregate(F.sequence(F.lit(n + 1), F.lit(shards)), s, step)).otherwise(s))[0]
    return done["shard"].cast("int")


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
                    rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Deal rows into ``shards`` by the ``key`` law: key and shard count
    decide, and one more shard takes rows only into itself.

    Returns the key (long), size (UTF-8 bytes of the text and 1), text_crc32,
    law, shard, slot (the row's place in its shard, gapless from 0, in the
    order of the MD5 of the key) and grown_shard (with one shard more).
    A null key counts as 0 but stays null; a null text has no bytes; repeated
    rows get a slot each; an empty table gives no rows; other columns are not
    read. Slots are numbered within blocks of a shard and joined to the sums
    of the blocks before, so no task holds a whole shard.
    """
    keyed = docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    crc = F.crc32(F.col("text").cast("binary"))
    dealt = stage(keyed.select(
        key, (F.octet_length("text") + 1).cast("long").alias("size"), crc.alias("text_crc32"),
        jump_hash(F.col(key), shards).alias("shard"), jump_hash(F.col(key), shards + 1).alias("grown_shard"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.concat(F.lit("null:"), crc.cast("string"))).cast("binary")).alias("order"),
    ), "shards")
    bits = max(0, (dealt.count() // (shards * rows_per_block)).bit_length())
    block = F.shiftright(F.conv(F.substring("order", 1, 8), 16, 10).cast("long"), 32 - bits) if bits else F.lit(0).cast("long")
    dealt = dealt.withColumn("block", block)
    before = (dealt.groupBy("shard", "block").agg(F.count("*").alias("rows"))
              .select("shard", "block", (F.sum("rows").over(Window.partitionBy("shard").orderBy("block")) - F.col("rows")).alias("before")))
    place = Window.partitionBy("shard", "block").orderBy("order", key, "text_crc32", "size")
    return (dealt.withColumn("place", F.row_number().over(place)).join(before, ["shard", "block"])
            .select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("before") + F.col("place") - 1).cast("long").alias("slot"), "grown_shard"))
