"""Isotonic regression by pool-adjacent-violators on sorted ranges.

A stack of blocks (lowest score, highest score, sum of labels, weight) with
rising means merges with the stack of the next range by pooling at their
border, and the result does not depend on how the ranges were cut. So every
range pools its own scores, then groups of neighbouring stacks meet, level by
level, in tasks. With 0/1 labels of n rows the block borders are vertices of
a convex chain on whole numbers: there are O(n^(2/3)) of them at most.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.session import materialize

#: Neighbouring stacks that one task merges.
FAN_IN = 64
_BLOCK = "part long, lo double, hi double, total double, weight double"


def push(stack: list[list], block: list) -> None:
    """Put a block on a stack and pool while the means do not rise."""
    while stack and stack[-1][2] * block[3] >= block[2] * stack[-1][3]:
        lo, _, total, weight = stack.pop()
        block = [lo, block[1], total + block[2], weight + block[3]]
    stack.append(block)


def _pool(batches):
    part, stack = None, []
    for batch in batches:
        for now, *block in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if now != part:
                yield from _out(part, stack)
                part, stack = now, []
            push(stack, block)
    yield from _out(part, stack)


def _out(part, stack):
    for k in range(0, len(stack), 4096):
        rows = stack[k:k + 4096]
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.int64()), *[pa.array(c, pa.float64()) for c in zip(*rows)]],
                                         names=["part", "lo", "hi", "total", "weight"])


def pooled_blocks(scored: DataFrame, score: str, label: str, parts: int | None = None) -> DataFrame:
    """(lo, hi, value, weight): the blocks of the isotonic fit of ``label`` on
    ``score``, rows with a null in either left out. Equal scores are one point."""
    parts = parts or int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = scored.select(F.col(score).cast("double").alias("lo"), F.col(label).cast("double").alias("y")).where("lo IS NOT NULL AND y IS NOT NULL")
    points = materialize(x.groupBy("lo").agg(F.sum("y").alias("total"), F.count(F.lit(1)).cast("double").alias("weight")))
    sorted_ = points.repartitionByRange(parts, "lo").sortWithinPartitions("lo")
    rows = sorted_.select(F.spark_partition_id().cast("long").alias("part"), "lo", F.col("lo").alias("hi"), "total", "weight")
    blocks, n = materialize(rows.mapInArrow(_pool, _BLOCK)), parts
    while n > 1:
        n = -(-n // FAN_IN)
        met = blocks.withColumn("part", F.floor(F.col("part") / FAN_IN)).repartition(F.col("part")).sortWithinPartitions("part", "lo")
        blocks = materialize(met.mapInArrow(_pool, _BLOCK))
    return blocks.select("lo", "hi", (F.col("total") / F.col("weight")).alias("value"), "weight")
