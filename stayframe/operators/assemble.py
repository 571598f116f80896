"""Feature assembly (A1-A4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.session import materialize, packed_partitions

ID_COLUMNS = ["subject_id", "admission_id"]


def common_keys(left: DataFrame, right: DataFrame) -> list[str]:
    """A1: join on whichever ids both sides carry; none -> error."""
    keys = [k for k in ID_COLUMNS if k in left.columns and k in right.columns]
    if not keys:
        raise ValueError("no common id column between feature blocks")
    return keys


def enforce_id_types(df: DataFrame) -> DataFrame:
    """A4: ids as bigint."""
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in ID_COLUMNS else F.col(f"`{c}`")
                       for c in df.columns])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """A3: keys that occur more than once (partial aggregation)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    bad = duplicate_keys(df, keys).limit(1).collect()
    if bad:
        raise ValueError(f"duplicate key {[bad[0][k] for k in keys]}")
    return df


def _assert_one_to_one(blocks: list[DataFrame]) -> None:
    """A3 for every block at once: keys as text, tagged by block."""
    keyed = [enforce_id_types(b).select(F.lit(k).alias("block"), F.concat_ws(",", *[
        F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ID_COLUMNS if c in b.columns]).alias("key"))
        for k, b in enumerate(blocks)]
    bad = duplicate_keys(reduce(DataFrame.unionByName, keyed), ["block", "key"]).limit(1).collect()
    if bad:
        raise ValueError(f"feature block {bad[0]['block']} has key {bad[0]['key']} {bad[0]['n']} times")


def staged_blocks(blocks: list[DataFrame], partitions: int | None = None, least: int = 1) -> list[DataFrame]:
    """The blocks with their id types enforced, each written once (reliable
    checkpoint) and then dealt by subject and written so, all to one number of
    partitions: what their size asks for, ``least`` at least and else the
    shuffle partitions at most. The
    blocks themselves run under adaptive execution; the dealing of their one
    row a subject does not, as only a fixed plan lets later joins know how the
    rows lie."""
    spark = blocks[0].sparkSession
    rows = [materialize(enforce_id_types(b)) for b in blocks]
    n = partitions or max(least, min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                     packed_partitions(sum(r.count() * len(r.columns) for r in rows))))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return [materialize(r.repartition(n, "subject_id")) for r in rows]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def assemble_features(blocks: list[DataFrame], label: DataFrame | None = None) -> DataFrame:
    """A2: inner one-to-one joins of the chosen blocks, label joined last. A
    key that a block has twice is an error: one aggregate over the keys of
    all blocks looks for it before anything is joined.

    Every block runs once: it is staged by subject, the check reads the staged
    rows, and the joins need no further exchange, as all blocks are dealt by
    the same key to as many partitions. A second common key (the admission)
    is compared beside the join, so that it asks for no other dealing."""
    if not blocks:
        raise ValueError("no feature block chosen")
    # Spark deals single partitions again before a third block
    staged = staged_blocks([*blocks, *([label] if label is not None else [])], least=2)
    _assert_one_to_one(staged)
    out = staged[0]
    for b in staged[1:]:
        more = [c for c in common_keys(out, b) if c != "subject_id"]
        met = out.join(b.withColumnsRenamed({c: f"__{c}" for c in more}), "subject_id")
        for c in more:
            met = met.where(F.col(c) - F.col(f"__{c}") == 0).drop(f"__{c}")
        out = met
    return out
