"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and read back as the next stage's documents. All but the last return
the columns of the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import mixing, packing, quality_rules, simhash, suffix_dedup
from stayframe.llm.common import quoted, stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.judge(docs).filter("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash near-duplicate group."""
    return simhash.keep_one(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the bytes that a smaller doc_id already has; a
    character that lost some of its bytes goes whole. A null text becomes
    empty, and n_chars the length of what is left."""
    found = suffix_dedup.with_text(suffix_dedup.remove_repeats(docs, [c for c in docs.columns if c != "text"]))
    text = F.col("kept_text")
    return found.select(*[text.alias("text") if c == "text" else F.length(text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
                          else F.col(f"row.{quoted(c)}") for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn to the target weights, none more than once."""
    return mixing.draw(mixing.mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), max_rate=mixing.ONCE))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    return packing.pack_documents(docs).withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


STAGES = [("quality rules", quality), ("SimHash near-dedup", near_dedup), ("suffix-array dedup", suffix_dedup_stage),
          ("mixing to target weights", mixing_stage), ("best-fit packing", pack)]

#: No SQL: stages hash, sort suffixes, fit models and tokenize; tests/llm holds the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{k}")
    return docs
