"""The queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (attention_lm, bitplane, byte_bpe, jump_shard, mixing, packing, prefix_trie, quality_mil, quality_rules, simhash, suffix_dedup, vector_codes,
               weighted_sampling)
from .common import documents, stage
from .sql import SQL  # noqa: F401  (the entry point reads both)


def op1_attention_mil(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return quality_mil.score(docs, quality_mil.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op2_soft_mixing(spark, sf_dir):
    mixed = mixing.mix(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixed.select("row.doc_id", "tokens", *[f"p_{d}" for d in mixing.DOMAINS], "rate", "copies")


def op3_jump_shard(spark, sf_dir):
    return jump_shard.shard_documents(documents(spark, sf_dir), 8)


def op4_weighted_sampling(spark, sf_dir):
    return weighted_sampling.fingerprint_documents(documents(spark, sf_dir))


def op5_simhash_pivots(spark, sf_dir):
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_suffix_repeats(spark, sf_dir):
    found = suffix_dedup.remove_repeats(documents(spark, sf_dir), ["doc_id"])
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_adaptive_rules(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "lang", "source", "text")
    judged = quality_rules.judge(docs, keep=["doc_id"])
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_attention_lm(spark, sf_dir):
    return attention_lm.score_documents(documents(spark, sf_dir))


def op9_best_fit_packing(spark, sf_dir):
    packed = packing.pack_documents(documents(spark, sf_dir))
    return packed.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op10_bitplane_ids(spark, sf_dir):
    docs = documents(spark, sf_dir)
    folder = bitplane.ids_folder(docs)
    read = bitplane.read_ids(bitplane.write_ids(docs, folder), folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_nodes(prefix_trie.conversations(spark, sf_dir))


def op12_byte_bpe(spark, sf_dir):
    decoded = byte_bpe.decode_documents(byte_bpe.encode_documents(documents(spark, sf_dir)))
    return decoded.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_vector_codes(spark, sf_dir):
    coded, books = vector_codes.compress(vector_codes.embeddings(spark, sf_dir))
    rows = stage(coded.select("row.vec_id", "row.label", F.lower(F.hex("codes")).alias("code"), "error"), "codes")
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    return rows.join(by_label, rows["label"].eqNullSafe(by_label["label"])).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (op1_attention_mil, op2_soft_mixing, op3_jump_shard, op4_weighted_sampling, op5_simhash_pivots, op6_suffix_repeats, op7_adaptive_rules, op8_attention_lm, op9_best_fit_packing, op10_bitplane_ids,
                              op11_prefix_trie, op12_byte_bpe, op13_vector_codes)}
