"""The pipeline against its operators' rules, stage by stage."""

import collections

import corpus_pipeline
from stayframe.llm import mixing, packing, quality_rules, simhash, suffix_dedup


def test_stages_keep_the_columns_and_take_effect(spark, docs, labels, tmp_path):
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    labels.write.parquet(f"{sf}/labels.parquet")
    now, sizes = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, sf)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns, name
            if name == "quality rules":
                kept = collections.Counter(r.row.doc_id for r in quality_rules.judge(now).filter("kept").collect())
                assert kept == collections.Counter(r.doc_id for r in out.collect())
            if name == "SimHash near-dedup":
                classes = {r["class"] for r in simhash.near_duplicates(now).collect()}
                assert out.count() == len(classes)
            if name == "suffix-array dedup":
                kept = collections.Counter((r.row.doc_id, bytes(r.kept).decode("utf-8", "ignore")) for r in suffix_dedup.remove_repeats(now, ["doc_id"]).collect())
                assert kept == collections.Counter((r.doc_id, r.text) for r in out.collect())
                assert all(r.n_chars == len(r.text) for r in out.collect())
            if name == "mixing to target weights":
                assert out.count() == sum(r.copies for r in mixing.mix(now, labels, max_rate=mixing.ONCE).collect())
        else:
            assert out.count() == packing.pack_documents(now).count()
        out.write.parquet(f"{sf}/{k}")
        now = spark.read.parquet(f"{sf}/{k}")
        sizes.append(now.count())
    assert corpus_pipeline.run(spark, sf).count() == sizes[-1]


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
