"""Source/sink and helper queries (S1, S3, S5, S7, S8, S10, A1, A4, B1, B5,
B9, T6). Inputs are written from the driver's tables into the session's
checkpoint dir (shared storage on a cluster), then read back through the
operator under test."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stayframe.operators import assemble as AS
from stayframe.operators import prepare as B
from stayframe.plans import sql_adapters as A
from stayframe.plans.q_model import BASE, CATS, LABELS, MAT, _prep, doc_block, emb_block, label_block
from stayframe.plans.registry import register, round_sql
from stayframe.session import checkpoint_dir
from stayframe.sources import adapters as ad
from stayframe.sources import io


def _path(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/stages/{name}-{uuid.uuid4().hex}"


@register("cohort_ids", """SELECT DISTINCT o_custkey AS subject_id FROM orders""")
def q_cohort_ids(spark, d):
    """An id-list CSV (every ordering customer, duplicates included)
    read back as a distinct id table."""
    p = _path(spark, "ids")
    io.read_table(spark, d, "orders", ["o_custkey"]).select(F.col("o_custkey").alias("subject_id")) \
        .write.mode("overwrite").option("header", True).csv(p)
    return io.cohort_ids(spark, p)


@register("item_dictionary", """SELECT CAST(ascii(event_type) AS BIGINT) AS itemid, upper(event_type) AS feature_name,
  CAST(min(value) AS DOUBLE) AS min_bound, CAST(max(value) AS DOUBLE) AS max_bound FROM events GROUP BY event_type""")
def q_item_dictionary(spark, d):
    """S3: a dictionary CSV derived from the events (per type: name and the
    observed value range) read with the dictionary reader."""
    p = _path(spark, "dict")
    e = io.read_table(spark, d, "events", ["event_type", "value"])
    e.groupBy("event_type").agg(F.min("value").alias("min"), F.max("value").alias("max")).select(
        F.ascii("event_type").alias("itemid"), F.col("event_type").alias("measurement name"),
        F.upper("event_type").alias("feature name"), "min", "max", F.lit("").alias("units")) \
        .write.mode("overwrite").option("header", True).csv(p)
    return io.item_dictionary(spark, p)


@register("write_stage", A.with_(A.EPISODES) + """
SELECT subject_id, count(*) AS n FROM episodes GROUP BY 1""")
def q_write_stage(spark, d):
    """A stage written as parquet (partitioned) and re-read."""
    e = ad.episodes(spark, d).groupBy("subject_id").agg(F.count(F.lit(1)).alias("n"))
    return io.write_stage(e.withColumn("part", F.col("subject_id") % 4), _path(spark, "stage"),
                          partition_by=["part"]).select("subject_id", "n")


@register("write_report", """SELECT l_returnflag, CAST(count(*) AS VARCHAR) AS n FROM lineitem GROUP BY 1""")
def q_write_report(spark, d):
    """An aggregate-size report written as one CSV file and read back."""
    p = _path(spark, "report")
    rep = io.read_table(spark, d, "lineitem", ["l_returnflag"]).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"))
    io.write_report(rep, p)
    return spark.read.option("header", True).csv(p)


@register("register_frame", A.with_(A.EPISODES) + """
SELECT status_raw, count(*) AS n FROM episodes GROUP BY 1""")
def q_register_frame(spark, d):
    """A frame exposed to SQL as a view and queried."""
    io.register_frame(ad.episodes(spark, d), "episodes_view")
    return spark.sql("SELECT status_raw, count(*) AS n FROM episodes_view GROUP BY status_raw")


@register("require_columns", "SELECT count(*) AS n FROM events")
def q_require_columns(spark, d):
    """The schema check passes and the frame flows on."""
    e = io.read_table(spark, d, "events")
    return io.require_columns(e, ["event_id", "ts", "user_id"]).agg(F.count(F.lit(1)).alias("n"))


@register("common_keys", A.with_(MAT) + """
SELECT subject_id, admission_id, lang, quality FROM mat""")
def q_common_keys(spark, d):
    """A1: blocks joined on the ids both carry (two ids, then subject only)."""
    doc = doc_block(spark, d).select("subject_id", "admission_id", "lang")
    lab = label_block(spark, d).select("subject_id", "quality")
    return doc.join(lab, AS.common_keys(doc, lab), "inner")


@register("enforce_id_types", "SELECT CAST(n_nationkey AS BIGINT) AS subject_id, n_name FROM nation")
def q_enforce_id_types(spark, d):
    """A4: int ids widened to bigint."""
    n = io.read_table(spark, d, "nation", ["n_nationkey", "n_name"]).select(
        F.col("n_nationkey").alias("subject_id"), "n_name")
    return AS.enforce_id_types(n)


@register("discover_columns", A.with_(MAT) + """
SELECT column_name AS "column",
  CASE WHEN column_name IN ('subject_id', 'admission_id', 'quality', 'toxic') THEN 'ignored'
       WHEN column_name LIKE 'emb\\_%' ESCAPE '\\' THEN 'embeddings'
       WHEN column_name IN ('lang', 'channel') OR column_name LIKE '%\\_sign\\_mean' ESCAPE '\\' THEN 'categoricals'
       WHEN column_name LIKE 'n\\_%' ESCAPE '\\' THEN 'count_like'
       WHEN column_name LIKE '%\\_any\\_%' ESCAPE '\\' OR column_name LIKE 'no\\_%' ESCAPE '\\'
            OR column_name LIKE 'has\\_%' ESCAPE '\\' THEN 'flag_like'
       ELSE 'other_numerics' END AS block, coalesce(n, 0) AS n
FROM (DESCRIBE SELECT * FROM mat) names LEFT JOIN (SELECT c, count(*) AS n FROM (UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM mat) ON COLUMNS(*) INTO NAME c VALUE v) u GROUP BY 1) counts ON c = column_name""")
def q_discover_columns(spark, d):
    """B1: the block of every column of the assembled matrix, by name, and its
    count of values."""
    m = AS.assemble_features([doc_block(spark, d), emb_block(spark, d)], label_block(spark, d))
    plan = B.discover_columns(m, CATS, exclude=LABELS)
    rows = [(c, blk) for blk in ("embeddings", "categoricals", "count_like", "flag_like", "other_numerics")
            for c in getattr(plan, blk)]
    assigned = {c for c, _ in rows}
    rows += [(c, "ignored") for c in m.columns if c not in assigned]
    block = F.create_map(*[F.lit(x) for row in rows for x in row])
    return B.non_null_counts(m).select("column", block[F.col("column")].alias("block"), "n")


@register("to_double", """SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k,
  TRY_CAST(event_type AS DOUBLE) AS t FROM events""")
def q_to_double(spark, d):
    """Numeric coercion of text (digits from the props JSON; the event
    type never parses: null)."""
    e = io.read_table(spark, d, "events", ["event_id", "props", "event_type"])
    e = e.withColumn("k", F.regexp_extract("props", "[0-9]+", 0)).withColumn("t", F.col("event_type"))
    return e.select("event_id", B.to_double("k").alias("k"), B.to_double("t").alias("t"))


@register("impute_mean", round_sql(A.with_(*BASE) + """, m AS (SELECT avg(emb_0) AS m0, avg(emb_17) AS m17 FROM tr)
SELECT s.subject_id, coalesce(s.emb_0, m.m0) AS emb_0, coalesce(s.emb_17, m.m17) AS emb_17 FROM sp s, m""",
                                   ["emb_0", "emb_17"]))
def q_impute_mean(spark, d):
    """Embedding columns mean-imputed with train means."""
    s, prep = _prep(spark, d)
    t = prep.transform_columns(s, ["subject_id"])
    return t.select("subject_id", "emb_0", "emb_17")


@register("impute_median", round_sql(A.with_(*BASE) + """, m AS (SELECT quantile_cont(mean_line_chars, 0.5) AS med FROM tr)
SELECT s.subject_id, coalesce(s.mean_line_chars, m.med) AS mean_line_chars FROM sp s, m""", ["mean_line_chars"]))
def q_impute_median(spark, d):
    """Other numerics median-imputed (exact median of train)."""
    s, prep = _prep(spark, d)
    return prep.transform_columns(s, ["subject_id"]).select("subject_id", "mean_line_chars")


@register("impute_zero", A.with_(*BASE) + """
SELECT subject_id, CAST(coalesce(n_chars, 0) AS DOUBLE) AS n_chars, CAST(coalesce(n_lines, 0) AS DOUBLE) AS n_lines,
       CAST(coalesce(has_digits, 0) AS DOUBLE) AS has_digits FROM sp""")
def q_impute_zero(spark, d):
    """Counts and flags zero-imputed."""
    s, prep = _prep(spark, d)
    return prep.transform_columns(s, ["subject_id"]).select("subject_id", "n_chars", "n_lines", "has_digits")


@register("save_bundle", A.with_(*BASE) + "SELECT subject_id, true AS same FROM sp WHERE split = 'test'")
def q_save_bundle(spark, d):
    """Preparation, model and calibrator saved to the checkpoint dir,
    loaded back; whether both score a row of the test split alike."""
    from stayframe.operators import model as T
    from stayframe.plans.q_model import _saved
    x, prep, model, cal = _saved(spark, d)["quality"]
    p = _path(spark, "bundle")
    T.save_bundle(p, prep, model, cal, {"target": "quality", "blocks": "ne"})
    prep2, model2, cal2, _ = T.load_bundle(p)
    both = T.predict(model, cal, x.where(F.col("split") == "test"), ["subject_id", "features"]).withColumnRenamed("y_pred", "before")
    return T.predict(model2, cal2, both, ["subject_id", "before"]).select("subject_id", (F.col("y_pred") == F.col("before")).alias("same"))
