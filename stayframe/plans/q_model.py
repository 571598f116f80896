"""Assembly, preparation and model queries (A, B, T) over documents x
labels (+ the embeddings table as an embedding block)."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import functions as F

from stayframe.operators import assemble as AS
from stayframe.operators import evaluate as E
from stayframe.operators import model as T
from stayframe.operators import prepare as B
from stayframe.plans import sql_adapters as A
from stayframe.plans.registry import register, round_sql
from stayframe.session import checkpoint_dir, stage_packed
from stayframe.sources import adapters as ad
from stayframe.sources.io import read_table

CATS = ["lang", "channel"]
TOPK_COL, TOPK = "channel", 8
DIMS = 64
LABELS = ["quality", "toxic"]


def doc_block(spark, d):
    doc = read_table(spark, d, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    n_lines = F.size(F.split("text", "\n"))
    return doc.select(F.col("doc_id").alias("subject_id"), F.col("doc_id").alias("admission_id"), "lang",
                      F.nullif(F.col("source"), F.lit("src0")).alias("channel"), "n_chars",
                      n_lines.cast("bigint").alias("n_lines"),
                      F.col("text").rlike("[0-9]").cast("int").alias("has_digits"),
                      (F.col("n_chars") / n_lines).alias("mean_line_chars"))


def emb_block(spark, d):
    ids = read_table(spark, d, "documents", ["doc_id"])
    e = read_table(spark, d, "embeddings", ["vec_id", "embedding"])
    j = ids.join(e, ids.doc_id == e.vec_id, "left")
    return j.select(F.col("doc_id").alias("subject_id"),
                    *[F.col("embedding")[i].cast("double").alias(f"emb_{i}") for i in range(DIMS)])


def label_block(spark, d):
    lab = read_table(spark, d, "labels", ["doc_id", "quality", "toxic"])
    return lab.select(F.col("doc_id").alias("subject_id"), F.col("doc_id").alias("admission_id"),
                      F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"))


def matrix(spark, d):
    return AS.assemble_features([doc_block(spark, d), emb_block(spark, d)], label_block(spark, d))


def split_matrix(spark, d, label="quality"):
    return B.stratified_split(matrix(spark, d), label)


def _plan(df):
    return B.discover_columns(df, CATS, exclude=LABELS + ["split"])


def _prep(spark, d, label="quality", rows=None):
    # the fit statistics read the split matrix several times: write it once
    split = B.stratified_split(matrix(spark, d) if rows is None else rows, label)
    s = stage_packed(split, "split", len(split.columns))
    prep = B.fit_preparation(s.where(F.col("split") == "train"), _plan(s), TOPK_COL, TOPK)
    return s, prep


EMB_SQL = ", ".join(f"CAST(e.embedding[{i + 1}] AS DOUBLE) AS emb_{i}" for i in range(DIMS))
MAT = f"""mat AS (
  SELECT d.doc_id AS subject_id, d.doc_id AS admission_id, d.lang, nullif(d.source, 'src0') AS channel, d.n_chars,
         CAST(len(string_split(d.text, chr(10))) AS BIGINT) AS n_lines,
         CAST(regexp_matches(d.text, '[0-9]') AS INTEGER) AS has_digits,
         d.n_chars / len(string_split(d.text, chr(10))) AS mean_line_chars, {EMB_SQL},
         CAST(l.quality AS INTEGER) AS quality, CAST(l.toxic AS INTEGER) AS toxic
  FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id JOIN labels l ON d.doc_id = l.doc_id)"""
SPLIT = """sp AS (
  SELECT *, CASE WHEN (row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(subject_id AS VARCHAR) || '-1407'), subject_id) - 1)
                      / count(*) OVER (PARTITION BY quality) < 0.70 THEN 'train'
                 WHEN (row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(subject_id AS VARCHAR) || '-1407'), subject_id) - 1)
                      / count(*) OVER (PARTITION BY quality) < 0.85 THEN 'val' ELSE 'test' END AS split
  FROM mat)"""
TRAIN = "tr AS (SELECT * FROM sp WHERE split = 'train')"
BASE = [MAT, SPLIT, TRAIN]


@register("assemble_features", round_sql(A.with_(MAT) + "SELECT * FROM mat",
                                         ["mean_line_chars"] + [f"emb_{i}" for i in range(DIMS)]))
def q_assemble_features(spark, d):
    """A2: document block + embedding block (inner, one-to-one), label last."""
    return matrix(spark, d)


@register("assert_unique_key", A.with_(A.EPISODES) + """
SELECT subject_id, count(*) AS n FROM episodes GROUP BY 1 HAVING count(*) > 1""")
def q_assert_unique_key(spark, d):
    """A3: keys that break a one-to-one expectation (episodes per subject)."""
    return AS.duplicate_keys(ad.episodes(spark, d), ["subject_id"])


@register("stratified_split", A.with_(*BASE) + "SELECT subject_id, quality, split FROM sp")
def q_stratified_split(spark, d):
    """md5-ordered 70/15/15 per label, exact positions."""
    return split_matrix(spark, d).select("subject_id", "quality", "split")


@register("split_label_counts", A.with_(*BASE) + "SELECT split, quality, count(*) AS n FROM sp GROUP BY 1, 2")
def q_split_label_counts(spark, d):
    """B12."""
    return B.split_label_counts(split_matrix(spark, d), "quality")


@register("class_weight", round_sql(A.with_(*BASE) + """
SELECT CASE WHEN sum(quality) > 0 THEN (count(*) - sum(quality)) / sum(quality) ELSE 1.0 END AS scale_pos_weight FROM tr""",
                                    ["scale_pos_weight"]))
def q_class_weight(spark, d):
    """B13."""
    return B.class_weight(split_matrix(spark, d), "quality")


@register("topk_categories", A.with_(*BASE) + f"""
SELECT value, n, CAST(rk AS INTEGER) AS rank FROM (
  SELECT coalesce(channel, 'MISSING') AS value, count(*) AS n,
         row_number() OVER (ORDER BY count(*) DESC, coalesce(channel, 'MISSING')) AS rk FROM tr GROUP BY 1) z
WHERE rk <= {TOPK}""")
def q_topk_categories(spark, d):
    """B2: top-8 channels on train (MISSING competes for a slot, Q25)."""
    s = split_matrix(spark, d)
    return B.topk_categories(s.where(F.col("split") == "train"), TOPK_COL, TOPK).select(
        "value", "n", F.col("rank").cast("int").alias("rank"))


@register("impute_missing_token", A.with_(MAT) + """
SELECT coalesce(channel, 'MISSING') AS value, count(*) AS n FROM mat GROUP BY 1""")
def q_impute_missing_token(spark, d):
    """B3."""
    return matrix(spark, d).groupBy(B.impute_missing_token("channel").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))


@register("one_hot", A.with_(*BASE) + """
SELECT s.subject_id, """ + ", ".join(
    f"CASE WHEN s.lang = '{x}' THEN 1.0 ELSE 0.0 END AS \"lang={x}\"" for x in ["de", "en", "es", "fr"]) + """
FROM sp s""")
def q_one_hot(spark, d):
    """One column per category seen at fit (all four languages occur in
    train); unseen values would be all zeros."""
    s, prep = _prep(spark, d)
    prep.plan = {**prep.plan, "embeddings": [], "count_like": [], "flag_like": [], "other_numerics": [],
                 "categoricals": ["lang"]}
    return prep.transform_columns(s, ["subject_id"])


@register("impute_mean_median", round_sql(A.with_(*BASE) + """
SELECT 'median::mean_line_chars' AS "column", quantile_cont(mean_line_chars, 0.5) AS statistic FROM tr
UNION ALL SELECT 'mean::emb_0', avg(emb_0) FROM tr UNION ALL SELECT 'mean::emb_63', avg(emb_63) FROM tr""",
                                          ["statistic"]))
def q_impute_mean_median(spark, d):
    """Exact median (other numerics) and means (embeddings) fitted on
    train rows."""
    _, prep = _prep(spark, d)
    rows = [("median::mean_line_chars", prep.medians["mean_line_chars"]),
            ("mean::emb_0", prep.emb_means["emb_0"]), ("mean::emb_63", prep.emb_means["emb_63"])]
    return spark.createDataFrame(rows, "column string, statistic double")


@register("exact_medians", round_sql(A.with_(MAT) + """
SELECT 'n_chars' AS "column", quantile_cont(n_chars, 0.5) AS median FROM mat
UNION ALL SELECT 'n_lines', quantile_cont(n_lines, 0.5) FROM mat
UNION ALL SELECT 'mean_line_chars', quantile_cont(mean_line_chars, 0.5) FROM mat
UNION ALL SELECT 'emb_5', quantile_cont(emb_5, 0.5) FROM mat""", ["median"]))
def q_exact_medians(spark, d):
    """B5 core: exact medians of several columns in one distributed pass."""
    return B.exact_medians(matrix(spark, d), ["n_chars", "n_lines", "mean_line_chars", "emb_5"])


@register("missing_indicators", A.with_(*BASE) + """
SELECT subject_id, CASE WHEN n_chars IS NULL THEN 1.0 ELSE 0.0 END AS missingindicator_n_chars,
       CASE WHEN n_lines IS NULL THEN 1.0 ELSE 0.0 END AS missingindicator_n_lines,
       CASE WHEN has_digits IS NULL THEN 1.0 ELSE 0.0 END AS missingindicator_has_digits,
       CASE WHEN emb_0 IS NULL THEN 1.0 ELSE 0.0 END AS emb_missing FROM sp""")
def q_missing_indicators(spark, d):
    """The indicator columns that the fitted preparation builds."""
    s, prep = _prep(spark, d)
    return prep.transform_columns(s, ["subject_id"]).select(
        "subject_id", "missingindicator_n_chars", "missingindicator_n_lines", "missingindicator_has_digits", "emb_missing")


@register("log1p_counts", round_sql(A.with_(MAT) + """
SELECT subject_id, ln(1 + greatest(coalesce(CAST(n_chars AS DOUBLE), 0.0), 0.0)) AS n_chars_log1p,
       ln(1 + greatest(coalesce(CAST(n_lines AS DOUBLE), 0.0), 0.0)) AS n_lines_log1p FROM mat""",
                                    ["n_chars_log1p", "n_lines_log1p"]))
def q_log1p_counts(spark, d):
    """B7."""
    m = matrix(spark, d)
    return m.select("subject_id", B.log1p_count(B.to_double("n_chars")).alias("n_chars_log1p"),
                    B.log1p_count(B.to_double("n_lines")).alias("n_lines_log1p"))


@register("all_missing_flag", A.with_(MAT) + "SELECT count(*) FILTER (WHERE " + " AND ".join(
    f"emb_{i} IS NULL" for i in range(DIMS)) + ") AS n_all_missing, count(*) AS n FROM mat")
def q_all_missing_flag(spark, d):
    """Rows whose whole embedding vector is missing."""
    s, prep = _prep(spark, d)
    t = prep.transform_columns(s)
    return t.agg(F.sum(F.col("emb_missing").cast("long")).alias("n_all_missing"), F.count(F.lit(1)).alias("n"))


_LONG = "UNION ALL ".join(
    [f"SELECT subject_id, 'emb_{i}' AS \"column\", coalesce(emb_{i}, (SELECT avg(emb_{i}) FROM tr)) AS value FROM sp\n" for i in range(DIMS)]
    + ["SELECT subject_id, 'emb_missing', CASE WHEN emb_0 IS NULL THEN 1.0 ELSE 0.0 END FROM sp\n",
       "SELECT s.subject_id, 'lang=' || v.lang, CASE WHEN s.lang = v.lang THEN 1.0 ELSE 0.0 END FROM sp s, (SELECT DISTINCT lang FROM tr) v\n",
       "SELECT s.subject_id, 'channel=' || v.ch, CASE WHEN s.ch = v.ch THEN 1.0 ELSE 0.0 END FROM capped s, (SELECT DISTINCT ch FROM capped WHERE split = 'train') v\n",
       "SELECT subject_id, 'mean_line_chars', coalesce(mean_line_chars, (SELECT quantile_cont(mean_line_chars, 0.5) FROM tr)) FROM sp\n"]
    + [f"SELECT subject_id, 'missingindicator_{c}', CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END FROM sp\n" for c in ("n_chars", "n_lines", "has_digits")]
    + [f"SELECT subject_id, '{c}', CAST(coalesce({c}, 0) AS DOUBLE) FROM sp\n" for c in ("n_chars", "n_lines", "has_digits")]
    + [f"SELECT subject_id, '{c}_log1p', ln(1 + greatest(coalesce(CAST({c} AS DOUBLE), 0.0), 0.0)) FROM sp\n" for c in ("n_chars", "n_lines")])
CAPPED = f"""top AS (SELECT value FROM (
  SELECT coalesce(channel, 'MISSING') AS value, row_number() OVER (ORDER BY count(*) DESC, coalesce(channel, 'MISSING')) AS rk
  FROM tr GROUP BY 1) z WHERE rk <= {TOPK}),
capped AS (SELECT *, CASE WHEN coalesce(channel, 'MISSING') IN (SELECT value FROM top) THEN coalesce(channel, 'MISSING')
                          ELSE 'OTHER' END AS ch FROM sp)"""


@register("prepare_features", round_sql(A.with_(*BASE, CAPPED) + _LONG, ["value"]))
def q_prepare_features(spark, d):
    """Fitted on train, every prepared column of every row in long form."""
    s, prep = _prep(spark, d)
    wide = prep.transform_columns(s, ["subject_id"])
    return wide.unpivot(["subject_id"], [f"`{c}`" for c in wide.columns[1:]], "column", "value")


#: The tuned settings that each label is fitted with.
SETTINGS = {"quality": "mortality", "toxic": "readmission"}


def _matrix(spark, d, label, rows=None):
    s, prep = _prep(spark, d, label, rows)
    # written to the shared folder (spark.checkpoint.dir): boosting re-reads the
    # matrix every round, and a lost executor must not replay the lineage
    x = prep.transform(s, ["subject_id", "split", label])
    return s, prep, stage_packed(x, "matrix", len(prep.output_columns))


def _boosted(s, x, label):
    params = T.BEST_PARAMS[SETTINGS[label]]
    spw = B.class_weight(s, label).first()["scale_pos_weight"]
    return T.train_classifier(x, label, params, spw * params["spw_factor"])


def _calibrated(x, model, label):
    return T.calibrate_isotonic(T.positive_probability(model, x.where(F.col("split") == "val")), label)


_SAVED: dict = {}


def _saved(spark, d, labels=("quality",)):
    """The fits of labels over ``d``, each saved as a bundle by the first query
    of this application that needs it and loaded by all: (x, prep, model,
    calibrator) by label. Labels are boosted beside each other, as a round is
    a row of small jobs."""
    key = {label: (spark.sparkContext.applicationId, d, label) for label in labels}
    wanted = [label for label in labels if key[label] not in _SAVED]
    if wanted:
        rows = matrix(spark, d)
        made = {label: _matrix(spark, d, label, rows) for label in wanted}
        with ThreadPoolExecutor(len(wanted)) as pool:
            models = dict(zip(wanted, pool.map(lambda label: _boosted(made[label][0], made[label][2], label), wanted)))
        for label in wanted:
            _, prep, x = made[label]
            path = f"{checkpoint_dir(spark)}/bundle-{label}-{uuid.uuid4().hex}"
            T.save_bundle(path, prep, models[label], _calibrated(x, models[label], label), {"target": label, "blocks": "ne"})
            _SAVED[key[label]] = path, x
    found = {}
    for label in labels:
        path, x = _SAVED[key[label]]
        prep, model, cal, _ = T.load_bundle(path)
        found[label] = x, prep, model, cal
    return found


@register("train_classifier", A.with_(*BASE) + """
SELECT count(*) AS n, CAST(sum(quality) AS BIGINT) AS n_positive, true AS in_range, true AS ap_above_prevalence
FROM sp WHERE split = 'test'""")
def q_train_classifier(spark, d):
    """T1 (+B10, B13): boosted trees on train, stopped by the validation rows;
    the calibrated test predictions lie in [0, 1] and beat the prevalence."""
    s, _, x = _matrix(spark, d, "quality")
    model = _boosted(s, x, "quality")
    cal = _calibrated(x, model, "quality")
    pr = T.predict(model, cal, x.where(F.col("split") == "test"), [F.col("quality").alias("y_true")])
    ap = E.average_precision(pr).select("average_precision")
    n = pr.agg(F.count(F.lit(1)).alias("n"), F.sum("y_true").cast("long").alias("n_positive"),
               F.min(F.col("y_pred").between(0, 1)).alias("in_range"))
    return n.crossJoin(ap).select("n", "n_positive", "in_range",
                                  (F.col("average_precision") > F.col("n_positive") / F.col("n")).alias("ap_above_prevalence"))


#: A fixed ensemble of stumps on these columns: (column, threshold, output if at most, output if above).
#: Outputs are multiples of 1/64, so that sums are exact in any order.
STUMP_COLUMNS = ["n_chars", "n_lines", "mean_line_chars", "has_digits"]
STUMPS = [(STUMP_COLUMNS[t % 4], [150.0 + 90 * t, 1.0 + t // 4, 60.0 + 13 * t, 0.0][t % 4], (7 + t) / 64 * (-1) ** (t // 2), (5 + 3 * t) / 64 * (-1) ** (t // 3))
          for t in range(24)]
STUMP_ROWS = ", ".join(f"({t}, '{c}', CAST({x} AS DOUBLE), CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))" for t, (c, x, lo, hi) in enumerate(STUMPS))
STUMP_CELLS = f"""stumps(tree, col, threshold, lo, hi) AS (VALUES {STUMP_ROWS}),
cells AS (""" + " UNION ALL ".join(f"SELECT subject_id, quality, '{c}' AS col, CAST({c} AS DOUBLE) AS x FROM mat" for c in STUMP_COLUMNS) + ")"


def stump_trees() -> T.Trees:
    n = np.arange(len(STUMPS))
    by = lambda *v: np.array(v).T.reshape(-1)  # noqa: E731  root, left leaf, right leaf of each stump
    zero = np.zeros(len(STUMPS))
    return T.Trees(3 * n, np.ones(len(STUMPS)), by([STUMP_COLUMNS.index(s[0]) for s in STUMPS], zero - 1, zero - 1).astype(int),
                   by([s[1] for s in STUMPS], zero, zero), by(3 * n + 1, zero, zero).astype(int), by(3 * n + 2, zero, zero).astype(int),
                   by(zero, [s[2] for s in STUMPS], [s[3] for s in STUMPS]))


@register("staged_average_precision", round_sql(A.with_(MAT, STUMP_CELLS) + """, margins AS (
  SELECT subject_id, quality, s.tree + 1 AS round, sum(CASE WHEN c.x <= s.threshold THEN s.lo ELSE s.hi END) OVER (PARTITION BY subject_id ORDER BY s.tree) AS p
  FROM cells c JOIN stumps s ON c.col = s.col),
scores AS (SELECT round, p, sum(quality) AS pos, count(*) AS n FROM margins GROUP BY 1, 2),
ranked AS (SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS upto, sum(pos) OVER (PARTITION BY round) AS total FROM scores
           WINDOW w AS (PARTITION BY round ORDER BY p DESC))
SELECT CAST(round AS INTEGER) AS round, CAST(sum(n) AS BIGINT) AS count, sum(pos * tp / upto) / any_value(total) AS average_precision FROM ranked GROUP BY 1""",
                                                 ["average_precision"]))
def q_staged_average_precision(spark, d):
    """T1's stop, on a fixed ensemble: the average precision after each tree,
    from one pass over the rows."""
    rows = matrix(spark, d).select(F.array(*[F.col(c).cast("double") for c in STUMP_COLUMNS]).alias("features"), F.col("quality").alias("y_true"))
    return T.staged_average_precision(rows, stump_trees())


@register("split_gain", round_sql(A.with_(MAT, STUMP_CELLS) + """, parts AS (
  SELECT s.tree, s.col, c.x <= s.threshold AS side, count(*) AS n, sum(quality) AS pos FROM cells c JOIN stumps s ON c.col = s.col GROUP BY 1, 2, 3),
loss AS (SELECT tree, col, sum(pos) * (1 - sum(pos) / sum(n)) - sum(pos * (1 - pos / n)) AS gain, count(*) AS sides FROM parts GROUP BY 1, 2)
SELECT col AS feature, avg(gain) AS gain, count(*) AS n_splits FROM loss WHERE sides = 2 GROUP BY 1""", ["gain"]))
def q_split_gain(spark, d):
    """T5's measure on a fixed ensemble: the mean loss that a feature's splits
    remove, from a node table."""
    m = matrix(spark, d).select("quality", *STUMP_COLUMNS)
    below = [F.col(c).cast("double") <= x for c, x, _, _ in STUMPS]
    stats = m.agg(*[F.struct(F.lit(t).alias("tree"), F.lit(s[0]).alias("feature"), F.count(F.lit(1)).alias("n"), F.sum("quality").alias("pos"),
                             F.count_if(b).alias("n_left"), F.sum(F.when(b, F.col("quality")).otherwise(0)).alias("pos_left")).alias(f"s{t}")
                    for t, (s, b) in enumerate(zip(STUMPS, below))])
    spread = lambda pos, n: pos * (1 - pos / n)
    s = stats.select(F.explode(F.array(*[f"s{t}" for t in range(len(STUMPS))])).alias("s")).select("s.*").where("n_left > 0 AND n_left < n")
    removed = spread(F.col("pos"), F.col("n")) - spread(F.col("pos_left"), F.col("n_left")) - spread(F.col("pos") - F.col("pos_left"), F.col("n") - F.col("n_left"))
    return T.gain_by_feature(s.select("tree", "feature", (removed / F.col("n")).alias("gain"), F.col("n").alias("weight")))


#: The axes of the full grid and their values: every combination is fitted.
SEARCHED = T.grid_for("mortality")


@register("grid_search", "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SEARCHED) + ", true AS scored FROM "
          + ", ".join(f"(VALUES {', '.join(f'({v})' for v in values)}) {c}_values({c})" for c, values in SEARCHED.items())
          + " WHERE (SELECT count(*) FROM documents) > 0")
def q_grid_search(spark, d):
    """Every setting of the full grid (729), each fitted with the full
    patience and scored once."""
    s, _, x = _matrix(spark, d, "quality")
    spw = B.class_weight(s, "quality").first()["scale_pos_weight"]
    _, table = T.grid_search(x, "quality", spw, target="mortality")
    return table.select(*[F.get_json_object("params", f"$.{c}").cast("double").alias(c) for c in SEARCHED],
                        F.col("val_average_precision").between(0, 1).alias("scored"))


@register("calibrate_isotonic", round_sql(A.with_(A.predictions("quality")) + """,
g AS (SELECT y_pred AS x, sum(y_true) AS sy, count(*) AS c, row_number() OVER (ORDER BY y_pred) AS i FROM preds GROUP BY 1),
cs AS (SELECT *, sum(sy) OVER (ORDER BY i) AS csy, sum(c) OVER (ORDER BY i) AS cc FROM g),
seg AS (SELECT a.i AS a, b.i AS b, (b.csy - a.csy + a.sy) / (b.cc - a.cc + a.c) AS m FROM cs a JOIN cs b ON a.i <= b.i),
mn AS (SELECT g.i, s.a, min(s.m) AS v FROM g JOIN seg s ON s.a <= g.i AND g.i <= s.b GROUP BY 1, 2)
SELECT g.x AS y_pred, max(mn.v) AS calibrated FROM mn JOIN g ON mn.i = g.i GROUP BY 1""", ["y_pred", "calibrated"]))
def q_calibrate_isotonic(spark, d):
    """Isotonic fit of labels on scores; the oracle is the max-min
    formula over score groups."""
    p = ad.predictions(spark, d, "quality")
    cal = T.calibrate_isotonic(p.withColumnRenamed("y_pred", "p_raw"), "y_true")
    xs = p.select(F.col("y_pred").alias("p_raw")).distinct()
    return cal.transform(xs).select(F.col("p_raw").alias("y_pred"), F.col("p_cal").alias("calibrated"))


@register("predict_test", A.with_(*BASE) + "SELECT subject_id, quality AS y_true, true AS in_range FROM sp WHERE split = 'test'")
def q_predict_test(spark, d):
    """T4: a prediction in [0, 1] for every row of the test split."""
    x, _, model, cal = _saved(spark, d)["quality"]
    return T.predict(model, cal, x.where(F.col("split") == "test"), ["subject_id", "quality"]) \
        .select("subject_id", F.col("quality").alias("y_true"), F.col("y_pred").between(0, 1).alias("in_range"))


@register("feature_importance", None)
def q_feature_importance(spark, d):
    """T5: top-30 features by the mean gain of their splits."""
    _, prep, model, _ = _saved(spark, d)["quality"]
    return T.feature_importance(model, prep.output_columns, 30)


TOXIC_SPLIT = SPLIT.replace("quality", "toxic").replace("sp AS (", "st AS (")


@register("train_all_targets", A.with_(*BASE, TOXIC_SPLIT) + """
SELECT 'quality' AS target, count(*) AS n, avg(quality) AS prevalence FROM sp WHERE split = 'test'
UNION ALL SELECT 'toxic', count(*), avg(toxic) FROM st WHERE split = 'test'""")
def q_train_all_targets(spark, d):
    """One model per label; rows and prevalence of the test split that
    each is measured on (E7)."""
    out = None
    for label, (x, _, model, cal) in _saved(spark, d, LABELS).items():
        pr = T.predict(model, cal, x.where(F.col("split") == "test"), [F.col(label).alias("y_true")])
        m = pr.where(F.col("y_pred").between(0, 1)).agg(F.lit(label).alias("target"), F.count(F.lit(1)).alias("n"),
                                                        F.avg("y_true").alias("prevalence"))
        out = m if out is None else out.unionByName(m)
    return out


@register("score_unseen", """
SELECT doc_id AS subject_id, true AS quality_in_range, true AS toxic_in_range FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_score_unseen(spark, d):
    """Documents without labels scored by both models, each saved as a
    bundle and loaded from it."""
    docs = AS.assemble_features([doc_block(spark, d), emb_block(spark, d)])
    out = stage_packed(docs.join(read_table(spark, d, "labels", ["doc_id"]).withColumnRenamed("doc_id", "subject_id"),
                                 "subject_id", "left_anti"), "unseen", len(docs.columns))
    for label, (_, prep, model, cal) in _saved(spark, d, LABELS).items():
        out = T.predict(model, cal, prep.transform(out, out.columns), [F.col(f"`{c}`") for c in out.columns]) \
            .withColumn(f"{label}_in_range", F.col("y_pred").between(0, 1)).drop("y_pred")
    return out.select("subject_id", *[f"{label}_in_range" for label in LABELS])


@register("block_choice", A.with_(MAT) + """
SELECT CASE WHEN column_name = 'lang' THEN 'd' WHEN column_name LIKE 'n\\_%' ESCAPE '\\' THEN 'n' ELSE 'e' END AS letter,
       count(*) AS n_columns, CAST(sum(coalesce(n, 0)) AS BIGINT) AS n_values, 'dne' AS code
FROM (DESCRIBE SELECT * FROM mat) names LEFT JOIN (SELECT c, count(*) AS n FROM (UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM mat) ON COLUMNS(*) INTO NAME c VALUE v) u GROUP BY 1) counts ON c = column_name
WHERE column_name = 'lang' OR column_name LIKE 'n\\_%' ESCAPE '\\' OR column_name LIKE 'emb\\_%' ESCAPE '\\' GROUP BY 1""")
def q_block_choice(spark, d):
    """The blocks that the assembled matrix holds, with their columns and
    values, and the code of all of them."""
    m = matrix(spark, d)
    letter = F.when(F.col("column") == "lang", "d").when(F.col("column").startswith("n_"), "n").when(F.col("column").startswith("emb_"), "e")
    found = B.non_null_counts(m).withColumn("letter", letter).where("letter IS NOT NULL").groupBy("letter").agg(
        F.count(F.lit(1)).alias("n_columns"), F.sum("n").alias("n_values"))
    names = {"demographics": "lang" in m.columns, "notes": any(c.startswith("n_") for c in m.columns), "embeddings": any(c.startswith("emb_") for c in m.columns)}
    return found.withColumn("code", F.lit(T.block_choice(names)))
