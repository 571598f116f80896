"""Evaluation (E1-E7) and group-comparison (G1-G10) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.functions.expressions import coarse_group
from stayframe.operators import compare as G
from stayframe.operators import evaluate as E
from stayframe.operators import labels as L
from stayframe.plans import sql_adapters as A
from stayframe.plans.q_cohort import cohort_df, second_df
from stayframe.plans.q_text_demo import DEMO_SQL, _demo
from stayframe.plans.registry import register, round_sql
from stayframe.sources import adapters as ad
from stayframe.sources.io import read_table


def _preds(spark, d, target="quality"):
    return ad.predictions(spark, d, target)


AUROC_SQL = """r AS (SELECT y_true, (2 * rank() OVER (ORDER BY y_pred) + count(*) OVER (PARTITION BY y_pred) - 1) / 2.0 AS ar
  FROM preds),
t AS (SELECT sum(y_true) AS P, count(*) - sum(y_true) AS N, sum(ar) FILTER (WHERE y_true = 1) AS rs FROM r)"""
AP_SQL = """sc AS (SELECT y_pred, sum(y_true) AS pos, count(*) - sum(y_true) AS neg FROM preds GROUP BY 1),
c AS (SELECT *, sum(pos) OVER (ORDER BY y_pred DESC) AS tp, sum(neg) OVER (ORDER BY y_pred DESC) AS fp FROM sc)"""


@register("auroc", round_sql(A.with_(A.predictions("quality"), AUROC_SQL) + """
SELECT (rs - P * (P + 1) / 2.0) / (P * N) AS auroc FROM t""", ["auroc"]))
def q_auroc(spark, d):
    """E1 (labels x documents, target quality)."""
    return E.auroc(_preds(spark, d))


@register("average_precision", round_sql(A.with_(A.predictions("quality"), AP_SQL) + """
SELECT sum(pos + neg) AS "count", sum(pos * tp / (tp + fp)) / sum(pos) AS average_precision FROM c""",
                                         ["average_precision"]))
def q_average_precision(spark, d):
    """Step-wise AP (not the trapezoidal areaUnderPR)."""
    return E.average_precision(_preds(spark, d))


@register("brier", round_sql(A.with_(A.predictions("toxic")) + """
SELECT avg((y_true - y_pred) * (y_true - y_pred)) AS brier, avg(CAST(y_true AS DOUBLE)) AS prevalence, count(*) AS n
FROM preds""", ["brier", "prevalence"]))
def q_brier(spark, d):
    """Brier score, prevalence, n (target toxic)."""
    return E.basic_metrics(_preds(spark, d, "toxic"))


@register("roc_curve", round_sql(A.with_(A.predictions("quality"), AP_SQL) + """
SELECT y_pred AS threshold, fp / (SELECT sum(neg) FROM sc) AS fpr, tp / (SELECT sum(pos) FROM sc) AS tpr FROM c""",
                                 ["threshold", "fpr", "tpr"]))
def q_roc_curve(spark, d):
    """ROC points per distinct threshold."""
    return E.roc_points(_preds(spark, d))


@register("pr_curve", round_sql(A.with_(A.predictions("toxic"), AP_SQL) + """
SELECT y_pred AS threshold, tp / (tp + fp) AS precision, tp / (SELECT sum(pos) FROM sc) AS recall FROM c""",
                                ["threshold", "precision", "recall"]))
def q_pr_curve(spark, d):
    """precision/recall points per distinct threshold (target toxic)."""
    return E.pr_points(_preds(spark, d, "toxic"))


EDGES = " + ".join(f"CAST(y_pred > {e!r} AS INTEGER)" for e in E.CALIBRATION_EDGES)


@register("calibration_curve", round_sql(A.with_(A.predictions("quality")) + f"""
SELECT {EDGES} AS bin, avg(y_pred) AS mean_predicted, avg(CAST(y_true AS DOUBLE)) AS fraction_positive, count(*) AS n
FROM preds GROUP BY 1""", ["mean_predicted", "fraction_positive"]))
def q_calibration_curve(spark, d):
    """E5: ten equal-width bins, empty bins omitted."""
    return E.calibration_curve(_preds(spark, d))


GROUP_AP = """sc AS (SELECT grp, y_pred, sum(y_true) AS pos, count(*) - sum(y_true) AS neg FROM preds GROUP BY 1, 2),
c AS (SELECT *, sum(pos) OVER (PARTITION BY grp ORDER BY y_pred DESC) AS tp,
             sum(neg) OVER (PARTITION BY grp ORDER BY y_pred DESC) AS fp FROM sc),
ap AS (SELECT grp, sum(pos + neg) AS cnt, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
         THEN sum(pos * tp / (tp + fp)) / sum(pos) END AS average_precision FROM c GROUP BY 1)"""


@register("group_average_precision", round_sql(A.with_(A.predictions("toxic"), GROUP_AP) + """
SELECT g.grp, CAST(coalesce(ap.cnt, 0) AS BIGINT) AS "count", ap.average_precision
FROM (SELECT DISTINCT lang AS grp FROM documents UNION SELECT 'it') g LEFT JOIN ap ON g.grp = ap.grp""",
                                               ["average_precision"]))
def q_group_average_precision(spark, d):
    """AP per language (toxic); the groups table adds an empty group."""
    groups = read_table(spark, d, "documents", ["lang"]).select(F.col("lang").alias("grp")) \
        .unionByName(spark.createDataFrame([("it",)], "grp string"))
    return E.group_average_precision(_preds(spark, d, "toxic"), groups)


GROUPINGS = {"gender": None, "eth_broad": None, "eth_course": ["white", "black", "asian", "hispanic", "other"]}


@register("group_report", round_sql(A.with_(A.predictions("toxic")) + """,
people AS (SELECT doc_id AS subject_id, CASE doc_id % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS gender, lang AS eth_broad,
  CASE WHEN source = 'src1' THEN 'white' WHEN source = 'src2' THEN 'black' WHEN source = 'src3' THEN 'hispanic' ELSE 'other' END AS eth_course FROM documents),
g AS (SELECT subject_id, 'gender' AS grouping, gender AS grp FROM people UNION ALL SELECT subject_id, 'eth_broad', eth_broad FROM people
      UNION ALL SELECT subject_id, 'eth_course', eth_course FROM people),
sc AS (SELECT grouping, g.grp, y_pred, sum(y_true) AS pos, count(*) - sum(y_true) AS neg FROM preds JOIN g USING (subject_id) WHERE g.grp IS NOT NULL GROUP BY 1, 2, 3),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM sc WINDOW w AS (PARTITION BY grouping, grp ORDER BY y_pred DESC)),
ap AS (SELECT grouping, grp, sum(pos + neg) AS cnt, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * tp / (tp + fp)) / sum(pos) END AS average_precision FROM c GROUP BY 1, 2),
every AS (SELECT DISTINCT grouping, grp FROM g WHERE grp IS NOT NULL AND grouping <> 'eth_course'
          UNION ALL SELECT 'eth_course', unnest(['white', 'black', 'asian', 'hispanic', 'other']))
SELECT e.grouping, e.grp, CAST(coalesce(cnt, 0) AS BIGINT) AS "count", average_precision FROM every e LEFT JOIN ap USING (grouping, grp)""", ["average_precision"]))
def q_group_report(spark, d):
    """Average precision by three groupings in one job; gender and broad
    group list all values of the full table, the coarse groups are fixed."""
    doc = read_table(spark, d, "documents", ["doc_id", "lang", "source"])
    raw = F.when(F.col("source") == "src1", "WHITE - RUSSIAN").when(F.col("source") == "src2", "BLACK/AFRICAN").when(F.col("source") == "src3", "LATINO")
    people = doc.select(F.col("doc_id").alias("subject_id"), F.when(F.col("doc_id") % 3 == 0, "F").when(F.col("doc_id") % 3 == 1, "M").alias("gender"),
                        F.col("lang").alias("eth_broad"), coarse_group(F.coalesce(raw, F.lit("unknown"))).alias("eth_course"))
    return E.group_report(ad.predictions(spark, d, "toxic"), people, GROUPINGS)


@register("metrics_report", round_sql(A.with_(A.predictions("quality"), AUROC_SQL, AP_SQL) + """
SELECT (SELECT (rs - P * (P + 1) / 2.0) / (P * N) FROM t) AS auroc,
       (SELECT sum(pos * tp / (tp + fp)) / sum(pos) FROM c) AS auprc,
       (SELECT avg((y_true - y_pred) * (y_true - y_pred)) FROM preds) AS brier,
       (SELECT avg(CAST(y_true AS DOUBLE)) FROM preds) AS prevalence, (SELECT count(*) FROM preds) AS n""",
                                     ["auroc", "auprc", "brier", "prevalence"]))
def q_metrics_report(spark, d):
    """E7."""
    return E.metrics_report(_preds(spark, d))


# ---- group comparison over the cohort -----------------------------------------

def _labels(spark, d):
    c = cohort_df(spark, d)
    m = L.mortality(c, ad.episodes(spark, d), ad.subjects(spark, d)).select("subject_id", "admission_id", "mortality")
    p = L.prolonged_stay(c)
    r = L.readmission(c, second_df(spark, d)).select("subject_id", "readmission")
    return c.join(m, ["subject_id", "admission_id"], "left").join(p, ["subject_id", "admission_id"], "left") \
        .join(r, "subject_id", "left")


LABELS_SQL = A.with_(*A.COHORT_CHAIN, A.SECOND) + """, lab AS (
  SELECT c.subject_id, c.admission_id,
    coalesce(e.expire_flag = 1, false) OR coalesce(s.dod <= c.dischtime + INTERVAL 30 DAY, false) AS mortality,
    coalesce(c.dischtime > c.admittime + INTERVAL 7 DAY, false) AS prolonged_stay,
    coalesce(x.second_admittime IS NOT NULL AND NOT (x.second_admittime < c.dischtime)
             AND NOT coalesce(x.nonpositive_duration, false)
             AND CAST(x.second_admittime AS DATE) <= CAST(c.dischtime AS DATE) + 30, false) AS readmission
  FROM cohort c LEFT JOIN episodes e ON c.admission_id = e.admission_id
  LEFT JOIN subjects s ON c.subject_id = s.subject_id LEFT JOIN second_ep x ON c.subject_id = x.subject_id)
"""


@register("label_prevalence", round_sql(LABELS_SQL + """
SELECT 'mortality' AS label, count(mortality) AS n, sum(CAST(mortality AS INTEGER)) AS positives,
       avg(CAST(mortality AS INTEGER)) * 100.0 AS positive_pct FROM lab
UNION ALL SELECT 'prolonged_stay', count(prolonged_stay), sum(CAST(prolonged_stay AS INTEGER)),
       avg(CAST(prolonged_stay AS INTEGER)) * 100.0 FROM lab
UNION ALL SELECT 'readmission', count(readmission), sum(CAST(readmission AS INTEGER)),
       avg(CAST(readmission AS INTEGER)) * 100.0 FROM lab""", ["positive_pct"]))
def q_label_prevalence(spark, d):
    """G1."""
    return G.label_prevalence(_labels(spark, d), ["mortality", "prolonged_stay", "readmission"])


FLAGS = ["A", "N", "R"]


def _line_long(spark, d):
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_returnflag", "l_extendedprice"])
    return li.select(F.col("l_orderkey").alias("admission_id"), F.col("l_returnflag").alias("feature"),
                     F.col("l_extendedprice").alias("value"))


@register("pivot_mean", round_sql("""
SELECT l_orderkey AS admission_id, avg(l_extendedprice) FILTER (WHERE l_returnflag = 'A') AS A_mean,
       avg(l_extendedprice) FILTER (WHERE l_returnflag = 'N') AS N_mean,
       avg(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS R_mean
FROM lineitem GROUP BY 1""", ["A_mean", "N_mean", "R_mean"]))
def q_pivot_mean(spark, d):
    """Mean price per return flag as columns, per order (whole lineitem)."""
    return G.pivot_mean(_line_long(spark, d), ["admission_id"], "feature", "value", FLAGS)


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _mw_long(spark, d):
    li = read_table(spark, d, "lineitem", MEASURES + ["l_returnflag"])
    return li.select(F.explode(F.array(*[F.struct(F.lit(m).alias("feature"), F.col(m).alias("value"))
                                         for m in MEASURES])).alias("kv"),
                     (F.col("l_returnflag") == "R").alias("grp")).select("kv.feature", "kv.value", "grp")


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


#: erfc(x), x >= 0: a series up to 2.5, a continued fraction beyond.
ERFC = """(CASE WHEN {x} < 2.5 THEN 1 - 2 / sqrt(pi()) * {x} * exp(-{x} * {x})
    * list_reduce([CAST(1.0 AS DOUBLE)] || list_transform(range(1, 101), lambda k: CAST(101 - k AS DOUBLE)), lambda h, k: 1 + 2 * {x} * {x} / (2 * k + 1) * h)
  ELSE exp(-{x} * {x}) / sqrt(pi()) / list_reduce([CAST({x} AS DOUBLE)] || list_transform(range(1, 101), lambda k: CAST(101 - k AS DOUBLE)),
    lambda h, k: {x} + k / 2 / h) END)"""

MW_SQL = "lng AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS feature, {m} AS value, l_returnflag = 'R' AS grp FROM lineitem" for m in MEASURES) + ")"
MW_TAIL = """,
rk AS (SELECT *, (2 * rank() OVER (PARTITION BY feature ORDER BY value)
                  + count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS ar FROM lng),
ties AS (SELECT feature, sum(t * t * t - t) AS ties FROM (SELECT feature, value, count(*) AS t FROM lng GROUP BY 1, 2) z GROUP BY 1),
agg AS (SELECT feature, count(*) FILTER (WHERE NOT grp) AS n0, count(*) FILTER (WHERE grp) AS n1,
               sum(ar) FILTER (WHERE NOT grp) AS r0,
               quantile_cont(value, 0.5) FILTER (WHERE NOT grp) AS m0, quantile_cont(value, 0.5) FILTER (WHERE grp) AS m1
        FROM rk GROUP BY 1),
mw AS (SELECT a.feature, a.n0, a.n1, a.r0 - a.n0 * (a.n0 + 1) / 2.0 AS u0, a.m0, a.m1, t.ties FROM agg a JOIN ties t USING (feature)),
mz AS (SELECT *, (greatest(u0, n0 * n1 - u0) - n0 * n1 / 2.0 - 0.5)
        / sqrt(n0 * n1 / 12.0 * ((n0 + n1 + 1) - ties / ((n0 + n1) * (n0 + n1 - 1.0)))) AS z FROM mw),
small AS (SELECT feature, least(n0, n1) AS k, n0 + n1 AS n, CAST(greatest(u0, n0 * n1 - u0) AS BIGINT) AS far FROM mw WHERE least(n0, n1) BETWEEN 1 AND 8 AND ties = 0),
ways AS (SELECT feature, k, n, far, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS j, CAST(0 AS BIGINT) AS s, CAST(1 AS HUGEINT) AS w FROM small
  UNION ALL SELECT feature, k, n, far, i + 1, j + take, s + take * (i + 1), CAST(sum(w) AS HUGEINT) FROM ways, (VALUES (0), (1)) t(take)
  WHERE i < n AND j + take <= k GROUP BY feature, k, n, far, i, j + take, s + take * (i + 1)),
exact AS (SELECT feature, least(1.0, 2 * coalesce(sum(w) FILTER (s - k * (k + 1) // 2 >= far), 0) / sum(w)) AS p FROM ways WHERE i = n AND j = k GROUP BY 1),
mq AS (SELECT * EXCLUDE (p), coalesce(p, least(greatest(""" + ERFC.format(x="(z / sqrt(2.0))") + """, 0.0), 1.0)) AS p_value FROM mz LEFT JOIN exact USING (feature))"""


MW_SQL += MW_TAIL


@register("mann_whitney", round_sql(_recursive(A.with_(MW_SQL)) + """
SELECT feature, n0, n1, u0 AS u_statistic, m0 AS median_group_false, m1 AS median_group_true, z, p_value FROM mq""",
                                    ["u_statistic", "median_group_false", "median_group_true", "z", "p_value"]))
def q_mann_whitney(spark, d):
    """U, medians, z and p for four lineitem measures, group = flag R
    (whole lineitem, long form)."""
    return G.mann_whitney(_mw_long(spark, d))


@register("bonferroni", round_sql(_recursive(A.with_(MW_SQL)) + """
SELECT feature, p_value, least(p_value * (SELECT count(*) FROM mq), 1.0) AS p_adj,
       p_value <= 0.05 / (SELECT count(*) FROM mq) AS significant FROM mq""", ["p_value", "p_adj"]))
def q_bonferroni(spark, d):
    """G4 over the G3 tests."""
    return G.bonferroni(G.mann_whitney(_mw_long(spark, d)).select("feature", "p_value"))


def _comparison(spark, d):
    lab = _labels(spark, d)
    demo = _demo(spark, d).select("subject_id", "admission_id", "age", "gender", "insurance", "admission_type",
                                  "eth_broad")
    means = G.pivot_mean(_line_long(spark, d), ["admission_id"], "feature", "value", FLAGS)
    return (lab.drop("admittime", "dischtime").join(demo, ["subject_id", "admission_id"], "left")
            .join(means, "admission_id", "left"))


def _comp_sql():
    demo_select = DEMO_SQL[DEMO_SQL.index("\nSELECT c.subject_id"):]
    return (LABELS_SQL + ", demo AS (" + demo_select + "),\n" + """pm AS (
SELECT l_orderkey AS admission_id, avg(l_extendedprice) FILTER (WHERE l_returnflag = 'A') AS A_mean,
       avg(l_extendedprice) FILTER (WHERE l_returnflag = 'N') AS N_mean,
       avg(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS R_mean FROM lineitem GROUP BY 1),
comp AS (SELECT l.*, d.age, d.gender, d.insurance, d.admission_type, d.eth_broad, pm.A_mean, pm.N_mean, pm.R_mean
  FROM lab l LEFT JOIN demo d ON l.subject_id = d.subject_id AND l.admission_id = d.admission_id
  LEFT JOIN pm ON l.admission_id = pm.admission_id)
""")


COMP = _comp_sql()


@register("comparison_table", round_sql(COMP + "SELECT * FROM comp", ["A_mean", "N_mean", "R_mean"]))
def q_comparison_table(spark, d):
    """Cohort + labels + demographics + mean features."""
    return _comparison(spark, d)


TARGETS, CONT_FEATURES = ["mortality", "prolonged_stay", "readmission"], ["age", "A_mean", "N_mean", "R_mean"]


@register("compare_continuous", round_sql(_recursive(COMP) + ", lng AS (" + " UNION ALL ".join(
    f"SELECT '{t}/{f}' AS feature, CAST({f} AS DOUBLE) AS value, {t} AS grp FROM comp WHERE {f} IS NOT NULL AND {t} IS NOT NULL" for t in TARGETS for f in CONT_FEATURES)
    + ")" + MW_TAIL + """
SELECT split_part(feature, '/', 1) AS target, split_part(feature, '/', 2) AS feature, n0, n1, u0 AS u_statistic, m0 AS median_group_false,
       m1 AS median_group_true, z, p_value, least(p_value * 4, 1.0) AS p_adj, p_value <= 0.05 / 4 AS significant FROM mq""",
    ["u_statistic", "median_group_false", "median_group_true", "z", "p_value", "p_adj"]))
def q_compare_continuous(spark, d):
    """G3 + G4 on the comparison table, all three targets in one job."""
    return G.compare_continuous(_comparison(spark, d), TARGETS, CONT_FEATURES)


@register("crosstab", COMP + """
SELECT CAST(insurance AS VARCHAR) AS category, CAST(mortality AS VARCHAR) AS "group", count(*) AS observed FROM comp
WHERE insurance IS NOT NULL AND mortality IS NOT NULL GROUP BY 1, 2""")
def q_crosstab(spark, d):
    """Insurance x mortality (long form)."""
    return G.crosstab_long(_comparison(spark, d), "insurance", "mortality")


CAT_FEATURES = ["gender", "insurance", "admission_type", "eth_broad"]


def _chi_sql():
    parts = []
    for f in CAT_FEATURES:
        parts.append(f"""SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS category, CAST(mortality AS VARCHAR) AS grp,
  count(*) AS o FROM comp WHERE {f} IS NOT NULL AND mortality IS NOT NULL GROUP BY 1, 2, 3""")
    return COMP + ", ct AS (" + " UNION ALL ".join(parts) + """),
cells AS (SELECT a.feature, a.category, b.grp, coalesce(ct.o, 0) AS o
  FROM (SELECT DISTINCT feature, category FROM ct) a JOIN (SELECT DISTINCT feature, grp FROM ct) b USING (feature)
  LEFT JOIN ct USING (feature, category, grp)),
tot AS (SELECT *, sum(o) OVER (PARTITION BY feature, category) * sum(o) OVER (PARTITION BY feature, grp)
                   / sum(o) OVER (PARTITION BY feature) AS e FROM cells),
dims AS (SELECT feature, (count(DISTINCT category) - 1) * (count(DISTINCT grp) - 1) AS dof FROM cells GROUP BY 1),
terms AS (SELECT t.feature, d.dof, CASE WHEN d.dof = 1 THEN t.o + sign(t.e - t.o) * least(0.5, abs(t.e - t.o)) ELSE t.o END AS oa,
                 t.e FROM tot t JOIN dims d USING (feature)),
res AS (SELECT feature, dof, sum((oa - e) * (oa - e) / e) AS chi2_statistic,
               avg(CASE WHEN e < 5 THEN 1.0 ELSE 0.0 END) * 100.0 AS percent_low_expected FROM terms GROUP BY 1, 2),
half AS (SELECT *, chi2_statistic / 2 AS y FROM res)
SELECT feature, dof, chi2_statistic, percent_low_expected, CASE WHEN dof > 0 THEN CASE
  WHEN dof % 2 = 0 THEN exp(-y) * list_reduce([CAST(1.0 AS DOUBLE)] || list_transform(range(1, CAST(dof // 2 AS BIGINT)), lambda k: CAST(dof // 2 - k AS DOUBLE)),
                                              lambda h, k: 1 + y / k * h)
  WHEN dof = 1 THEN """ + ERFC.format(x="sqrt(y)") + """
  ELSE """ + ERFC.format(x="sqrt(y)") + """ + exp(-y) * sqrt(y) / gamma(1.5)
    * list_reduce([CAST(1.0 AS DOUBLE)] || list_transform(range(1, CAST((dof - 1) // 2 AS BIGINT)), lambda k: CAST((dof - 1) // 2 - k AS DOUBLE)),
                  lambda h, k: 1 + y / (k + 0.5) * h) END END AS p_value FROM half"""


@register("chi_square", round_sql(_chi_sql(), ["chi2_statistic", "percent_low_expected", "p_value"]))
def q_chi_square(spark, d):
    """Categorical features vs mortality."""
    return G.chi_square(_comparison(spark, d), CAT_FEATURES, "mortality")


@register("normality_moments", round_sql(COMP + """
SELECT mortality, n, m3 / pow(m2, 1.5) AS skewness, m4 / (m2 * m2) - 3 AS kurtosis,
       n / 6.0 * (pow(m3 / pow(m2, 1.5), 2) + pow(m4 / (m2 * m2) - 3, 2) / 4.0) AS jarque_bera
FROM (SELECT c.mortality, count(*) AS n, avg(pow(age - mu, 2)) AS m2, avg(pow(age - mu, 3)) AS m3,
             avg(pow(age - mu, 4)) AS m4
      FROM comp c JOIN (SELECT mortality, avg(age) AS mu FROM comp WHERE age IS NOT NULL GROUP BY 1) m
        ON c.mortality = m.mortality WHERE age IS NOT NULL GROUP BY 1) z""", ["skewness", "kurtosis", "jarque_bera"]))
def q_normality_moments(spark, d):
    """Age moments by mortality on all rows."""
    return G.normality_moments(_comparison(spark, d), "age", "mortality")


@register("histogram", COMP + """
SELECT mortality, CASE WHEN age < 0 THEN 0 WHEN age >= 100 THEN 11 ELSE CAST(floor((age - 0) / 10.0) AS BIGINT) + 1 END AS bin,
       count(*) AS n FROM comp WHERE age IS NOT NULL GROUP BY 1, 2""")
def q_histogram(spark, d):
    """Age histogram (10 bins over 0..100) by mortality."""
    return G.histogram(_comparison(spark, d), "age", "mortality", 0.0, 100.0, 10)


@register("unique_subject_check", COMP + """
SELECT count(*) AS n_rows, count(DISTINCT subject_id) AS n_subjects, count(*) = count(DISTINCT subject_id) AS "unique"
FROM comp""")
def q_unique_subject_check(spark, d):
    """G9."""
    return G.unique_subject_check(_comparison(spark, d))
