"""Cohort, label and source queries (S, C, L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.operators import cohort as C
from stayframe.operators import labels as L
from stayframe.plans import sql_adapters as A
from stayframe.plans.registry import register, round_sql
from stayframe.session import materialize
from stayframe.sources import adapters as ad
from stayframe.sources.io import scan_typed, value_counts


def _ids(spark, d):
    """The cohort id list: every customer key (read directly, one column)."""
    from stayframe.sources.io import read_table
    return read_table(spark, d, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("subject_id"))


def cohort_df(spark, d):
    return C.build_cohort(ad.episodes(spark, d), ad.subjects(spark, d), _ids(spark, d))


def second_df(spark, d):
    return C.second_episode(cohort_df(spark, d), ad.episodes(spark, d))


# ---- sources -------------------------------------------------------------

@register("scan_typed", A.with_(A.EPISODES) + """
SELECT subject_id, admission_id, admittime, dischtime, CAST(expire_flag AS INTEGER) AS expire_flag FROM episodes""")
def q_scan_typed(spark, d):
    """Typed, renamed projection of the episode source."""
    e = ad.episodes(spark, d)
    return scan_typed(e, {"subject_id": ("subject_id", "bigint"), "admission_id": ("admission_id", "bigint"),
                          "admittime": ("admittime", "timestamp_ntz"), "dischtime": ("dischtime", "timestamp_ntz"),
                          "expire_flag": ("expire_flag", "int")})


@register("read_stage", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def q_read_stage(spark, d):
    """Column-pruned read with a pushed filter."""
    from stayframe.sources.io import read_stage
    return read_stage(spark, f"{d}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderstatus"]) \
        .where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")


@register("value_counts", A.with_(A.SUBJECTS, A.EPISODES) + """
SELECT 'gender_raw' AS "column", CAST(gender_raw AS VARCHAR) AS value, count(*) AS "count" FROM subjects GROUP BY 2
UNION ALL SELECT 'region_raw', CAST(region_raw AS VARCHAR), count(*) FROM subjects GROUP BY 2
UNION ALL SELECT 'expire_flag', CAST(expire_flag AS VARCHAR), count(*) FROM episodes GROUP BY 2""")
def q_value_counts(spark, d):
    """Value -> count per column, nulls included."""
    s = value_counts(ad.subjects(spark, d), ["gender_raw", "region_raw"])
    e = value_counts(ad.episodes(spark, d), ["expire_flag"])
    return s.unionByName(e)


# ---- cohort ----------------------------------------------------------------

@register("restrict_to_ids", A.with_(A.EPISODES) + """
SELECT count(*) AS n_rows, count(DISTINCT subject_id) AS n_subjects FROM episodes
WHERE subject_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))""")
def q_restrict_to_ids(spark, d):
    """Semi join of episodes to an id table (customers of two segments)."""
    ids = ad.subjects(spark, d).where(F.col("gender_raw").isin("BUILDING", "MACHINERY")).select("subject_id")
    r = C.restrict_to_ids(ad.episodes(spark, d), ids)
    return r.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("subject_id").alias("n_subjects"))


@register("first_episode", A.with_(A.EPISODES, A.IDS, A.FIRST_EP) + "SELECT * FROM first_ep")
def q_first_episode(spark, d):
    return C.first_episode(C.restrict_to_ids(ad.episodes(spark, d), _ids(spark, d)))


@register("nth_episode", A.with_(A.EPISODES) + """
SELECT subject_id, admission_id, admittime, dischtime FROM (
  SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY admittime NULLS LAST, admission_id) AS rn
  FROM episodes) t WHERE rn = 2""")
def q_nth_episode(spark, d):
    return C.nth_episode(ad.episodes(spark, d), 2)


@register("second_episode", A.with_(*A.COHORT_CHAIN, A.SECOND) + "SELECT * FROM second_ep")
def q_second_episode(spark, d):
    """C3 + C11 on the built cohort."""
    return second_df(spark, d)


@register("missing_subjects", A.with_(A.SUBJECTS, A.EPISODES, A.IDS, A.FIRST_EP) + """
SELECT subject_id FROM ids WHERE subject_id NOT IN (SELECT subject_id FROM first_ep)""")
def q_missing_subjects(spark, d):
    ids = _ids(spark, d)
    return C.missing_subjects(ids, C.first_episode(C.restrict_to_ids(ad.episodes(spark, d), ids)))


@register("episode_duration", round_sql(A.with_(A.EPISODES, A.IDS, A.FIRST_EP, A.DURATION) + """
SELECT subject_id, admission_id, duration_hours FROM dur""", ["duration_hours"]))
def q_episode_duration(spark, d):
    first = C.first_episode(C.restrict_to_ids(ad.episodes(spark, d), _ids(spark, d)))
    return C.episode_duration(first).select("subject_id", "admission_id", "duration_hours")


@register("duration_audit", A.with_(A.EPISODES, A.IDS, A.FIRST_EP) + """
SELECT count(*) AS n_first, count(*) FILTER (WHERE admittime IS NULL OR dischtime IS NULL) AS n_missing_time,
       count(*) FILTER (WHERE epoch_us(dischtime) <= epoch_us(admittime)) AS n_nonpositive FROM first_ep""")
def q_duration_audit(spark, d):
    return C.duration_audit(C.first_episode(C.restrict_to_ids(ad.episodes(spark, d), _ids(spark, d))))


@register("min_duration_filter", A.with_(A.EPISODES, A.IDS, A.FIRST_EP, A.DURATION) + """
SELECT subject_id, admission_id, admittime, dischtime FROM dur WHERE duration_hours >= 54""")
def q_min_duration_filter(spark, d):
    first = C.first_episode(C.restrict_to_ids(ad.episodes(spark, d), _ids(spark, d)))
    return C.min_duration_filter(C.episode_duration(first)).select(*C.COHORT_COLUMNS)


def _aged(spark, d):
    first = C.first_episode(C.restrict_to_ids(ad.episodes(spark, d), _ids(spark, d)))
    return C.age_at(C.min_duration_filter(C.episode_duration(first)), ad.subjects(spark, d))


@register("age_at", A.with_(A.SUBJECTS, A.EPISODES, A.IDS, A.FIRST_EP, A.DURATION, A.AGED) + """
SELECT subject_id, admission_id, age FROM aged""")
def q_age_at(spark, d):
    return _aged(spark, d).select("subject_id", "admission_id", "age")


@register("drop_reason", A.with_(A.SUBJECTS, A.EPISODES, A.IDS, A.FIRST_EP, A.DURATION, A.AGED, A.REASONED) + """
SELECT subject_id, admission_id, age, drop_reason FROM reasoned""")
def q_drop_reason(spark, d):
    return C.with_drop_reason(_aged(spark, d)).select("subject_id", "admission_id", "age", "drop_reason")


@register("drop_reason_counts", A.with_(A.SUBJECTS, A.EPISODES, A.IDS, A.FIRST_EP, A.DURATION, A.AGED, A.REASONED) + """
SELECT coalesce(drop_reason, 'keep') AS reason, count(*) AS n FROM reasoned GROUP BY 1""")
def q_drop_reason_counts(spark, d):
    return C.drop_reason_counts(C.with_drop_reason(_aged(spark, d)))


@register("age_filter", A.with_(*A.COHORT_CHAIN) + "SELECT * FROM cohort")
def q_age_filter(spark, d):
    return C.age_filter(C.with_drop_reason(_aged(spark, d)))


@register("nonpositive_flag", A.with_(*A.COHORT_CHAIN, A.SECOND) + """
SELECT nonpositive_duration, count(*) AS n FROM second_ep GROUP BY 1""")
def q_nonpositive_flag(spark, d):
    return second_df(spark, d).groupBy("nonpositive_duration").agg(F.count(F.lit(1)).alias("n"))


@register("null_time_audit", A.with_(*A.COHORT_CHAIN, A.SECOND) + """
SELECT subject_id, second_admission_id FROM second_ep
WHERE second_admission_id IS NOT NULL AND (second_admittime IS NULL OR second_dischtime IS NULL)""")
def q_null_time_audit(spark, d):
    return C.null_time_audit(second_df(spark, d)).select("subject_id", "second_admission_id")


@register("build_cohort", A.with_(*A.COHORT_CHAIN) + "SELECT * FROM cohort")
def q_build_cohort(spark, d):
    """The whole cohort plan in one lazy DataFrame."""
    return cohort_df(spark, d)


# ---- labels -----------------------------------------------------------------

MORT_SQL = """mort AS (
  SELECT c.subject_id, c.admission_id,
    coalesce(e.expire_flag = 1, false) AS in_stay,
    coalesce(s.dod <= c.dischtime + INTERVAL 30 DAY, false) AS after30,
    coalesce(s.dod < c.dischtime, false) AS before_disch,
    e.expire_flag IS NULL AS flag_missing, s.dod IS NULL OR c.dischtime IS NULL AS time_missing
  FROM cohort c LEFT JOIN episodes e ON c.admission_id = e.admission_id
  LEFT JOIN subjects s ON c.subject_id = s.subject_id)"""


@register("mortality", A.with_(*A.COHORT_CHAIN, MORT_SQL) + """
SELECT subject_id, admission_id, in_stay OR after30 AS mortality FROM mort""")
def q_mortality(spark, d):
    return L.mortality(cohort_df(spark, d), ad.episodes(spark, d), ad.subjects(spark, d)) \
        .select("subject_id", "admission_id", "mortality")


@register("prolonged_stay", A.with_(*A.COHORT_CHAIN) + """
SELECT subject_id, admission_id, coalesce(dischtime > admittime + INTERVAL 7 DAY, false) AS prolonged_stay FROM cohort""")
def q_prolonged_stay(spark, d):
    return L.prolonged_stay(cohort_df(spark, d))


READMIT_SQL = """readm AS (
  SELECT c.subject_id, s.second_admission_id,
    coalesce(s.second_admittime IS NOT NULL AND s.second_admittime < c.dischtime, false) AS bad_order,
    coalesce(s.nonpositive_duration, false) AS bad_duration,
    coalesce(s.second_admittime IS NOT NULL AND NOT (s.second_admittime < c.dischtime)
             AND NOT coalesce(s.nonpositive_duration, false)
             AND CAST(s.second_admittime AS DATE) <= CAST(c.dischtime AS DATE) + 30, false) AS readmission,
    s.second_admittime IS NULL OR c.dischtime IS NULL AS time_missing
  FROM cohort c LEFT JOIN second_ep s ON c.subject_id = s.subject_id)"""


@register("readmission", A.with_(*A.COHORT_CHAIN, A.SECOND, READMIT_SQL) + """
SELECT subject_id, second_admission_id, readmission FROM readm""")
def q_readmission(spark, d):
    return L.readmission(cohort_df(spark, d), second_df(spark, d)) \
        .select("subject_id", "second_admission_id", "readmission")


@register("label_audit", A.with_(*A.COHORT_CHAIN, A.SECOND, MORT_SQL, READMIT_SQL) + """
SELECT 'mortality' AS label, count(*) FILTER (WHERE in_stay OR after30) AS positives,
       count(*) FILTER (WHERE NOT (in_stay OR after30)) AS negatives,
       count(*) FILTER (WHERE in_stay AND after30) AS overlap,
       count(*) FILTER (WHERE NOT in_stay AND before_disch) AS flagged,
       count(*) FILTER (WHERE flag_missing) AS flag_missing, count(*) FILTER (WHERE time_missing) AS time_missing,
       round(count(*) FILTER (WHERE in_stay OR after30) * 100.0 / count(*), 6) AS positive_pct FROM mort
UNION ALL
SELECT 'prolonged_stay', count(*) FILTER (WHERE coalesce(dischtime > admittime + INTERVAL 7 DAY, false)),
       count(*) FILTER (WHERE NOT coalesce(dischtime > admittime + INTERVAL 7 DAY, false)), 0, 0, 0,
       count(*) FILTER (WHERE admittime IS NULL OR dischtime IS NULL),
       round(count(*) FILTER (WHERE coalesce(dischtime > admittime + INTERVAL 7 DAY, false)) * 100.0 / count(*), 6)
FROM cohort
UNION ALL
SELECT 'readmission', count(*) FILTER (WHERE readmission), count(*) FILTER (WHERE NOT readmission),
       count(*) FILTER (WHERE bad_order AND bad_duration), count(*) FILTER (WHERE bad_order OR bad_duration),
       0, count(*) FILTER (WHERE time_missing), round(count(*) FILTER (WHERE readmission) * 100.0 / count(*), 6) FROM readm""")
def q_label_audit(spark, d):
    c, second = materialize(cohort_df(spark, d)), materialize(second_df(spark, d))
    return L.label_audit(L.mortality(c, ad.episodes(spark, d), ad.subjects(spark, d)),
                         L.prolonged_stay(c, audit=True), L.readmission(c, second))
