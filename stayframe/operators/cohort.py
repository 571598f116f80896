"""Cohort selection over subjects x episodes.

Per-subject picks (first / n-th episode) are aggregations of an ordering
struct, not windows: ``min(struct(...))`` combines map-side, so a subject
that owns a third of all episodes never lands in one task whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayframe.functions.expressions import age_years, hours_between, null_safe_flag

MIN_STAY_HOURS = 54.0
AGE_MIN, AGE_MAX = 18, 89
COHORT_COLUMNS = ["subject_id", "admission_id", "admittime", "dischtime"]


def restrict_to_ids(df: DataFrame, ids: DataFrame, key: str = "subject_id") -> DataFrame:
    """Rows whose key is in the id table (semi join, never an IN list)."""
    return df.join(ids.select(key), key, "left_semi")


def _order_key(nulls_last: bool) -> F.Column:
    t = F.col("admittime")
    if nulls_last:
        return F.struct(t.isNull().alias("t_null"), t.alias("t"), F.col("admission_id").alias("a"))
    return F.struct(t.alias("t"), F.col("admission_id").alias("a"))


def _pick_min(episodes: DataFrame, nulls_last: bool) -> DataFrame:
    picked = (episodes.groupBy("subject_id")
              .agg(F.min(F.struct(_order_key(nulls_last).alias("k"),
                                  F.col("admission_id"), F.col("admittime"), F.col("dischtime"))).alias("m")))
    return picked.select("subject_id", "m.admission_id", "m.admittime", "m.dischtime")


def first_episode(episodes: DataFrame) -> DataFrame:
    """Earliest episode per subject by (start, id); null starts dropped
    first."""
    return _pick_min(episodes.where(F.col("admittime").isNotNull()), nulls_last=False)


def nth_episode(episodes: DataFrame, n: int = 2) -> DataFrame:
    """C3 core: n-th episode per subject ordered by (start NULLS LAST, id).
    Spark keeps only the first ``n`` rows of each subject before the shuffle."""
    place = F.row_number().over(Window.partitionBy("subject_id").orderBy(F.col("admittime").asc_nulls_last(), "admission_id"))
    return (episodes.select("subject_id", "admission_id", "admittime", "dischtime").withColumn("__n", place)
            .where(F.col("__n") <= n).where(F.col("__n") == n).drop("__n"))


def second_episode(cohort: DataFrame, episodes: DataFrame, n: int = 2) -> DataFrame:
    """C3 + C11: every cohort subject with its n-th episode (or nulls) and a
    ``nonpositive_duration`` flag that is true only when id and both times
    are present and end <= start."""
    subj = cohort.select("subject_id").distinct()
    cand = restrict_to_ids(episodes, subj)
    nth = nth_episode(cand, n).select(
        "subject_id",
        F.col("admission_id").alias("second_admission_id"),
        F.col("admittime").alias("second_admittime"),
        F.col("dischtime").alias("second_dischtime"))
    out = subj.join(nth, "subject_id", "left")
    return out.withColumn("nonpositive_duration", nonpositive_flag(
        "second_admission_id", "second_admittime", "second_dischtime"))


def nonpositive_flag(id_col: str, start: str, end: str) -> F.Column:
    """C11: end <= start when id and both times are present, else false."""
    have = F.col(id_col).isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull()
    return null_safe_flag(have & (F.col(end) <= F.col(start)))


def null_time_audit(second: DataFrame) -> DataFrame:
    """Rows with an episode id but a missing time."""
    return second.where(F.col("second_admission_id").isNotNull()
                        & (F.col("second_admittime").isNull() | F.col("second_dischtime").isNull()))


def missing_subjects(ids: DataFrame, first: DataFrame, key: str = "subject_id") -> DataFrame:
    """C4: ids with no (timed) episode."""
    return ids.select(key).join(first.select(key), key, "left_anti")


def episode_duration(first: DataFrame) -> DataFrame:
    """Duration in hours; rows with a missing time or a non-positive
    duration are dropped (``duration_audit`` reports them)."""
    timed = first.where(F.col("admittime").isNotNull() & F.col("dischtime").isNotNull())
    with_d = timed.withColumn("duration_hours", hours_between("admittime", "dischtime"))
    return with_d.where(F.col("duration_hours") > 0)


def duration_audit(first: DataFrame) -> DataFrame:
    """Ledger for C5: counts of missing times and non-positive durations."""
    d = hours_between("admittime", "dischtime")
    return first.agg(
        F.count(F.lit(1)).alias("n_first"),
        F.count_if(F.col("admittime").isNull() | F.col("dischtime").isNull()).alias("n_missing_time"),
        F.count_if(d <= 0).alias("n_nonpositive"),
    )


def min_duration_filter(with_duration: DataFrame, min_hours: float = MIN_STAY_HOURS) -> DataFrame:
    """Keep stays of at least ``min_hours`` (inclusive)."""
    return with_duration.where(F.col("duration_hours") >= F.lit(min_hours))


def age_at(df: DataFrame, subjects: DataFrame, at: str = "admittime") -> DataFrame:
    """Attach dob and whole-year age at ``at``."""
    j = df.join(subjects.select("subject_id", "dob"), "subject_id", "left")
    return j.withColumn("age", age_years(at, "dob"))


def drop_reason(age: str = "age", lo: int = AGE_MIN, hi: int = AGE_MAX) -> F.Column:
    """First matching reason, null when kept."""
    a = F.col(age)
    return (F.when(a.isNull(), "na_age").when(a < 0, "negative_age")
            .when(a < lo, "under18").when(a > hi, "age90plus"))


def with_drop_reason(aged: DataFrame) -> DataFrame:
    return aged.withColumn("drop_reason", drop_reason())


def drop_reason_counts(reasoned: DataFrame) -> DataFrame:
    """Attrition ledger, one row per reason (kept rows as ``keep``)."""
    return (reasoned.groupBy(F.coalesce("drop_reason", F.lit("keep")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


def age_filter(reasoned: DataFrame) -> DataFrame:
    """Keep rows with no drop reason, cohort columns only."""
    return reasoned.where(F.col("drop_reason").isNull()).select(*COHORT_COLUMNS)


def build_cohort(episodes: DataFrame, subjects: DataFrame, ids: DataFrame | None = None,
                 min_hours: float = MIN_STAY_HOURS) -> DataFrame:
    """Ids -> first episode -> duration >= min_hours -> age 18..89."""
    eps = restrict_to_ids(episodes, ids) if ids is not None else episodes
    first = first_episode(eps)
    long_enough = min_duration_filter(episode_duration(first), min_hours)
    return age_filter(with_drop_reason(age_at(long_enough, subjects)))
