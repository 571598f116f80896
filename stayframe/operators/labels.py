"""Outcome labels (L1-L4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.functions.expressions import null_safe_flag

MORTALITY_DAYS = 30
PROLONGED_DAYS = 7
READMIT_DAYS = 30


def mortality(cohort: DataFrame, episodes: DataFrame, subjects: DataFrame,
              days: int = MORTALITY_DAYS) -> DataFrame:
    """L1: in-stay flag = 1, or death time <= discharge + ``days`` (exact
    time, no lower bound). Missing values count as false."""
    j = (cohort.select("subject_id", "admission_id", "dischtime")
         .join(episodes.select("admission_id", "expire_flag"), "admission_id", "left")
         .join(subjects.select("subject_id", "dod"), "subject_id", "left"))
    in_stay = null_safe_flag(F.col("expire_flag") == 1)
    after = null_safe_flag(F.col("dod") <= F.timestamp_add("DAY", F.lit(days), F.col("dischtime")))
    return j.select("subject_id", "admission_id",
                    (in_stay | (~in_stay & after)).alias("mortality"),
                    in_stay.alias("death_in_stay"), (~in_stay & after).alias("death_after"),
                    after.alias("death_within_window"),
                    null_safe_flag(~in_stay & (F.col("dod") < F.col("dischtime"))).alias("death_before_discharge"),
                    F.col("expire_flag").isNull().alias("flag_missing"),
                    (F.col("dod").isNull() | F.col("dischtime").isNull()).alias("time_missing"))


def prolonged_stay(cohort: DataFrame, days: int = PROLONGED_DAYS, audit: bool = False) -> DataFrame:
    """L2: end > start + ``days`` (strict); with ``audit`` also whether one of
    the times is missing."""
    missing = [(F.col("admittime").isNull() | F.col("dischtime").isNull()).alias("time_missing")] if audit else []
    return cohort.select("subject_id", "admission_id", null_safe_flag(
        F.col("dischtime") > F.timestamp_add("DAY", F.lit(days), F.col("admittime"))).alias("prolonged_stay"), *missing)


def readmission(cohort: DataFrame, second: DataFrame, days: int = READMIT_DAYS) -> DataFrame:
    """L3: calendar-date rule date(second start) <= date(end) + days, only
    when the second start is known, not before discharge, and the second
    stay has a positive duration."""
    j = cohort.select("subject_id", "dischtime").join(
        second.select("subject_id", "second_admission_id", "second_admittime", "nonpositive_duration"),
        "subject_id", "left")
    has = F.col("second_admittime").isNotNull()
    bad_order = null_safe_flag(has & (F.col("second_admittime") < F.col("dischtime")))
    bad_dur = F.coalesce(F.col("nonpositive_duration"), F.lit(False))
    good = has & ~bad_order & ~bad_dur
    within = good & null_safe_flag(
        F.to_date("second_admittime") <= F.date_add(F.to_date("dischtime"), days))
    return j.select("subject_id", "second_admission_id", within.alias("readmission"),
                    bad_order.alias("bad_order"), bad_dur.alias("bad_duration"),
                    (F.col("second_admittime").isNull() | F.col("dischtime").isNull()).alias("time_missing"))


def label_audit(mort: DataFrame, prolonged: DataFrame, readmit: DataFrame) -> DataFrame:
    """L4: positives/negatives, positive share, overlap, data flags, rows whose
    source flag or whose compared times are missing; one row per label,
    computed as conditional counts (no per-row driver work)."""
    m = mort.agg(
        F.lit("mortality").alias("label"),
        F.count_if(F.col("mortality")).alias("positives"),
        F.count_if(~F.col("mortality")).alias("negatives"),
        F.count_if(F.col("death_in_stay") & F.col("death_within_window")).alias("overlap"),
        F.count_if(F.col("death_before_discharge")).alias("flagged"),
        F.count_if(F.col("flag_missing")).alias("flag_missing"), F.count_if(F.col("time_missing")).alias("time_missing"))
    p = prolonged.agg(
        F.lit("prolonged_stay").alias("label"),
        F.count_if(F.col("prolonged_stay")).alias("positives"),
        F.count_if(~F.col("prolonged_stay")).alias("negatives"),
        F.lit(0).cast("bigint").alias("overlap"),
        F.lit(0).cast("bigint").alias("flagged"), F.lit(0).cast("bigint").alias("flag_missing"), F.count_if(F.col("time_missing")).alias("time_missing"))
    r = readmit.agg(
        F.lit("readmission").alias("label"),
        F.count_if(F.col("readmission")).alias("positives"),
        F.count_if(~F.col("readmission")).alias("negatives"),
        F.count_if(F.col("bad_order") & F.col("bad_duration")).alias("overlap"),
        F.count_if(F.col("bad_order") | F.col("bad_duration")).alias("flagged"),
        F.lit(0).cast("bigint").alias("flag_missing"), F.count_if(F.col("time_missing")).alias("time_missing"))
    out = m.unionByName(p).unionByName(r)
    return out.withColumn("positive_pct", F.round(
        F.col("positives") * 100.0 / F.nullif(F.col("positives") + F.col("negatives"), F.lit(0)), 6))
