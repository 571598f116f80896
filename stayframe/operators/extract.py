"""Time-window extraction: equi-joins with range predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.functions.expressions import HOUR_US, hours_between, window_index


def _plus_hours(ts: str, hours: float) -> F.Column:
    return F.timestamp_add("MICROSECOND", F.lit(int(round(hours * HOUR_US))), F.col(ts))


def extract_window(measurements: DataFrame, cohort: DataFrame, hours: float = 48.0,
                   items: DataFrame | None = None, closed: bool = False,
                   time_col: str = "charttime", exclude_errors: bool = False) -> DataFrame:
    """X1 (half-open ``start <= t < start + hours``) / X2 (closed, BETWEEN).

    The item filter is a semi join against the (config-sized) dictionary,
    applied before the episode join so it prunes the big side first. The
    episode join is an equi-join on ``admission_id`` with the range as a
    post-join filter; Catalyst/AQE choose broadcast vs. shuffle from the
    cohort's measured size.
    """
    m = measurements
    if exclude_errors and "error" in m.columns:   # Q20: off by default, as in the extracts
        m = m.where(~F.col("error").eqNullSafe(1))
    if items is not None:
        m = m.join(items.select("itemid").distinct(), "itemid", "left_semi")
    c = cohort.select("admission_id", "admittime")
    j = m.join(c, "admission_id", "inner")
    t, start = F.col(time_col), F.col("admittime")
    end = _plus_hours("admittime", hours)
    cond = t.between(start, end) if closed else (t >= start) & (t < end)
    return j.where(cond)


def exclude_error_rows(df: DataFrame, col: str = "iserror", variant: str = "coalesce") -> DataFrame:
    """``coalesce(err, 0) <> 1`` or ``err IS DISTINCT FROM 1``. Both keep
    nulls; they differ only in typing of odd inputs."""
    if variant == "coalesce":
        return df.where(F.coalesce(F.col(col).try_cast("int"), F.lit(0)) != 1)
    return df.where(~F.col(col).eqNullSafe(1))


def extract_notes(notes: DataFrame, cohort: DataFrame, hours: float = 48.0,
                  fallback_days: int = 1) -> DataFrame:
    """Two-key join; keep timed notes in ``[start, start + hours)``, or,
    when the time is null, notes dated between date(start) and
    date(start + fallback_days) inclusive. Error rows are dropped first."""
    n = exclude_error_rows(notes)
    c = cohort.select("subject_id", "admission_id", "admittime")
    j = n.join(c, ["subject_id", "admission_id"], "inner")
    t, start = F.col("charttime"), F.col("admittime")
    timed = t.isNotNull() & (t >= start) & (t < _plus_hours("admittime", hours))
    by_date = t.isNull() & F.col("chartdate").between(
        F.to_date(start), F.to_date(F.timestamp_add("DAY", F.lit(fallback_days), start)))
    out = j.where(timed | by_date)
    return (out.withColumn("kept_via_chartdate_fallback", t.isNull())
            .withColumn("hours_since_admit", F.when(t.isNotNull(), hours_between("admittime", "charttime"))))


def interval_overlap(intervals: DataFrame, cohort: DataFrame, hours: float = 48.0) -> DataFrame:
    """Clip each interval to ``[start, start + hours]``; keep positive
    overlaps; hours = minute boundaries / 60. greatest/least skip nulls, so
    a null end means "until the window end" (Q4)."""
    c = cohort.select("admission_id", "admittime")
    j = intervals.join(c, "admission_id", "inner")
    ws, we = F.col("admittime"), _plus_hours("admittime", hours)
    j = (j.withColumn("overlap_start", F.greatest(F.col("startdate"), ws))
         .withColumn("overlap_end", F.least(F.col("enddate"), we)))
    j = j.where(F.col("overlap_start").isNotNull() & F.col("overlap_end").isNotNull()
                & (F.col("overlap_end") > F.col("overlap_start")))
    minutes = F.timestamp_diff("MINUTE", F.date_trunc("minute", F.col("overlap_start")),
                              F.date_trunc("minute", F.col("overlap_end")))
    return j.withColumn("overlap_hours", minutes.cast("double") / 60.0)


def rejoin_two_keys(rows: DataFrame, cohort: DataFrame, hours: float = 48.0,
                    time_col: str = "charttime") -> DataFrame:
    """X6 + X8: inner join on (admission, subject), hours since start,
    keep ``0 <= h < hours``."""
    c = cohort.select("subject_id", "admission_id", "admittime")
    j = rows.join(c, ["admission_id", "subject_id"], "inner")
    j = j.withColumn("hours_since_admit", hours_between("admittime", time_col))
    return j.where((F.col("hours_since_admit") >= 0) & (F.col("hours_since_admit") < hours))


def assign_window(rows: DataFrame, window_hours: float = 12.0, time_col: str = "charttime") -> DataFrame:
    """Left-closed window number from exact microsecond arithmetic."""
    return rows.withColumn("window", window_index("admittime", time_col, window_hours))


def note_window_stats(kept: DataFrame) -> DataFrame:
    """Per (path, category): notes, episodes with notes, min/p50/p90/max
    hours since start (exact percentiles over timed notes)."""
    from stayframe.operators.prefix import exact_quantiles
    path = F.when(F.col("kept_via_chartdate_fallback"), "chartdate").otherwise("charttime")
    k = kept.withColumn("path", path)
    h = F.col("hours_since_admit")
    counts = (k.groupBy("path", "category")
              .agg(F.count(F.lit(1)).alias("n_notes"), F.count_distinct("admission_id").alias("n_episodes"),
                   F.min(h).alias("min_hours"), F.max(h).alias("max_hours")))
    # exact quantiles without collecting a category's values in one task
    qs = exact_quantiles(k, ["path", "category"], "hours_since_admit", {"p50_hours": 0.5, "p90_hours": 0.9})
    out = counts.join(qs, ["path", "category"], "left")
    return out.select("path", "category", "n_notes", "n_episodes", "min_hours", "p50_hours", "p90_hours",
                      "max_hours")
