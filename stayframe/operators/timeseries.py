"""Windowed time-series features (F0-F18), one implementation for every
measurement source.

Plan shape: rows -> groupBy(subject, feature, window) with map-side partial
aggregation (a hot subject collapses to features x windows rows before the
shuffle) -> per subject, a map of at most features x windows entries ->
plain column arithmetic for fill, admission-level stats and diffs. Two
shuffles, no window function, no Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.operators.extract import assign_window, rejoin_two_keys

EPS = 1e-8
WINDOW_STATS = ["n_measurements", "min", "max", "mean", "std"]
ADMISSION_STATS = ["n_admission_measurements", "first_admission_measurement",
                   "last_admission_measurement", "difference_last_first_admission_measurements"]
DIFF_STATS = ["baseline_mean", "previous_mean", "sign_mean"]
FILLED = ["min", "max", "mean", "std"]


def drop_unnamed(rows: DataFrame, value: str = "valuenum") -> DataFrame:
    """rows with a null feature name or value do not enter aggregates."""
    return rows.where(F.col("feature_name").isNotNull() & F.col(value).isNotNull())


def _tiebreak(rows: DataFrame) -> F.Column:
    tb = F.col("row_id") if "row_id" in rows.columns else F.col("valuenum")
    return F.struct(F.col("charttime").alias("t"), tb.alias("k"))


def window_stats(rows: DataFrame) -> DataFrame:
    """F1/F2/F5 per (subject, feature, window): n, min, max, mean, sample
    std (0 when n = 1), first and last value by (time, row id)."""
    v = F.col("valuenum")
    order = _tiebreak(rows)
    return (rows.groupBy("subject_id", "feature_name", "window")
            .agg(F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"),
                 F.avg(v).alias("mean"),
                 F.when(F.count(v) == 1, F.lit(0.0)).otherwise(F.stddev_samp(v)).alias("std"),
                 F.min_by(v, order).alias("first"), F.max_by(v, order).alias("last")))


def admission_stats(rows: DataFrame) -> DataFrame:
    """F1/F2/F3 over the whole observation window, per (subject, feature)."""
    v = F.col("valuenum")
    order = _tiebreak(rows)
    out = (rows.groupBy("subject_id", "feature_name")
           .agg(F.count(v).alias("n"), F.min_by(v, order).alias("first"), F.max_by(v, order).alias("last")))
    return out.withColumn("difference", F.col("last") - F.col("first"))


def _key(feature: str, w: int) -> str:
    return f"{feature}\u0001{w}"


def _q(name: str) -> str:
    """Backtick-quoted identifier for SQL expression strings."""
    return "`" + name.replace("`", "``") + "`"


def _lit(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def wide_block(stats: DataFrame, features: list[str], n_windows: int = 4, eps: float = EPS) -> DataFrame:
    """F4/F6-F11 on one row per subject. The per-subject map holds at most
    ``len(features) * n_windows`` entries, so collecting it is bounded.
    Three flat projections (raw lookups -> fill and admission stats ->
    diffs), each sent as one ``selectExpr`` so building a block of hundreds
    of columns costs three driver round trips, not thousands."""
    entry = F.struct(
        F.concat_ws("\u0001", F.col("feature_name"), F.col("window").cast("string")).alias("key"),
        F.struct("n", "min", "max", "mean", "std", "first", "last").alias("value"))
    per_subject = stats.groupBy("subject_id").agg(F.map_from_entries(F.collect_list(entry)).alias("m"))

    def raw(fi, w, s_):
        return f"__r{fi}_{w}_{s_}"

    step1 = ["subject_id"]
    for fi, f in enumerate(features):
        for w in range(n_windows):
            key = f"concat({_lit(f)}, char(1), '{w}')"
            for s_ in ("n", "min", "max", "mean", "std", "first", "last"):
                step1.append(f"m[{key}].{s_} AS {raw(fi, w, s_)}")
    step2 = ["subject_id"]
    for fi, f in enumerate(features):
        n = [f"CAST(coalesce({raw(fi, w, 'n')}, 0) AS BIGINT)" for w in range(n_windows)]
        first = "coalesce(" + ", ".join(raw(fi, w, "first") for w in range(n_windows)) + ")"
        last = "coalesce(" + ", ".join(raw(fi, w, "last") for w in reversed(range(n_windows))) + ")"
        step2 += [f"{' + '.join(n)} AS {_q(f + '_n_admission_measurements')}",
                  f"{first} AS {_q(f + '_first_admission_measurement')}",
                  f"{last} AS {_q(f + '_last_admission_measurement')}",
                  f"{last} - {first} AS {_q(f + '_difference_last_first_admission_measurements')}"]
        for w in range(n_windows):
            step2.append(f"{n[w]} AS {_q(f'{f}_window{w}_n_measurements')}")
            for s_ in FILLED:
                refs = ", ".join(raw(fi, j, s_) for j in range(w, -1, -1))
                step2.append(f"coalesce({refs}) AS {_q(f'{f}_window{w}_{s_}')}")
    step3 = []
    for f in features:
        means = [_q(f"{f}_window{w}_mean") for w in range(n_windows)]
        for i in range(n_windows - 1):
            prev = f"({means[i + 1]} - {means[i]})"
            step3 += [f"{means[0]} - {means[i + 1]} AS {_q(f'{f}_diff{i}_baseline_mean')}",
                      f"{prev} AS {_q(f'{f}_diff{i}_previous_mean')}",
                      f"CASE WHEN {prev} IS NULL THEN NULL WHEN {prev} > {eps!r} THEN 'POS' "
                      f"WHEN {prev} < {-eps!r} THEN 'NEG' ELSE 'ZERO' END AS {_q(f'{f}_diff{i}_sign_mean')}"]
    wide = per_subject.selectExpr(*step1).selectExpr(*step2)
    return wide.selectExpr("*", *step3)


def feature_columns(features: list[str], n_windows: int = 4) -> list[str]:
    """feature-major order: admission, windows, diffs."""
    out = []
    for f in features:
        out += [f"{f}_{s}" for s in ADMISSION_STATS]
        for w in range(n_windows):
            out += [f"{f}_window{w}_{s}" for s in WINDOW_STATS]
        for i in range(n_windows - 1):
            out += [f"{f}_diff{i}_{s}" for s in DIFF_STATS]
    return out


def count_columns(features: list[str], n_windows: int = 4) -> list[str]:
    return [c for c in feature_columns(features, n_windows)
            if c.endswith("_n_measurements") or c.endswith("_n_admission_measurements")]


def observed_rows(measurements: DataFrame, cohort: DataFrame, window_hours: float = 12.0,
                  n_windows: int = 4) -> DataFrame:
    """X6 + X7 + F0: rows in ``[0, window_hours * n_windows)`` with a window
    number, unnamed / valueless rows removed."""
    rows = rejoin_two_keys(measurements, cohort, window_hours * n_windows)
    return drop_unnamed(assign_window(rows, window_hours))


def ts_features(measurements: DataFrame, cohort: DataFrame, features: list[str],
                window_hours: float = 12.0, n_windows: int = 4, eps: float = EPS) -> DataFrame:
    """one row per cohort episode, ``33 * len(features)`` columns for
    four windows. Counts are filled with 0 (F14); statistics of windows
    with no data are forward-filled, never back-filled (F7)."""
    rows = observed_rows(measurements, cohort, window_hours, n_windows)
    wide = wide_block(window_stats(rows), features, n_windows, eps)
    base = cohort.select("subject_id", "admission_id").distinct()
    out = base.join(wide, "subject_id", "left")
    counts = count_columns(features, n_windows)
    out = out.fillna(0, subset=counts)
    return out.select("subject_id", "admission_id",
                      *[F.col(f"`{c}`") for c in feature_columns(features, n_windows)])


def top_measured(block: DataFrame, features: list[str], k: int = 10) -> DataFrame:
    """top-k features by total admission-level count."""
    long = block.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature_name"), F.col(f"`{f}_n_admission_measurements`").alias("n"))
        for f in features])).alias("kv")).select("kv.*")
    return (long.groupBy("feature_name").agg(F.sum("n").alias("total_n"))
            .orderBy(F.desc("total_n"), "feature_name").limit(k))


def null_fractions(block: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """F16: share of nulls per column in one aggregation, then unpivoted."""
    columns = columns or [c for c in block.columns if c not in ("subject_id", "admission_id")]
    agg = block.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"c{i}")
                      for i, c in enumerate(columns)])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("null_fraction"))
        for i, c in enumerate(columns)])).alias("kv")).select("kv.*")


def coverage_stats(block: DataFrame, features: list[str]) -> DataFrame:
    """subjects with zero / any data; share of unmeasured features per
    subject summarised by mean/min/max."""
    counts = [F.col(f"`{f}_n_admission_measurements`") for f in features]
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    zero = counts[0].__eq__(0).cast("int")
    for c in counts[1:]:
        zero = zero + (c == 0).cast("int")
    per = block.select(total.alias("total"), (zero / F.lit(float(len(features)))).alias("missing_frac"))
    return per.agg(F.count_if(F.col("total") == 0).alias("subjects_zero"),
                   F.count_if(F.col("total") > 0).alias("subjects_any"),
                   F.avg("missing_frac").alias("missing_mean"),
                   F.min("missing_frac").alias("missing_min"),
                   F.max("missing_frac").alias("missing_max"))


def window_grid(rows: DataFrame, features: list[str], n_windows: int = 4) -> DataFrame:
    """subjects with data x features x windows, n default 0. The
    feature x window grid is config-sized, so it is broadcast."""
    spark = rows.sparkSession
    grid = spark.createDataFrame([(f, w) for f in features for w in range(n_windows)],
                                 "feature_name string, window int")
    subj = rows.select("subject_id").distinct()
    n = rows.groupBy("subject_id", "feature_name", "window").agg(F.count(F.lit(1)).alias("n"))
    full = subj.crossJoin(F.broadcast(grid))
    return (full.join(n, ["subject_id", "feature_name", "window"], "left")
            .select("subject_id", "feature_name", "window", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def ffill_long(rows: DataFrame, features: list[str], n_windows: int = 4) -> DataFrame:
    """F7 in long form: grid + stats, then ``last(ignoreNulls)`` over the
    rows up to the current window. Each window partition holds exactly
    ``n_windows`` rows, so the frame is bounded whatever the data."""
    from pyspark.sql import Window
    spark = rows.sparkSession
    grid = spark.createDataFrame([(f, w) for f in features for w in range(n_windows)],
                                 "feature_name string, window int")
    full = rows.select("subject_id").distinct().crossJoin(F.broadcast(grid))
    st = window_stats(rows)
    j = full.join(st, ["subject_id", "feature_name", "window"], "left")
    w = (Window.partitionBy("subject_id", "feature_name").orderBy("window")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return j.select("subject_id", "feature_name", "window",
                    *[F.last(s, ignorenulls=True).over(w).alias(s) for s in FILLED])
