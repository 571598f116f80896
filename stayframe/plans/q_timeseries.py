"""Extraction and windowed time-series queries over the events adapter
(X1, X2, X6-X8, F0-F18). Two window sets: 48 h (sparse) and 480 h (dense),
four windows each."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.operators import clean as M
from stayframe.operators import extract as X
from stayframe.operators import timeseries as TS
from stayframe.operators.prepare import non_null_counts
from stayframe.plans import sql_adapters as A
from stayframe.plans.registry import register, round_sql
from stayframe.sources import adapters as ad

FEATURES = ["click", "error", "purchase", "signup", "view"]
DENSE_H, SPARSE_H = 120.0, 12.0
HOUR_US = 3_600_000_000


def _rows(spark, d, window_hours=DENSE_H):
    return TS.observed_rows(ad.measurements(spark, d), ad.measurement_episodes(spark, d), window_hours, 4)


def _block(spark, d, window_hours=DENSE_H, features=FEATURES):
    return TS.ts_features(ad.measurements(spark, d), ad.measurement_episodes(spark, d), features,
                          window_hours, 4)


# ---- oracle SQL generators ------------------------------------------------------

def rows_sql(window_hours: float) -> str:
    w = int(window_hours * HOUR_US)
    return f"""rws AS (
  SELECT m.subject_id, m.feature_name, m.valuenum, m.charttime, m.row_id,
         (epoch_us(m.charttime) - epoch_us(c.admittime)) // {w} AS win
  FROM meas m JOIN mcohort c ON m.admission_id = c.admission_id AND m.subject_id = c.subject_id
  WHERE epoch_us(m.charttime) - epoch_us(c.admittime) >= 0
    AND epoch_us(m.charttime) - epoch_us(c.admittime) < {w * 4}
    AND m.feature_name IS NOT NULL AND m.valuenum IS NOT NULL)"""


STATS_SQL = """st AS (
  SELECT subject_id, feature_name, win, count(valuenum) AS n, min(valuenum) AS mn, max(valuenum) AS mx,
         avg(valuenum) AS mean, CASE WHEN count(valuenum) = 1 THEN 0.0 ELSE stddev_samp(valuenum) END AS sd,
         min(charttime) AS t_first, max(charttime) AS t_last
  FROM rws GROUP BY subject_id, feature_name, win)"""

FIRSTLAST_SQL = """fl AS (
  SELECT subject_id, feature_name, win,
         max(CASE WHEN rk_first = 1 THEN valuenum END) AS fv, max(CASE WHEN rk_last = 1 THEN valuenum END) AS lv
  FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, feature_name, win ORDER BY charttime, row_id) AS rk_first,
               row_number() OVER (PARTITION BY subject_id, feature_name, win ORDER BY charttime DESC, row_id DESC) AS rk_last
        FROM rws) z GROUP BY subject_id, feature_name, win)"""


def _q(s: str) -> str:
    return '"' + s + '"'


def wide_sql(window_hours: float, features=FEATURES, n_windows: int = 4) -> tuple[str, list[str]]:
    """Conditional aggregation per subject, then fill/diff arithmetic."""
    piv = []
    for f in features:
        for w in range(n_windows):
            cond = f"feature_name = '{f}' AND win = {w}"
            for src, dst in [("n", "n"), ("mn", "min"), ("mx", "max"), ("mean", "mean"), ("sd", "std"),
                             ("fv", "first"), ("lv", "last")]:
                piv.append(f"max(CASE WHEN {cond} THEN {src} END) AS {_q(f'{f}|{w}|{dst}')}")
    cols, dbl = [], []
    for f in features:
        g = lambda w, s: _q(f"{f}|{w}|{s}")
        n = [f"coalesce({g(w, 'n')}, 0)" for w in range(n_windows)]
        first = "coalesce(" + ", ".join(g(w, "first") for w in range(n_windows)) + ")"
        last = "coalesce(" + ", ".join(g(w, "last") for w in reversed(range(n_windows))) + ")"
        cols += [f"CAST({' + '.join(n)} AS BIGINT) AS {_q(f + '_n_admission_measurements')}",
                 f"{first} AS {_q(f + '_first_admission_measurement')}",
                 f"{last} AS {_q(f + '_last_admission_measurement')}",
                 f"{last} - {first} AS {_q(f + '_difference_last_first_admission_measurements')}"]
        dbl += [f + "_first_admission_measurement", f + "_last_admission_measurement",
                f + "_difference_last_first_admission_measurements"]

        def filled(s, w):
            return "coalesce(" + ", ".join(g(j, s) for j in range(w, -1, -1)) + ")"
        for w in range(n_windows):
            cols.append(f"CAST({n[w]} AS BIGINT) AS {_q(f'{f}_window{w}_n_measurements')}")
            for s in ["min", "max", "mean", "std"]:
                cols.append(f"{filled(s, w)} AS {_q(f'{f}_window{w}_{s}')}")
                dbl.append(f"{f}_window{w}_{s}")
        for i in range(n_windows - 1):
            prev = f"({filled('mean', i + 1)} - {filled('mean', i)})"
            cols += [f"{filled('mean', 0)} - {filled('mean', i + 1)} AS {_q(f'{f}_diff{i}_baseline_mean')}",
                     f"{prev} AS {_q(f'{f}_diff{i}_previous_mean')}",
                     f"CASE WHEN {prev} IS NULL THEN NULL WHEN {prev} > 1e-8 THEN 'POS' WHEN {prev} < -1e-8 THEN 'NEG' "
                     f"ELSE 'ZERO' END AS {_q(f'{f}_diff{i}_sign_mean')}"]
            dbl += [f"{f}_diff{i}_baseline_mean", f"{f}_diff{i}_previous_mean"]
    sql = (A.with_(A.MEASUREMENTS, A.MEAS_COHORT, rows_sql(window_hours), STATS_SQL, FIRSTLAST_SQL,
                   f"""pv AS (SELECT s.subject_id, {', '.join(piv)}
  FROM st s JOIN fl USING (subject_id, feature_name, win) GROUP BY s.subject_id)""")
           + f"SELECT c.subject_id, c.admission_id, {', '.join(cols)}\n"
             f"FROM (SELECT DISTINCT subject_id, admission_id FROM mcohort) c LEFT JOIN pv ON c.subject_id = pv.subject_id")
    return sql, dbl


def _wide_subset(window_hours, pick):
    sql, dbl = wide_sql(window_hours)
    cols = [c for c in TS.feature_columns(FEATURES) if pick(c)]
    inner = f"SELECT subject_id, {', '.join(_q(c) for c in cols)} FROM ({sql}) w"
    return round_sql(inner, [c for c in dbl if c in cols])


def _full(window_hours):
    sql, dbl = wide_sql(window_hours)
    return round_sql(sql, dbl)


# ---- extraction ---------------------------------------------------------------

@register("extract_window_halfopen", A.with_(A.MEASUREMENTS, A.MEAS_COHORT) + """
SELECT m.subject_id, m.row_id, m.feature_name FROM meas m JOIN mcohort c ON m.admission_id = c.admission_id
WHERE m.feature_name IN ('click', 'error', 'view')
  AND m.charttime >= c.admittime AND m.charttime < c.admittime + INTERVAL 48 HOUR""")
def q_extract_window_halfopen(spark, d):
    """Item semi join, then episode equi-join with a half-open range."""
    items = spark.createDataFrame([(i,) for i in ["click", "error", "view"]], "itemid string")
    return X.extract_window(ad.measurements(spark, d), ad.measurement_episodes(spark, d), 48.0, items) \
        .select("subject_id", "row_id", "feature_name")


@register("extract_to_parquet", A.with_(A.MEASUREMENTS, A.MEAS_COHORT) + """
SELECT m.subject_id, m.row_id, m.feature_name, m.valuenum FROM meas m JOIN mcohort c ON m.admission_id = c.admission_id
WHERE m.charttime >= c.admittime AND m.charttime < c.admittime + INTERVAL 48 HOUR""")
def q_extract_to_parquet(spark, d):
    """The X1 extract written straight to parquet under the session's
    checkpoint dir (shared storage on a cluster) and read back, so later
    stages start from the written table, not the lineage."""
    import uuid
    from stayframe.session import checkpoint_dir
    from stayframe.sources.io import write_stage
    ext = X.extract_window(ad.measurements(spark, d), ad.measurement_episodes(spark, d), 48.0) \
        .select("subject_id", "row_id", "feature_name", "valuenum")
    path = f"{checkpoint_dir(spark).rstrip('/')}/stages/extract-{uuid.uuid4().hex}"
    return write_stage(ext, path)


@register("extract_window_closed", A.with_(A.MEASUREMENTS, A.MEAS_COHORT) + """
SELECT m.subject_id, m.row_id FROM meas m JOIN mcohort c ON m.admission_id = c.admission_id
WHERE m.charttime BETWEEN c.admittime AND c.admittime + INTERVAL 48 HOUR""")
def q_extract_window_closed(spark, d):
    """Closed interval (start + 48 h included)."""
    return X.extract_window(ad.measurements(spark, d), ad.measurement_episodes(spark, d), 48.0, closed=True) \
        .select("subject_id", "row_id")


@register("rejoin_two_keys", round_sql(A.with_(A.MEASUREMENTS, A.MEAS_COHORT) + """
SELECT m.subject_id, m.row_id, (epoch_us(m.charttime) - epoch_us(c.admittime)) / 3600000000.0 AS hours_since_admit
FROM meas m JOIN mcohort c ON m.admission_id = c.admission_id AND m.subject_id = c.subject_id
WHERE epoch_us(m.charttime) - epoch_us(c.admittime) >= 0
  AND epoch_us(m.charttime) - epoch_us(c.admittime) < 48 * 3600000000""", ["hours_since_admit"]))
def q_rejoin_two_keys(spark, d):
    """X6 (+X8 hours since start)."""
    return X.rejoin_two_keys(ad.measurements(spark, d), ad.measurement_episodes(spark, d), 48.0) \
        .select("subject_id", "row_id", "hours_since_admit")


@register("assign_window", A.with_(A.MEASUREMENTS, A.MEAS_COHORT, rows_sql(DENSE_H)) + """
SELECT win AS "window", count(*) AS n FROM rws GROUP BY 1""")
def q_assign_window(spark, d):
    """Rows per window at 480 h / 4."""
    return _rows(spark, d).groupBy("window").agg(F.count(F.lit(1)).alias("n"))


@register("hours_since_start", round_sql(A.with_(A.MEASUREMENTS, A.MEAS_COHORT) + """
SELECT m.row_id, (epoch_us(m.charttime) - epoch_us(c.admittime)) / 3600000000.0 AS hours
FROM meas m JOIN mcohort c ON m.admission_id = c.admission_id""", ["hours"]))
def q_hours_since_start(spark, d):
    """Fractional hours since episode start for every row."""
    from stayframe.functions.expressions import hours_between
    m = ad.measurements(spark, d).join(ad.measurement_episodes(spark, d).select("admission_id", "admittime"),
                                       "admission_id")
    return m.select("row_id", hours_between("admittime", "charttime").alias("hours"))


# ---- long-form statistics -----------------------------------------------------

@register("drop_unnamed", A.with_(A.DIRTY, A.DICTIONARY, A.MEAS_COHORT) + """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE k.feature_name IS NULL OR m.valuenum IS NULL) AS n_dropped,
       count(*) FILTER (WHERE k.feature_name IS NOT NULL AND m.valuenum IS NOT NULL) AS n_kept
FROM dirty m LEFT JOIN dict k ON m.itemid = k.itemid JOIN mcohort c ON m.admission_id = c.admission_id
WHERE epoch_us(m.charttime) - epoch_us(c.admittime) >= 0
  AND epoch_us(m.charttime) - epoch_us(c.admittime) < 480 * 3600000000""")
def q_drop_unnamed(spark, d):
    """F0 on the dirty view with dictionary names (unmapped items -> null)."""
    named = M.map_feature_name(ad.dirty_measurements(spark, d), ad.dirty_dictionary(spark), policy="keep")
    rows = X.rejoin_two_keys(named, ad.measurement_episodes(spark, d), 480.0)
    kept = TS.drop_unnamed(rows).agg(F.count(F.lit(1)).alias("n_kept"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(kept).select(
        "n_rows", (F.col("n_rows") - F.col("n_kept")).alias("n_dropped"), "n_kept")


@register("count_per_feature", A.with_(A.MEASUREMENTS, A.MEAS_COHORT, rows_sql(DENSE_H)) + """
SELECT subject_id, feature_name, count(*) AS n FROM rws GROUP BY 1, 2""")
def q_count_per_feature(spark, d):
    """F1."""
    return TS.admission_stats(_rows(spark, d)).select("subject_id", "feature_name", "n")


@register("first_last_value", round_sql(A.with_(A.MEASUREMENTS, A.MEAS_COHORT, rows_sql(DENSE_H)) + """
SELECT subject_id, feature_name,
       max(CASE WHEN r1 = 1 THEN valuenum END) AS first_value, max(CASE WHEN r2 = 1 THEN valuenum END) AS last_value
FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, feature_name ORDER BY charttime, row_id) AS r1,
             row_number() OVER (PARTITION BY subject_id, feature_name ORDER BY charttime DESC, row_id DESC) AS r2
      FROM rws) z GROUP BY 1, 2""", ["first_value", "last_value"]))
def q_first_last_value(spark, d):
    """min_by/max_by on (time, row id); no sort, partial aggregation."""
    return TS.admission_stats(_rows(spark, d)).select(
        "subject_id", "feature_name", F.col("first").alias("first_value"), F.col("last").alias("last_value"))


@register("last_minus_first", round_sql(A.with_(A.MEASUREMENTS, A.MEAS_COHORT, rows_sql(DENSE_H)) + """
SELECT subject_id, feature_name, max(CASE WHEN r2 = 1 THEN valuenum END) - max(CASE WHEN r1 = 1 THEN valuenum END) AS difference
FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, feature_name ORDER BY charttime, row_id) AS r1,
             row_number() OVER (PARTITION BY subject_id, feature_name ORDER BY charttime DESC, row_id DESC) AS r2
      FROM rws) z GROUP BY 1, 2""", ["difference"]))
def q_last_minus_first(spark, d):
    """F3."""
    return TS.admission_stats(_rows(spark, d)).select("subject_id", "feature_name", "difference")


@register("subject_feature_grid", A.with_(A.MEASUREMENTS, A.MEAS_COHORT, rows_sql(SPARSE_H)) + """
SELECT c.subject_id, f.feature_name, CAST(coalesce(k.n, 0) AS BIGINT) AS n
FROM (SELECT DISTINCT subject_id FROM mcohort) c
CROSS JOIN (SELECT DISTINCT event_type AS feature_name FROM events) f
LEFT JOIN (SELECT subject_id, feature_name, count(*) AS n FROM rws GROUP BY 1, 2) k
  ON k.subject_id = c.subject_id AND k.feature_name = f.feature_name""")
def q_subject_feature_grid(spark, d):
    """every cohort subject x feature (48 h), counts default 0. The grid
    is implicit in the wide block: unpivot its admission counts."""
    block = _block(spark, d, SPARSE_H)
    return block.select("subject_id", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature_name"), F.col(f"{f}_n_admission_measurements").alias("n"))
        for f in FEATURES])).alias("kv")).select("subject_id", "kv.feature_name", "kv.n")


@register("window_stats", round_sql(A.with_(A.MEASUREMENTS, A.MEAS_COHORT, rows_sql(DENSE_H)) + """
SELECT subject_id, feature_name, win AS "window", count(*) AS n, min(valuenum) AS "min", max(valuenum) AS "max",
       avg(valuenum) AS mean, CASE WHEN count(*) = 1 THEN 0.0 ELSE stddev_samp(valuenum) END AS std
FROM rws GROUP BY 1, 2, 3""", ["min", "max", "mean", "std"]))
def q_window_stats(spark, d):
    """n, min, max, mean, sample std (n = 1 -> 0)."""
    return TS.window_stats(_rows(spark, d)).select("subject_id", "feature_name", "window", "n", "min", "max",
                                                   "mean", "std")


@register("window_grid", A.with_(A.MEASUREMENTS, A.MEAS_COHORT, rows_sql(SPARSE_H)) + """
SELECT s.subject_id, f.feature_name, w.win AS "window", CAST(coalesce(k.n, 0) AS BIGINT) AS n
FROM (SELECT DISTINCT subject_id FROM rws) s
CROSS JOIN (SELECT DISTINCT event_type AS feature_name FROM events) f CROSS JOIN range(4) w(win)
LEFT JOIN (SELECT subject_id, feature_name, win, count(*) AS n FROM rws GROUP BY 1, 2, 3) k
  ON k.subject_id = s.subject_id AND k.feature_name = f.feature_name AND k.win = w.win""")
def q_window_grid(spark, d):
    """subjects with data x features x windows (48 h), n default 0."""
    from stayframe.operators.timeseries import window_grid
    return window_grid(_rows(spark, d, SPARSE_H), FEATURES, 4)


@register("ffill_stats", round_sql(A.with_(A.MEASUREMENTS, A.MEAS_COHORT, rows_sql(SPARSE_H)) + """,
g AS (SELECT s.subject_id, f.feature_name, w.win, k.mn, k.mx, k.mean, k.sd
  FROM (SELECT DISTINCT subject_id FROM rws) s
  CROSS JOIN (SELECT DISTINCT event_type AS feature_name FROM events) f CROSS JOIN range(4) w(win)
  LEFT JOIN (SELECT subject_id, feature_name, win, min(valuenum) AS mn, max(valuenum) AS mx, avg(valuenum) AS mean,
                    CASE WHEN count(*) = 1 THEN 0.0 ELSE stddev_samp(valuenum) END AS sd FROM rws GROUP BY 1, 2, 3) k
  ON k.subject_id = s.subject_id AND k.feature_name = f.feature_name AND k.win = w.win)
SELECT subject_id, feature_name, win AS "window",
  last_value(mn IGNORE NULLS) OVER w AS "min", last_value(mx IGNORE NULLS) OVER w AS "max",
  last_value(mean IGNORE NULLS) OVER w AS mean, last_value(sd IGNORE NULLS) OVER w AS std
FROM g WINDOW w AS (PARTITION BY subject_id, feature_name ORDER BY win ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
                                     ["min", "max", "mean", "std"]))
def q_ffill_stats(spark, d):
    """forward fill over the grid (48 h), long form."""
    from stayframe.operators.timeseries import ffill_long
    return ffill_long(_rows(spark, d, SPARSE_H), FEATURES, 4)


@register("pivot_windows", _wide_subset(SPARSE_H, lambda c: "_window" in c))
def q_pivot_windows(spark, d):
    """F8: ``{feature}_window{i}_{stat}`` columns (48 h)."""
    b = _block(spark, d, SPARSE_H)
    return b.select("subject_id", *[c for c in TS.feature_columns(FEATURES) if "_window" in c])


@register("pivot_admission", _wide_subset(SPARSE_H, lambda c: "admission_measurement" in c))
def q_pivot_admission(spark, d):
    """admission-level columns (48 h)."""
    b = _block(spark, d, SPARSE_H)
    return b.select("subject_id", *[c for c in TS.feature_columns(FEATURES) if "admission_measurement" in c])


@register("window_diffs", _wide_subset(DENSE_H, lambda c: c.endswith("baseline_mean") or c.endswith("previous_mean")))
def q_window_diffs(spark, d):
    """baseline / previous differences on filled means (480 h)."""
    b = _block(spark, d, DENSE_H)
    return b.select("subject_id", *[c for c in TS.feature_columns(FEATURES)
                                    if c.endswith("baseline_mean") or c.endswith("previous_mean")])


@register("sign_label", _wide_subset(DENSE_H, lambda c: c.endswith("sign_mean")))
def q_sign_label(spark, d):
    """POS / NEG / ZERO labels (480 h)."""
    b = _block(spark, d, DENSE_H)
    return b.select("subject_id", *[c for c in TS.feature_columns(FEATURES) if c.endswith("sign_mean")])


@register("fill_counts", _wide_subset(SPARSE_H, lambda c: c.endswith("_n_measurements")
                                      or c.endswith("_n_admission_measurements")))
def q_fill_counts(spark, d):
    """count columns, nulls filled with 0 (48 h: many subjects empty)."""
    b = _block(spark, d, SPARSE_H)
    return b.select("subject_id", *TS.count_columns(FEATURES))


@register("merge_blocks", _full(SPARSE_H))
def q_merge_blocks(spark, d):
    """three feature blocks (click+view, error, purchase+signup) in one
    aggregation instead of three joins; the oracle joins the blocks."""
    return _block(spark, d, SPARSE_H)


@register("top_measured", A.with_(A.MEASUREMENTS, A.MEAS_COHORT, rows_sql(DENSE_H)) + """
SELECT feature_name, count(*) AS total_n FROM rws GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def q_top_measured(spark, d):
    """top-10 features by total count."""
    return TS.top_measured(_block(spark, d), FEATURES, 10)


def _null_frac_sql():
    sql, _ = wide_sql(SPARSE_H)
    cols = TS.feature_columns(FEATURES)
    parts = [f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {_q(c)} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_fraction FROM w"
             for c in cols]
    return f"WITH w AS ({sql})\n" + "\nUNION ALL ".join(parts)


@register("null_fractions", _null_frac_sql())
def q_null_fractions(spark, d):
    """F16: share of nulls per output column (48 h block)."""
    return TS.null_fractions(_block(spark, d, SPARSE_H))


def _coverage_sql():
    sql, _ = wide_sql(SPARSE_H)
    tot = " + ".join(_q(f + "_n_admission_measurements") for f in FEATURES)
    zero = " + ".join(f"CASE WHEN {_q(f + '_n_admission_measurements')} = 0 THEN 1 ELSE 0 END" for f in FEATURES)
    return round_sql(f"""WITH w AS ({sql}), p AS (SELECT {tot} AS total, ({zero}) / {float(len(FEATURES))} AS mf FROM w)
SELECT count(*) FILTER (WHERE total = 0) AS subjects_zero, count(*) FILTER (WHERE total > 0) AS subjects_any,
       avg(mf) AS missing_mean, min(mf) AS missing_min, max(mf) AS missing_max FROM p""",
                     ["missing_mean", "missing_min", "missing_max"])


@register("coverage_stats", _coverage_sql())
def q_coverage_stats(spark, d):
    """F17 on the 48 h block."""
    return TS.coverage_stats(_block(spark, d, SPARSE_H), FEATURES)


@register("ts_features", _full(DENSE_H))
def q_ts_features(spark, d):
    """the whole block, 480 h / 4 windows, 5 features x 33 columns."""
    return _block(spark, d, DENSE_H)


@register("stable_column_order", f"""SELECT position, "column", coalesce(n, 0) AS n FROM (
  SELECT row_number() OVER () - 1 AS position, column_name AS "column" FROM (DESCRIBE {_full(SPARSE_H)}) t) names
LEFT JOIN (SELECT c AS "column", count(*) AS n FROM (UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM ({_full(SPARSE_H)}) b) ON COLUMNS(*) INTO NAME c VALUE v) u GROUP BY 1)
  counts USING ("column")""")
def q_stable_column_order(spark, d):
    """the columns of the time-series block, feature by feature
    (admission, windows, diffs), each with its count of values."""
    block = _block(spark, d, SPARSE_H)
    ordered = [c for c in block.columns if c not in TS.feature_columns(FEATURES)] + TS.feature_columns(FEATURES)
    return non_null_counts(block, ordered)
