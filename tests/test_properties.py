"""Properties from SURVEY section 5 and hot-key checks against brute force."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayframe.operators import intervals as P
from stayframe.operators import timeseries as TS
from stayframe.operators.prefix import exact_quantiles
from stayframe.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

T0 = dt.datetime(2020, 1, 1)


def test_coverage_never_exceeds_hours(spark):
    row = QUERIES["coverage_check"].build(spark, SF_SMALL).first().asDict()
    assert all(v == 0 for v in row.values())


def test_windows_partition_rows(spark):
    b = QUERIES["ts_features"].build(spark, SF_SMALL)
    feats = ["click", "error", "purchase", "signup", "view"]
    for f in feats:
        bad = b.where(F.col(f"{f}_n_admission_measurements")
                      != sum(F.col(f"{f}_window{w}_n_measurements") for w in range(4))).count()
        assert bad == 0


def test_long_and_wide_agree(spark):
    long = {(r.subject_id, r.feature_name, r.window): r for r in QUERIES["window_stats"].build(spark, SF_SMALL).collect()}
    wide = QUERIES["ts_features"].build(spark, SF_SMALL).collect()
    for r in wide:
        for (s, f, w), lr in long.items():
            if s != r.subject_id:
                continue
            assert r[f"{f}_window{w}_n_measurements"] == lr.n
            assert r[f"{f}_window{w}_mean"] == pytest.approx(lr.mean, abs=1e-6)


def test_isotonic_monotone(spark):
    rows = QUERIES["calibrate_isotonic"].build(spark, SF_SMALL).orderBy("y_pred").collect()
    vals = [r.calibrated for r in rows]
    assert all(a <= b + 1e-12 for a, b in zip(vals, vals[1:]))


def _union_len(iv):
    iv = sorted((s, e) for s, e in iv if e > s)
    total, cur = 0.0, None
    for s, e in iv:
        if cur is None or s > cur[1]:
            if cur:
                total += cur[1] - cur[0]
            cur = [s, e]
        else:
            cur[1] = max(cur[1], e)
    if cur:
        total += cur[1] - cur[0]
    return total


def test_hot_episode_union_matches_brute_force(spark):
    """One episode holds most intervals (the hot key): the sliced union is
    exact."""
    random.seed(7)
    rows = []
    for i in range(3000):
        ep = 1 if i % 3 else (i % 7) + 2
        s = random.uniform(-5, 50)
        e = s + random.uniform(0, 6)
        rows.append((ep, ep, T0 + dt.timedelta(hours=s), T0 + dt.timedelta(hours=e), "HEPARIN", "HEPARIN", "IV"))
    orders = spark.createDataFrame(rows, "subject_id long, admission_id long, startdate timestamp, enddate timestamp, "
                                         "drug string, drug_name_generic string, route string")
    orders = orders.withColumn("startdate", F.col("startdate").cast("timestamp_ntz")) \
                   .withColumn("enddate", F.col("enddate").cast("timestamp_ntz"))
    cohort = spark.createDataFrame([(k, k, T0) for k in range(1, 9)], "subject_id long, admission_id long, admittime timestamp") \
        .withColumn("admittime", F.col("admittime").cast("timestamp_ntz"))
    from stayframe.operators import extract as X
    ov = X.interval_overlap(orders, cohort, 48.0)
    cov = {r.admission_id: r.union_hours for r in P.union_coverage(P.tag(ov), ["anticoagulant"], 48.0, 16).collect()}
    for ep in range(1, 9):
        iv = [(max(s, 0.0), min(e, 48.0)) for (e_, _, sd, ed, *_rest) in rows if e_ == ep
              for s, e in [((sd - T0).total_seconds() / 3600, (ed - T0).total_seconds() / 3600)]]
        want = _union_len(iv)
        if want > 0:
            assert cov[ep] == pytest.approx(want, abs=1e-6)


def test_hot_subject_window_stats(spark):
    """A third of all rows on one subject: per-window stats still exact."""
    random.seed(11)
    rows = []
    for i in range(6000):
        subj = 1 if i % 3 == 0 else random.randint(2, 50)
        rows.append((subj, subj, "hr", T0 + dt.timedelta(hours=random.uniform(0, 47.9)), random.uniform(50, 150), i))
    meas = spark.createDataFrame(rows, "subject_id long, admission_id long, feature_name string, charttime timestamp, "
                                       "valuenum double, row_id long").withColumn("charttime", F.col("charttime").cast("timestamp_ntz"))
    cohort = spark.createDataFrame([(k, k, T0) for k in range(1, 51)], "subject_id long, admission_id long, admittime timestamp") \
        .withColumn("admittime", F.col("admittime").cast("timestamp_ntz"))
    got = {(r.subject_id, r.window): (r.n, r.mean) for r in TS.window_stats(TS.observed_rows(meas, cohort, 12.0, 4)).collect()}
    for w in range(4):
        vals = [v for (s, _, _, t, v, _) in rows if s == 1 and int((t - T0).total_seconds() // (12 * 3600)) == w]
        assert got[(1, w)][0] == len(vals)
        assert got[(1, w)][1] == pytest.approx(sum(vals) / len(vals))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=-20, max_value=20), min_size=1, max_size=40),
       st.sampled_from([0.1, 0.5, 0.9]))
def test_exact_quantiles_match_interpolation(spark, values, q):
    df = spark.createDataFrame([(v % 2, float(v)) for v in values], "k int, v double")
    got = {r.k: r.q for r in exact_quantiles(df, ["k"], "v", {"q": q}, buckets=4).collect()}
    for k in {v % 2 for v in values}:
        xs = sorted(float(v) for v in values if v % 2 == k)
        h = (len(xs) - 1) * q
        lo, hi = int(h // 1), min(int(h // 1) + 1, len(xs) - 1)
        want = xs[lo] + (h - lo) * (xs[hi] - xs[lo])
        assert got[k] == pytest.approx(want)
