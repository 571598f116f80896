"""Hand-written mini fixtures for the semantic traps (SURVEY 2.12,
FIXTURES section 4)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stayframe.operators import cohort as C
from stayframe.operators import demographics as D
from stayframe.operators import evaluate as E
from stayframe.operators import extract as X
from stayframe.operators import intervals as P
from stayframe.operators import labels as L
from stayframe.operators import prefix
from stayframe.operators import timeseries as TS
from stayframe.functions.expressions import clean_text, sign_label, std_text, tokens

T0 = dt.datetime(2020, 1, 1, 0, 0)


def ts(h=0.0, m=0):
    return T0 + dt.timedelta(hours=h, minutes=m)


def ntz(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def test_first_episode_ties_and_nulls(spark):
    eps = spark.createDataFrame([
        (1, 11, ts(5), ts(80)), (1, 10, ts(5), ts(70)), (1, 9, None, ts(1)),
        (2, 20, None, None),
    ], "subject_id long, admission_id long, admittime timestamp, dischtime timestamp")
    eps = ntz(eps, "admittime", "dischtime")
    got = {r.subject_id: r.admission_id for r in C.first_episode(eps).collect()}
    assert got == {1: 10}
    ids = spark.createDataFrame([(1,), (2,), (3,)], "subject_id long")
    miss = sorted(r.subject_id for r in C.missing_subjects(ids, C.first_episode(eps)).collect())
    assert miss == [2, 3]


def test_duration_boundaries(spark):
    eps = spark.createDataFrame([
        (1, 1, ts(0), ts(54)), (2, 2, ts(0), ts(53, 59)), (3, 3, ts(0), ts(0)), (4, 4, ts(5), ts(1)),
    ], "subject_id long, admission_id long, admittime timestamp, dischtime timestamp")
    eps = ntz(eps, "admittime", "dischtime")
    kept = sorted(r.subject_id for r in C.min_duration_filter(C.episode_duration(eps)).collect())
    assert kept == [1]
    assert sorted(r.subject_id for r in C.episode_duration(eps).collect()) == [1, 2]


def test_age_rule_feb29(spark):
    df = spark.createDataFrame([(1, dt.datetime(2021, 2, 28), dt.datetime(2000, 2, 29)),
                                (2, dt.datetime(2021, 3, 1), dt.datetime(2000, 2, 29)),
                                (3, dt.datetime(2021, 3, 1), None)],
                               "subject_id long, admittime timestamp, dob timestamp")
    from stayframe.functions.expressions import age_years
    got = {r.subject_id: r.age for r in df.select("subject_id", age_years("admittime", "dob").alias("age")).collect()}
    assert got == {1: 20, 2: 21, 3: None}


def test_drop_reasons(spark):
    df = spark.createDataFrame([(1, None), (2, -1), (3, 17), (4, 18), (5, 89), (6, 90), (7, 300)],
                               "subject_id long, age int")
    got = {r.subject_id: r.drop_reason for r in C.with_drop_reason(df).collect()}
    assert got == {1: "na_age", 2: "negative_age", 3: "under18", 4: None, 5: None, 6: "age90plus", 7: "age90plus"}


def test_second_episode_and_readmission(spark):
    eps = spark.createDataFrame([
        (1, 1, ts(0), ts(60)), (1, 2, ts(60 + 30 * 24), ts(61 + 30 * 24)),      # exactly 30 days -> readmitted
        (2, 3, ts(0), ts(60)), (2, 4, ts(59), ts(100)),                         # before discharge
        (3, 5, ts(0), ts(60)), (3, 6, ts(100), ts(100)),                        # zero duration
        (4, 7, ts(0), ts(60)), (4, 8, None, None),                              # null times rank last
        (5, 9, ts(0), ts(60)),
    ], "subject_id long, admission_id long, admittime timestamp, dischtime timestamp")
    eps = ntz(eps, "admittime", "dischtime")
    cohort = C.first_episode(eps)
    sec = C.second_episode(cohort, eps)
    r = {x.subject_id: (x.second_admission_id, x.nonpositive_duration) for x in sec.collect()}
    assert r == {1: (2, False), 2: (4, False), 3: (6, True), 4: (8, False), 5: (None, False)}
    ra = {x.subject_id: x.readmission for x in L.readmission(cohort, sec).collect()}
    assert ra == {1: True, 2: False, 3: False, 4: False, 5: False}
    assert [x.subject_id for x in C.null_time_audit(sec).collect()] == [4]


def test_mortality_rules(spark):
    cohort = ntz(spark.createDataFrame([(1, 1, ts(0), ts(100)), (2, 2, ts(0), ts(100)), (3, 3, ts(0), ts(100))],
                                       "subject_id long, admission_id long, admittime timestamp, dischtime timestamp"),
                 "admittime", "dischtime")
    eps = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "admission_id long, expire_flag int")
    subj = ntz(spark.createDataFrame([(1, None), (2, ts(50)), (3, ts(100 + 30 * 24 + 1))],
                                     "subject_id long, dod timestamp"), "dod")
    got = {r.subject_id: r.mortality for r in L.mortality(cohort, eps, subj).collect()}
    assert got == {1: True, 2: True, 3: False}


def test_window_edges(spark):
    cohort = ntz(spark.createDataFrame([(1, 1, ts(0))], "subject_id long, admission_id long, admittime timestamp"),
                 "admittime")
    rows = spark.createDataFrame([(1, 1, "hr", ts(h), 1.0, i) for i, h in enumerate([-0.01, 0, 11.999, 12, 24, 36, 47.99, 48])],
                                 "subject_id long, admission_id long, feature_name string, charttime timestamp, valuenum double, row_id long")
    rows = ntz(rows, "charttime")
    got = sorted(r.window for r in TS.observed_rows(rows, cohort, 12.0, 4).collect())
    assert got == [0, 0, 1, 2, 3, 3]
    closed = X.extract_window(rows.withColumn("itemid", F.lit(1)), cohort, 48.0, closed=True).count()
    assert closed == 7


def test_ts_features_fill_and_diffs(spark):
    cohort = ntz(spark.createDataFrame([(1, 1, ts(0)), (2, 2, ts(0))],
                                       "subject_id long, admission_id long, admittime timestamp"), "admittime")
    rows = ntz(spark.createDataFrame([
        (1, 1, "hr", ts(13), 10.0, 1), (1, 1, "hr", ts(14), 14.0, 2), (1, 1, "hr", ts(40), 12.0, 3),
        (1, 1, "hr", ts(40), 11.0, 4),
    ], "subject_id long, admission_id long, feature_name string, charttime timestamp, valuenum double, row_id long"),
        "charttime")
    out = {r.subject_id: r for r in TS.ts_features(rows, cohort, ["hr", "sbp"], 12.0, 4).collect()}
    a = out[1]
    assert a["hr_window0_n_measurements"] == 0 and a["hr_window0_mean"] is None    # no back-fill
    assert a["hr_window1_mean"] == 12.0 and a["hr_window2_mean"] == 12.0             # forward fill
    assert a["hr_window2_n_measurements"] == 0
    assert a["hr_window3_std"] == pytest.approx(math.sqrt(0.5))
    assert a["hr_first_admission_measurement"] == 10.0
    assert a["hr_last_admission_measurement"] == 11.0                                # tie -> larger row id last
    assert a["hr_diff1_previous_mean"] == 0.0 and a["hr_diff1_sign_mean"] == "ZERO"
    assert a["hr_diff0_sign_mean"] is None
    b = out[2]
    assert b["hr_n_admission_measurements"] == 0 and b["sbp_window3_n_measurements"] == 0
    assert len(TS.feature_columns(["hr", "sbp"])) == 66


def test_sign_label_eps(spark):
    df = spark.createDataFrame([(1e-9,), (-1e-9,), (2e-8,), (-2e-8,), (None,)], "x double")
    got = [r.s for r in df.select(sign_label("x").alias("s")).collect()]
    assert got == ["ZERO", "ZERO", "POS", "NEG", None]


def test_interval_union_cases(spark):
    cohort = ntz(spark.createDataFrame([(1, 1, ts(0))], "subject_id long, admission_id long, admittime timestamp"),
                 "admittime")
    orders = spark.createDataFrame([
        (1, 1, ts(-5), ts(2), "Vancomycin", "vancomycin", " iv "),      # starts before window
        (1, 1, ts(2), ts(4), "VANCOMYCIN", None, "IV"),                  # touching
        (1, 1, ts(3), ts(3.5), "x", "VANCOMYCIN", "PO"),                 # nested
        (1, 1, ts(10), None, "x", "", "ng"),                             # null end -> window end; empty generic
        (1, 1, None, ts(1), "Heparin", "Heparin", "IV DRIP"),            # null start -> window start
        (1, 1, ts(20), ts(20), "Heparin", "Heparin", "IV"),              # zero length: dropped
        (1, 1, ts(30), ts(31), "CEFEPIME", "CEFEPIME", "IV"),            # CEFE... not matched (Q6)
    ], "subject_id long, admission_id long, startdate timestamp, enddate timestamp, drug string, "
       "drug_name_generic string, route string")
    orders = ntz(orders, "startdate", "enddate")
    ov = X.interval_overlap(orders, cohort, 48.0)
    assert ov.count() == 6
    block = P.interval_features(ov, cohort).first()
    assert block["antibiotic_coverage_0_48h"] == pytest.approx(4 / 48)
    assert block["antibiotic_hours_0_48h"] == pytest.approx(2 + 2 + 0.5)
    assert block["anticoagulant_coverage_0_48h"] == pytest.approx(1 / 48)
    assert block["n_orders_0_48h"] == 6 and block["no_meds_0_48h"] == 0
    assert block["n_iv_orders_0_48h"] == 4 and block["n_po_orders_0_48h"] == 2
    for b in (1, 4, 64):
        cov = P.union_coverage(P.tag(ov), list(P.FAMILY_PATTERNS), 48.0, b)
        got = {r.family: r.union_hours for r in cov.collect()}
        assert got["antibiotic"] == pytest.approx(4.0)


def test_std_text_and_clean_text(spark):
    df = spark.createDataFrame([("\t iv  drip \n",), ("a [**secret**] b [**x\n**]",), (None,)], "s string")
    got = [r.t for r in df.select(std_text("s").alias("t")).collect()]
    assert got[0] == "IV DRIP"
    c = [r.c for r in df.select(clean_text("s").alias("c")).collect()]
    assert c[1].split() == ["a", "b", "x"]
    assert c[2] == ""
    n = df.select(F.size(tokens(clean_text("s"))).alias("n")).collect()
    assert [r.n for r in n] == [2, 3, 0]


def test_rule_classifier_last_match_wins(spark):
    df = spark.createDataFrame([("white - russian",), ("asian - caucasian",), ("black/haitian",),
                                ("black/african",), ("patient declined to answer",), ("xyz",), (None,)], "e string")
    got = [r.b for r in df.select(D.rule_classifier("e").alias("b")).collect()]
    assert got == ["WHITE", "ASIAN", "CARIBBEAN", "AFRICAN", "DECLINED", None, None]


def test_prefix_sums_brute_force(spark):
    import random
    random.seed(3)
    vals = [(k, round(random.random(), 2), random.randint(1, 5)) for k in range(3) for _ in range(60)]
    df = spark.createDataFrame(vals, "k int, v double, c long").groupBy("k", "v").agg(F.sum("c").alias("c"))
    got = {(r.k, r.v): r.c_before for r in prefix.prefix_sums(df, ["k"], "v", ["c"], buckets=7).collect()}
    rows = df.collect()
    for r in rows:
        want = sum(x.c for x in rows if x.k == r.k and x.v < r.v)
        assert got[(r.k, r.v)] == want


def test_auroc_ap_properties(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.7), (1, 0.3), (0, 0.1)]
    df = spark.createDataFrame(rows, "y_true int, y_pred double")
    a = E.auroc(df, buckets=3).first()["auroc"]
    # brute force with ties at half
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert a == pytest.approx(want)
    rev = E.auroc(df.withColumn("y_pred", -F.col("y_pred")), buckets=3).first()["auroc"]
    assert rev == pytest.approx(1 - want)
    ap = E.average_precision(df, buckets=2).first()["average_precision"]
    # step-wise AP by hand: thresholds .9 (1/1), .8 (1/2), .7 (2/4), .3 (3/5), .1
    assert ap == pytest.approx((1 / 3) * 1.0 + (1 / 3) * 0.5 + (1 / 3) * 0.6)
    one = E.auroc(df.where("y_true = 1")).first()["auroc"]
    assert one is None
    tied = E.auroc(df.withColumn("y_pred", F.lit(0.5))).first()["auroc"]
    assert tied == pytest.approx(0.5)


def test_group_ap_empty_and_one_class(spark):
    preds = spark.createDataFrame([(1, 0.9, "a"), (0, 0.1, "a"), (1, 0.5, "b"), (0, 0.3, None)],
                                  "y_true int, y_pred double, grp string")
    groups = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "grp string")
    got = {r.grp: (r["count"], r.average_precision) for r in E.group_average_precision(preds, groups).collect()}
    assert got == {"a": (2, 1.0), "b": (1, None), "c": (0, None)}


def test_calibration_bins_edges(spark):
    df = spark.createDataFrame([(0.1,), (0.10000001,), (0.3,), (1.0,), (0.0,)], "y_pred double")
    got = [r.b for r in df.select(E.calibration_bin().alias("b")).collect()]
    assert got == [0, 1, 2, 9, 0]


def test_note_vectors_in_vocabulary_mean(spark):
    """The rescaled transform equals the explicit in-vocabulary mean."""
    from pyspark.ml.functions import vector_to_array
    from stayframe.operators import text as N
    texts = ["alpha beta gamma alpha", "beta beta delta", "zeta", "alpha [**x**] beta 42 gamma", ""]
    rows = [(i, i, i, t, "Nursing") for i, t in enumerate(texts * 4)]
    notes = N.with_tokens(spark.createDataFrame(rows, "row_id long, subject_id long, admission_id long, "
                                                      "text string, category string"))
    model = N.train_word_vectors(notes, vector_size=8, min_count=2)
    vocab = {r.word: list(r.vector) for r in model.vectors().collect()}
    got = {r.row_id: r.v for r in N.note_vectors(notes, model).select("row_id", vector_to_array("vec").alias("v")).collect()}
    for r in notes.collect():
        inv = [vocab[t] for t in r.tokens if t in vocab]
        want = [sum(c) / len(inv) for c in zip(*inv)] if inv else [0.0] * 8
        assert got[r.row_id] == pytest.approx(want, abs=1e-6)


def test_decision_options(spark):
    """Q3 no_meds fill and Q15 category trim."""
    from stayframe.operators import text as N
    cohort = ntz(spark.createDataFrame([(1, 1, ts(0)), (2, 2, ts(0))], "subject_id long, admission_id long, admittime timestamp"),
                 "admittime")
    orders = ntz(spark.createDataFrame([(1, 1, ts(1), ts(2), "x", "x", "IV")],
                                       "subject_id long, admission_id long, startdate timestamp, enddate timestamp, "
                                       "drug string, drug_name_generic string, route string"), "startdate", "enddate")
    ov = X.interval_overlap(orders, cohort, 48.0)
    ref = {r.subject_id: r["no_meds_0_48h"] for r in P.interval_features(ov, cohort).collect()}
    opt = {r.subject_id: r["no_meds_0_48h"] for r in P.interval_features(ov, cohort, no_meds_fill=1).collect()}
    assert ref == {1: 0, 2: 0} and opt == {1: 0, 2: 1}
    notes = spark.createDataFrame([("Physician ",), ("Physician",), ("Nursing",)], "category string")
    assert N.category_filter(notes).count() == 2
    assert N.category_filter(notes, trim=True).count() == 3


def test_mann_whitney_small_and_tied(spark):
    from stayframe.operators import compare as G
    df = spark.createDataFrame([("a", True, 1.0), ("a", False, 1.0), ("a", True, 1.0),
                                ("b", True, 1.0), ("b", False, 2.0), ("b", False, 3.0), ("b", True, 0.5)],
                               "feature string, grp boolean, value double")
    got = {r.feature: r for r in G.mann_whitney(df, buckets=2).collect()}
    assert got["a"].z is None and got["a"].u_statistic == 1.0
    # b: false {2, 3}, true {1, 0.5}: U(false) = 4, medians 2.5 and 0.75
    assert got["b"].u_statistic == 4.0
    assert got["b"].median_group_false == 2.5 and got["b"].median_group_true == 0.75
    assert 0.0 <= got["b"].p_value <= 1.0
