"""End-to-end flow on a hand-written clinical-shaped mini set."""

import datetime as dt
import random

from pyspark.sql import functions as F

from stayframe.plans import flows


def _sources(spark, n=120, seed=5):
    random.seed(seed)
    t0 = dt.datetime(2150, 1, 1)
    adm, pat, chart, rx, notes = [], [], [], [], []
    for s in range(1, n + 1):
        pat.append((s, dt.datetime(2100 + s % 40, 1 + s % 12, 1), None if s % 4 else t0 + dt.timedelta(days=20),
                    " f " if s % 2 else "M"))
        start = t0 + dt.timedelta(hours=s)
        stay = 60 + (s * 13) % 300
        adm.append((s, 1000 + s, start, start + dt.timedelta(hours=stay), int(s % 9 == 0), "WHITE - RUSSIAN",
                    "Medicare", "EMERGENCY", "EMERGENCY ROOM ADMIT"))
        if s % 3 == 0:
            adm.append((s, 5000 + s, start + dt.timedelta(days=20), start + dt.timedelta(days=22), 0, "WHITE",
                        "Private", "URGENT", "HMO REFERRAL/SICK"))
        for k in range(12):
            h = random.uniform(-2, 50)
            chart.append((s, 1000 + s, 211, start + dt.timedelta(hours=h), random.uniform(50, 130) + (s % 9 == 0) * 30,
                          "x", "bpm"))
            chart.append((s, 1000 + s, 223761, start + dt.timedelta(hours=h), random.uniform(95, 104), "x", "F"))
        rx.append((s, 1000 + s, start + dt.timedelta(hours=2), start + dt.timedelta(hours=30), "Heparin", "HEPARIN", "IV"))
        notes.append((s, 1000 + s, start + dt.timedelta(hours=3), start.date(), "Nursing", "Nursing Progress Note",
                      "pt stable [**name**]", 0))
    A = spark.createDataFrame(adm, "SUBJECT_ID int, HADM_ID int, ADMITTIME timestamp, DISCHTIME timestamp, "
                                   "HOSPITAL_EXPIRE_FLAG int, ETHNICITY string, INSURANCE string, ADMISSION_TYPE string, "
                                   "ADMISSION_LOCATION string")
    Pt = spark.createDataFrame(pat, "SUBJECT_ID int, DOB timestamp, DOD timestamp, GENDER string")
    Ch = spark.createDataFrame(chart, "SUBJECT_ID int, HADM_ID int, ITEMID int, CHARTTIME timestamp, VALUENUM double, "
                                      "VALUE string, VALUEUOM string")
    Rx = spark.createDataFrame(rx, "SUBJECT_ID int, HADM_ID int, STARTDATE timestamp, ENDDATE timestamp, DRUG string, "
                                   "DRUG_NAME_GENERIC string, ROUTE string")
    Nt = spark.createDataFrame(notes, "SUBJECT_ID int, HADM_ID int, CHARTTIME timestamp, CHARTDATE date, CATEGORY string, "
                                      "DESCRIPTION string, TEXT string, ISERROR int")
    return flows.Sources(A, Pt, chartevents=Ch, prescriptions=Rx, noteevents=Nt)


def test_train_and_score(spark):
    src = _sources(spark)
    vit = spark.createDataFrame([(211, "HR", 0.0, 300.0), (223761, "TempF", 70.0, 120.0)],
                                "itemid int, feature_name string, min_bound double, max_bound double")
    cfg = flows.Config(dictionaries={"vitals": ("chartevents", vit)}, max_iter=5, embeddings=True, vector_size=8,
                       include={"demographics": True, "prescriptions": True, "notes": True},
                       min_count=1)
    ids = spark.range(1, 121).select(F.col("id").cast("int").alias("subject_id"))
    mat = flows.training_matrix(ids, src, cfg)
    cols = set(mat.columns)
    assert {"HR_window3_mean", "TempC_diff2_sign_mean", "anticoagulant_coverage_0_48h",
            "n_Nursing_notes", "has_Nursing Progress Note", "eth_broad", "emb_7"} <= cols
    fitted = cfg.w2v_model
    assert fitted is not None
    assert mat.count() == mat.select("subject_id").distinct().count() > 0
    bundles = flows.train_targets(mat, cfg, ["mortality", "prolonged_stay"])
    scores = flows.score_unseen(ids.where("subject_id > 100"), src, cfg, bundles)
    assert cfg.w2v_model is fitted          # word vectors reused, not refitted (Q17)
    rows = scores.collect()
    assert set(scores.columns) == {"subject_id", "mortality_proba", "prolonged_LOS_proba"}
    assert rows and all(0.0 <= r.mortality_proba <= 1.0 for r in rows)
