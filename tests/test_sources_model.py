"""Sources, sinks, assembly helpers, preparation and persistence (the
pytest-checked rows of SURVEY section 2)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from stayframe.operators import assemble as AS
from stayframe.operators import model as T
from stayframe.operators import prepare as B
from stayframe.operators import timeseries as TS
from stayframe.sources import io



def _scratch():
    return tempfile.mkdtemp(prefix="stayframe-test-")


def test_cohort_ids_csv(spark):
    d = _scratch()
    p = os.path.join(d, "ids.csv")
    with open(p, "w") as f:
        f.write("subject_id\n3\n1\n3\n\n2\n")
    got = sorted(r.subject_id for r in io.cohort_ids(spark, p).collect())
    assert got == [1, 2, 3]


def test_item_dictionary_csv(spark):
    d = _scratch()
    p = os.path.join(d, "dict.csv")
    with open(p, "w") as f:
        f.write("itemid,measurement name,feature name,min,max,units\n211, Heart Rate,HR,0,300,bpm\n"
                "223761,Temperature F,TempF,70,120,\n51,x;[#],Other,,,\n")
    got = {r.itemid: (r.feature_name, r.min_bound, r.max_bound) for r in io.item_dictionary(spark, p).collect()}
    assert got == {211: ("HR", 0.0, 300.0), 223761: ("TempF", 70.0, 120.0), 51: ("Other", None, None)}
    bad = os.path.join(d, "bad.csv")
    with open(bad, "w") as f:
        f.write("itemid,name\n1,a\n")
    with pytest.raises(ValueError):
        io.item_dictionary(spark, bad)


def test_write_and_read_stage(spark):
    d = _scratch()
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    back = io.write_stage(df, os.path.join(d, "stage"))
    assert back.count() == 10
    again = io.write_stage(spark.range(3), os.path.join(d, "stage"), overwrite=False)
    assert again.count() == 10   # existing stage reused
    assert io.read_stage(spark, os.path.join(d, "stage"), ["x"]).columns == ["x"]
    io.write_report(back.groupBy().agg(F.sum("x").alias("s")), os.path.join(d, "report"))
    assert spark.read.option("header", True).csv(os.path.join(d, "report")).first()["s"] == "90"


def test_register_and_require(spark):
    df = spark.range(3)
    io.register_frame(df, "three")
    assert spark.sql("select count(*) c from three").first()["c"] == 3
    with pytest.raises(ValueError):
        io.require_columns(df, ["id", "nope"])


def test_scan_typed_coerces(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", None)], "a string, b string")
    out = io.scan_typed(df, {"a_int": ("a", "int"), "b_dbl": ("b", "double")}).collect()
    assert [(r.a_int, r.b_dbl) for r in out] == [(1, 2.5), (None, None)]


def test_common_keys_and_types(spark):
    a = spark.createDataFrame([(1, 2)], "subject_id int, admission_id int")
    b = spark.createDataFrame([(1, 5)], "subject_id long, v int")
    assert AS.common_keys(a, b) == ["subject_id"]
    with pytest.raises(ValueError):
        AS.common_keys(a, spark.createDataFrame([(1,)], "x int"))
    assert dict(AS.enforce_id_types(a).dtypes)["subject_id"] == "bigint"
    with pytest.raises(ValueError):
        AS.assert_unique_key(spark.createDataFrame([(1,), (1,)], "subject_id int"), ["subject_id"])


def test_discover_columns_and_to_double(spark):
    df = spark.createDataFrame(
        [(1, 2, 0.5, "M", "POS", 3, 1, 1, True, 4.0, "txt")],
        "subject_id int, admission_id int, emb_0 double, gender string, hr_diff0_sign_mean string, "
        "n_total_notes int, hr_n_admission_measurements long, antibiotic_any_0_48h int, has_x boolean, "
        "age double, free_text string")
    p = B.discover_columns(df)
    assert p.embeddings == ["emb_0"]
    assert p.categoricals == ["gender", "hr_diff0_sign_mean"]
    assert p.count_like == ["n_total_notes", "hr_n_admission_measurements"]
    assert p.flag_like == ["antibiotic_any_0_48h", "has_x"]
    assert p.other_numerics == ["age"]
    v = spark.createDataFrame([("1.5",), ("nan",), ("x",)], "s string").select(B.to_double("s").alias("v")).collect()
    assert [r.v for r in v] == [1.5, None, None]


def test_preparation_fit_transform(spark):
    train = spark.createDataFrame(
        [(1, "a", 1.0, None, 2), (2, "b", 2.0, 1.0, None), (3, "a", 3.0, 3.0, 5), (4, None, 10.0, None, -1)],
        "subject_id int, eth_raw string, age double, emb_0 double, n_x int")
    plan = B.discover_columns(train)
    prep = B.fit_preparation(train, plan, k=2)
    assert prep.medians["age"] == 2.5                    # mean of the two middle values
    assert prep.emb_means["emb_0"] == 2.0
    assert prep.topk_keep == ["a", "MISSING"]            # MISSING takes a slot (Q25)
    new = spark.createDataFrame([(9, "zzz", None, None, None)],
                                "subject_id int, eth_raw string, age double, emb_0 double, n_x int")
    row = prep.transform_columns(new, ["subject_id"]).first().asDict()
    assert row["eth_raw=OTHER"] == 1.0 and row["eth_raw=a"] == 0.0
    assert row["age"] == 2.5 and row["emb_missing"] == 1.0 and row["emb_0"] == 2.0
    assert row["missingindicator_n_x"] == 1.0 and row["n_x"] == 0.0
    assert "missingindicator_age" not in row             # age had no nulls at fit
    rt = B.PreparedModel.from_json(prep.to_json())
    assert rt.medians == prep.medians


def test_stratified_split_fractions(spark):
    df = spark.range(1000).select(F.col("id").alias("subject_id"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    s = B.stratified_split(df, "y")
    counts = {(r.split, r.y): r.n for r in B.split_label_counts(s, "y").collect()}
    assert counts[("train", 0)] == 560 and counts[("val", 0)] == 120 and counts[("test", 0)] == 120
    assert counts[("train", 1)] == 140 and counts[("val", 1)] == 30 and counts[("test", 1)] == 30


def test_bundle_roundtrip_and_isotonic(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(i, Vectors.dense([float(i % 7), float(i % 3)]), int(i % 7 > 3), "train" if i < 140 else "val")
            for i in range(200)]
    df = spark.createDataFrame(rows, ["subject_id", "features", "y", "split"])
    params = T.BEST_PARAMS["readmission"]
    m = T.train_classifier(df, "y", params, 1.0, max_iter=5)
    val = T.positive_probability(m, df.where("split = 'val'"))
    cal = T.calibrate_isotonic(val, "y")
    pred = [r.y_pred for r in T.predict(m, cal, df, ["subject_id"]).orderBy("y_pred").collect()]
    assert all(0.0 <= p <= 1.0 for p in pred)
    d = tempfile.mkdtemp(prefix="stayframe-bundle-")
    prep = B.PreparedModel(plan={"embeddings": [], "categoricals": [], "count_like": [], "flag_like": [],
                                 "other_numerics": []})
    T.save_bundle(d, prep, m, cal, {"target": "y", "blocks": T.block_choice({"demographics": True, "notes": True})})
    prep2, m2, cal2, meta = T.load_bundle(d)
    assert meta["blocks"] == "dn"
    a = T.predict(m2, cal2, df, ["subject_id"]).orderBy("subject_id").collect()
    b = T.predict(m, cal, df, ["subject_id"]).orderBy("subject_id").collect()
    assert [r.y_pred for r in a] == [r.y_pred for r in b]
    imp = T.feature_importance(m, ["a", "b"]).collect()
    assert {r.feature for r in imp} <= {"a", "b"}


def test_stable_column_order():
    cols = TS.feature_columns(["HR"], 4)
    assert cols[:5] == ["HR_n_admission_measurements", "HR_first_admission_measurement",
                        "HR_last_admission_measurement", "HR_difference_last_first_admission_measurements",
                        "HR_window0_n_measurements"]
    assert cols[-1] == "HR_diff2_sign_mean" and len(cols) == 33
