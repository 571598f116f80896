"""Findings that were wrong once: each test failed before its fix."""

import json

import pytest
from pyspark.sql import functions as F

from stayframe.operators import assemble as AS
from stayframe.operators import cohort as C
from stayframe.operators import model as T
from stayframe.operators import prepare as B
from stayframe.operators import text as N
from stayframe.plans import flows
from stayframe.session import ensure_checkpoint_dir
from stayframe.sources import io


def _notes(spark):
    rows = [(k, k, k, [f"w{(k * 7 + j) % 23}" for j in range(30)]) for k in range(40)]
    return spark.createDataFrame(rows, "row_id long, subject_id long, admission_id long, tokens array<string>")


def test_note_vectors_of_repeated_notes(spark):
    notes = _notes(spark).cache()
    model = N.train_word_vectors(notes, vector_size=4, min_count=2)
    once = {r.subject_id: r.vec for r in N.note_vectors(notes, model).collect()}
    twice = N.note_vectors(notes.union(notes), model).collect()
    assert len(twice) == 80 and all(r.vec == once[r.subject_id] for r in twice)
    shared = notes.withColumn("row_id", F.lit(1))  # different notes under one id
    assert all(r.vec == once[r.subject_id] for r in N.note_vectors(shared, model).collect())


def test_nan_and_bad_numbers_are_missing(spark):
    rows = [(1, 1, 1.0, 2.0, "x"), (2, 2, float("nan"), float("nan"), "y"), (3, 3, None, 4.0, "z")]
    df = spark.createDataFrame(rows, "subject_id long, admission_id long, n_a double, size double, gender string")
    prep = B.fit_preparation(df)
    got = {r.subject_id: r for r in prep.transform_columns(df, ["subject_id"]).collect()}
    assert [got[k]["missingindicator_n_a"] for k in (1, 2, 3)] == [0.0, 1.0, 1.0]
    assert [got[k]["missingindicator_size"] for k in (1, 2, 3)] == [0.0, 1.0, 0.0] and got[2]["size"] == 3.0


def test_booleans_are_no_other_numerics(spark):
    df = spark.createDataFrame([(1, 1, True, 2.0)], "subject_id long, admission_id long, flag boolean, size double")
    assert B.discover_columns(df).other_numerics == ["size"]


def test_assembly_refuses_a_repeated_key(spark):
    a = spark.createDataFrame([(1, 2.0), (2, 3.0)], "subject_id long, x double")
    b = spark.createDataFrame([(1, 5.0), (1, 6.0)], "subject_id long, y double")
    with pytest.raises(ValueError, match="block 1"):
        AS.assemble_features([a, b])
    assert AS.assemble_features([a, b.limit(1)]).count() == 1


def test_bundle_that_lost_its_calibrator_does_not_load(spark, tmp_path):
    rows = [(k % 2, [float(k % 2), float(k % 5)], "train" if k % 4 else "val", k) for k in range(60)]
    from pyspark.ml.functions import array_to_vector
    df = spark.createDataFrame(rows, "y int, f array<double>, split string, subject_id long").withColumn("features", array_to_vector("f"))
    params = dict(max_depth=2, learning_rate=0.3, min_child_weight=1, subsample=1.0, colsample=1.0)
    model = T.train_classifier(df, "y", params, 1.0, max_iter=3)
    cal = T.calibrate_isotonic(T.positive_probability(model, df), "y")
    T.save_bundle(str(tmp_path / "b"), B.PreparedModel({}), model, None, {})
    assert T.load_bundle(str(tmp_path / "b"))[2] is None
    T.save_bundle(str(tmp_path / "c"), B.PreparedModel({}), model, cal, {})
    (tmp_path / "c" / "calibrator").rename(tmp_path / "c" / "gone")
    with pytest.raises(Exception):
        T.load_bundle(str(tmp_path / "c"))


def test_grid_search_scores_every_setting_once(spark):
    from pyspark.ml.functions import array_to_vector
    rows = [(k % 2, [float(k % 2), float(k % 5)], "train" if k % 4 else "val") for k in range(60)]
    df = spark.createDataFrame(rows, "y int, f array<double>, split string").withColumn("features", array_to_vector("f")).cache()
    grid = dict(max_depth=[1, 2], learning_rate=[0.3], min_child_weight=[1], subsample=[1.0], colsample=[1.0], spw_factor=[0.5, 2.0])
    best, table = T.grid_search(df, "y", 1.0, grid, max_iter=2)
    seen = [json.loads(r.params) for r in table.collect()]
    assert len(seen) == 4 and {(s["max_depth"], s["spw_factor"]) for s in seen} == {(1, 0.5), (1, 2.0), (2, 0.5), (2, 2.0)}
    assert best in seen


def test_unfinished_stage_is_written_again(spark, tmp_path):
    path = str(tmp_path / "stage")
    io.write_stage(spark.range(3), path)
    (tmp_path / "stage" / "_SUCCESS").unlink()
    assert io.write_stage(spark.range(5), path, overwrite=False).count() == 5
    assert io.write_stage(spark.range(7), path, overwrite=False).count() == 5


def test_nth_episode_orders_null_starts_last(spark):
    rows = [(1, 10, None), (1, 11, 5), (1, 12, 5), (2, 20, 1), (3, 30, None), (3, 31, 2)]
    df = spark.createDataFrame(rows, "subject_id long, admission_id long, admittime long").withColumn("dischtime", F.col("admittime"))
    assert {(r.subject_id, r.admission_id) for r in C.nth_episode(df, 2).collect()} == {(1, 12), (3, 30)}


def test_word_vectors_see_only_training_subjects(spark):
    ensure_checkpoint_dir(spark)
    labels = spark.createDataFrame([(k, k % 2, k % 3 == 0, k % 5 == 0) for k in range(200)],
                                   "subject_id long, mortality int, prolonged_stay boolean, readmission boolean")
    labels = labels.select("subject_id", *[F.col(t).cast("int").alias(t) for t in flows.TARGETS])
    train = {r.subject_id for r in flows.train_subjects(labels).collect()}
    assert train
    for target in flows.TARGETS:
        split = {r.subject_id: r.split for r in B.stratified_split(labels, target).collect()}
        assert all(split[s] == "train" for s in train)
