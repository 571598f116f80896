"""Boosting with patience: the kept round against a brute-force search."""

import json

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stayframe.operators import model as T
from stayframe.operators.evaluate import average_precision

PARAMS = dict(max_depth=3, learning_rate=0.04, min_child_weight=2, subsample=0.8, colsample=0.8)


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(420, 5))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.4 * rng.normal(size=420) > 0.3).astype(int)
    rows = [(k, int(y[k]), x[k].tolist(), "train" if k % 3 else "val") for k in range(420)]
    frame = spark.createDataFrame(rows, "subject_id long, y int, f array<double>, split string")
    return frame.withColumn("features", array_to_vector("f")).coalesce(2).cache()


def slow_ap(y, p):
    """Average precision from its definition, ties taken together."""
    total = ap = 0.0
    for s in sorted(set(p), reverse=True):
        kept = [b for a, b in zip(p, y) if a >= s]
        own = sum(b for a, b in zip(p, y) if a == s)
        ap += own * sum(kept) / len(kept)
        total += own
    return ap / total


def test_the_kept_round_is_the_best(spark, noisy):
    patience = 25
    model = T.train_classifier(noisy, "y", PARAMS, 1.5, max_iter=200, patience=patience)
    assert model.getNumTrees > 20 and model.numFeatures == 5
    val = noisy.where("split = 'val'")
    rows = [(r["y"], np.array(r["f"])) for r in val.collect()]

    def output(node, x):
        while node.subtreeDepth() > 0:
            node = node.leftChild() if x[node.split().featureIndex()] <= node.split().threshold() else node.rightChild()
        return node.prediction()

    # one growing ensemble, long enough to hold the stop, walked tree by tree in the JVM's own nodes
    full = T.boost(noisy.where("split = 'train'"), "y", PARAMS, 1.5, model.getNumTrees + patience)
    margins, scores = np.zeros(len(rows)), []
    for tree, weight in zip(full.trees, full.treeWeights):
        root = tree._java_obj.rootNode()
        margins = margins + weight * np.array([output(root, x) for _, x in rows])
        scores.append(slow_ap([y for y, _ in rows], margins.tolist()))
    best, at = -1.0, 0
    for k, s in enumerate(scores, 1):
        if s > best + 1e-12:
            best, at = s, k
        if k - at >= patience:
            break
    assert model.getNumTrees == at
    found = average_precision(T.positive_probability(model, val).select(F.col("y").alias("y_true"), F.col("p_raw").alias("y_pred")))
    assert found.first()["average_precision"] == pytest.approx(best, abs=1e-12)
    staged = {r["round"]: r["average_precision"] for r in T.staged_average_precision(
        val.withColumnRenamed("y", "y_true"), T.flat_trees(T.node_table(full), list(full.treeWeights))).collect()}
    assert [staged[k + 1] for k in range(len(scores))] == pytest.approx(scores, abs=1e-9)


def test_patience_stops_at_the_first_long_pause():
    assert T.best_round([0.1, 0.3, 0.2, 0.2, 0.9], 2) == (2, True)
    assert T.best_round([0.1, 0.3, 0.2, 0.2, 0.9], 3) == (5, False)
    assert T.best_round([0.5, 0.5, 0.5], 2) == (1, True)
    assert T.best_round([None, None, 0.2], 5) == (3, False)
    assert T.best_round([None, None, None], 2) == (1, True)


def test_truncated_model_saves_and_predicts_like_its_trees(spark, noisy, tmp_path):
    full = T.boost(noisy.where("split = 'train'"), "y", PARAMS, 1.0, 9)
    short = T.truncated(full, 4)
    assert short.getNumTrees == 4 and short.getMaxDepth() == 3
    short.write().overwrite().save(str(tmp_path / "m"))
    loaded = type(full).load(str(tmp_path / "m"))
    a, b = (T.positive_probability(m, noisy).select("subject_id", "p_raw").orderBy("subject_id").collect() for m in (short, loaded))
    assert a == b
    trees = T.flat_trees(T.node_table(full), list(full.treeWeights))
    x = np.array([r["f"] for r in noisy.orderBy("subject_id").collect()])
    margin = trees.outputs(x)[:, :4].sum(1)
    assert [r["p_raw"] for r in a] == pytest.approx((1 / (1 + np.exp(-2 * margin))).tolist(), abs=1e-12)


def test_gain_is_the_mean_loss_removed_by_a_split(spark, noisy):
    model = T.boost(noisy.where("split = 'train'"), "y", PARAMS, 1.0, 3)
    want = {}

    def walk(node):
        if node.subtreeDepth() > 0:
            want.setdefault(node.split().featureIndex(), []).append(node.gain() * node.impurityStats().count())
            walk(node.leftChild())
            walk(node.rightChild())

    for tree in model.trees:
        walk(tree._java_obj.rootNode())
    found = {r["feature"]: (r["gain"], r["n_splits"]) for r in T.gain_by_feature(T.node_table(model)).collect()}
    assert {k: (pytest.approx(np.mean(v)), len(v)) for k, v in want.items()} == found
    named = T.feature_importance(model, ["a", "b", "c"], 2).collect()
    assert len(named) == 2 and named[0]["gain"] >= named[1]["gain"] and {r["feature"] for r in named} <= {"a", "b", "c", "f3", "f4"}


def test_grids_differ_by_target():
    assert [T.grid_for(t)["spw_factor"] for t in T.BEST_PARAMS] == [[0.5, 1.0, 1.5], [0.75, 1.0, 1.25], [0.5, 1.0, 2.0]]


def test_small_frames_are_read_in_few_tasks(spark, tmp_path):
    from stayframe.operators import assemble as AS
    from stayframe.session import packed_partitions, stage_packed
    assert [packed_partitions(n) for n in (0, 1, 1 << 21, (1 << 21) + 1, 1 << 30)] == [1, 1, 1, 2, 512]
    rows = spark.range(1000).repartition(40).withColumn("features", array_to_vector(F.array(F.col("id").cast("double"), F.lit(2.0))))
    out = stage_packed(rows, "packed", 3)
    assert out.rdd.getNumPartitions() == 1 and out.schema["features"].dataType == rows.schema["features"].dataType
    assert sorted((r["id"], tuple(r["features"])) for r in out.collect()) == [(k, (float(k), 2.0)) for k in range(1000)]
    assert stage_packed(rows, "wide", 3 << 20).rdd.getNumPartitions() > 1  # a partition never holds more than its bytes ask for
    ids = spark.range(60).select(F.col("id").alias("subject_id"), (F.col("id") % 7).alias("v"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        staged = AS.staged_blocks([ids, ids.withColumnRenamed("v", "w")])
        assert [s.rdd.getNumPartitions() for s in staged] == [1, 1]  # one row a subject, so 50 tasks are not worth it
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_the_first_fit_holds_a_stop_within_twice_the_patience(spark, noisy, monkeypatch):
    asked, boost = [], T.boost
    monkeypatch.setattr(T, "boost", lambda *a, **k: asked.append(a[4]) or boost(*a, **k))
    model = T.train_classifier(noisy, "y", {**PARAMS, "learning_rate": 0.3}, 1.5, max_iter=200, patience=10)
    assert asked[0] == 20 and all(b == 2 * a for a, b in zip(asked, asked[1:]))
    assert (len(asked) == 1) == (model.getNumTrees <= 10)


def test_a_search_reads_its_rows_once(spark, noisy, tmp_path, monkeypatch):
    noisy.select("y", "features", "split").coalesce(2).write.parquet(str(tmp_path / "x"))
    x, seen, boost = spark.read.parquet(str(tmp_path / "x")), [], T.boost
    plain = boost(x.where("split = 'train'"), "y", PARAMS, 1.0, 4)
    monkeypatch.setattr(T, "boost", lambda *a, **k: seen.append((a[0].inputFiles(), boost(*a, **k))) or seen[-1][1])
    _, table = T.grid_search(x, "y", 1.0, [PARAMS, {**PARAMS, "max_depth": 2}], max_iter=4)
    T.train_classifier(x, "y", PARAMS, 1.0, max_iter=4)
    assert table.count() == 2 and [files for files, _ in seen] == [[], [], []]  # no fit goes back to the files
    val = x.where("split = 'val'")
    for r in table.collect():  # scored together, yet each by its own model
        params = json.loads(r["params"])
        alone = T.positive_probability(T.train_classifier(x, "y", params, 1.0, max_iter=4), val).select(F.col("y").alias("y_true"), F.col("p_raw").alias("y_pred"))
        assert r["val_average_precision"] == pytest.approx(average_precision(alone).first()["average_precision"], abs=1e-12)
    same = [m for _, m in seen[:3] if m.getMaxDepth() == 3]
    assert len(same) == 2 and all(m.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:] for m in same)


def test_trees_are_those_of_sparks_boosting_without_draws(spark):
    from pyspark.ml.classification import GBTClassifier
    rng = np.random.default_rng(3)
    x = np.clip(np.round(rng.normal(size=(600, 4)) * 8) / 8, -3, 3)  # fewer values than bins, so both cut between all of them
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.4 * rng.normal(size=600) > 0.3).astype(int)
    rows = spark.createDataFrame([(int(b), a.tolist()) for a, b in zip(x, y)], "y int, f array<double>").withColumn("features", array_to_vector("f")).repartition(3)
    params = dict(max_depth=4, learning_rate=0.1, min_child_weight=5, subsample=1.0, colsample=1.0)
    gbt = GBTClassifier(featuresCol="features", labelCol="z", weightCol="weight", maxIter=8, stepSize=0.1, maxDepth=4, subsamplingRate=1.0, minInstancesPerNode=5, maxBins=64)
    theirs = gbt.fit(T.with_weights(rows, "y", 1.7).withColumn("z", F.col("y").cast("double")))
    mine = T.boost(rows, "y", params, 1.7, 8)
    key = ["tree", "node"]
    a, b = (T.node_table(m).toPandas() for m in (mine, theirs))
    path = lambda m: [line.split("Predict")[0] for line in m.toDebugString.split("\n")[1:]]
    assert path(mine) == path(theirs) and len(a) == len(b) and mine.treeWeights == theirs.treeWeights
    assert sorted(a["gain"].dropna()) == pytest.approx(sorted(b["gain"].dropna())) and a.groupby("tree")["weight"].sum().tolist() == pytest.approx(b.groupby("tree")["weight"].sum().tolist())
    p, q = ([r["p_raw"] for r in T.positive_probability(m, rows).select("f", "p_raw").orderBy("f").collect()] for m in (mine, theirs))
    assert p == pytest.approx(q, abs=1e-12) and not a[key].duplicated().any()


def test_a_fit_grows_on_a_job_a_level(spark, noisy, monkeypatch):
    from stayframe.operators import boosting as B
    train, held = noisy.where("split = 'train'"), []
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    first = T.boost(train, "y", PARAMS, 1.0, 4, held=held)
    sc.setJobGroup("grows", "")
    try:
        held[0].grow(40)  # past the trees that every job is sent
        jobs = tracker.getJobIdsForGroup("grows")
    finally:
        sc._jsc.clearJobGroup()
    assert len(jobs) <= 36 * PARAMS["max_depth"]  # no tree is grown again
    assert all(len(tracker.getJobInfo(j).stageIds) == 1 for j in jobs if tracker.getJobInfo(j))
    longer = T.boost(train, "y", PARAMS, 1.0, 40, held=held)
    held[0].close()
    # dealt otherwise, summed by tasks, and by workers that hold nothing of the rows
    monkeypatch.setattr(B, "TASK_CELLS", 100)
    monkeypatch.setattr(B, "SUMMED_ON_DRIVER", 2)
    plain = T.boost(train.repartition(3), "y", PARAMS, 1.0, 40)
    lines = lambda m: [line.split("Predict")[0] for line in m.toDebugString.split("\n")[1:]]
    assert lines(longer) == lines(plain) and lines(longer)[:len(lines(first)) - 1] == lines(first)[:-1]


def test_bins_follow_the_weights_of_values():
    from stayframe.operators import boosting as B
    assert B.cut_points(np.array([0.0, 1.0]), np.array([999, 1]), 64).tolist() == [0.5]
    assert B.cut_points(np.array([7.0]), np.array([9]), 64).tolist() == []
    v = np.arange(10000.0)
    a = (10000, 0, [(v[::2], np.ones(5000, int))])
    b = (10000, 0, [(v[1::2], np.ones(5000, int))])
    values, counts = B._merged(a, b)[2][0]
    assert len(values) <= B.POINTS and counts.sum() == 10000 and values[-1] == 9999
    cuts = B.cut_points(values, counts, 64)
    assert len(cuts) == 63 and np.abs(np.diff(cuts) - 10000 / 64).max() < 20


def test_rows_without_a_label_are_refused(spark, noisy):
    with pytest.raises(Exception, match="1 of 280 training rows"):
        T.boost(noisy.where("split = 'train'").withColumn("y", F.expr("if(subject_id = 1, null, y)")), "y", PARAMS, 1.0, 2)


def test_a_fit_ends_soon_after_its_stop(spark, noisy, monkeypatch):
    grown, model_of = [], T.Ensemble.model
    monkeypatch.setattr(T.Ensemble, "model", lambda e, *a: grown.append(e) or model_of(e, *a))
    model = T.train_classifier(noisy, "y", {**PARAMS, "learning_rate": 0.3}, 1.5, max_iter=400, patience=30)
    stop = model.getNumTrees + 30
    assert stop <= len(grown[-1].trees) < stop + 15  # it is asked every half patience
    a, b = T.grown_trees(grown[-1]), T.flat_trees(T.node_table(model_of(grown[-1], spark, T.GBTClassifier(maxDepth=3, labelCol="y"))), grown[-1].weights())
    x = np.array([r["f"] for r in noisy.collect()])
    assert np.array_equal(a.outputs(x), b.outputs(x))
    val = noisy.where("split = 'val'").withColumnRenamed("y", "y_true")
    whole, late = ({r["round"]: r["average_precision"] for r in T.staged_average_precision(val, a, first=k).collect()} for k in (0, 20))
    assert late == {k: v for k, v in whole.items() if k > 20}


def test_a_search_in_tasks_scores_as_by_jobs(spark, noisy, monkeypatch):
    from stayframe.operators import boosting as B
    grid = {"max_depth": [1, 3], "learning_rate": [0.3], "min_child_weight": [2], "subsample": [0.7, 1.0], "colsample": [0.8], "spw_factor": [0.5, 2.0]}
    monkeypatch.setattr(B, "TASK_CELLS", 300)  # several blobs
    by_jobs = T.grid_search(noisy, "y", 1.3, grid, max_iter=60, patience=12)
    in_tasks = T.grid_search(noisy, "y", 1.3, grid, max_iter=60, patience=12, threads=2)
    scores = [{r["params"]: r["val_average_precision"] for r in table.collect()} for _, table in (by_jobs, in_tasks)]
    assert by_jobs[0] == in_tasks[0] and len(scores[0]) == 8 and len(set(scores[0].values())) > 4
    assert scores[1] == pytest.approx(scores[0], abs=1e-12)
    monkeypatch.setattr(T, "SEARCH_CELLS", 400 * 5)  # 420 rows of 5 features are too many for a task
    monkeypatch.setattr(T, "score_of", None)
    assert T.grid_search(noisy, "y", 1.3, grid, max_iter=2, patience=12, threads=2)[1].count() == 8


def test_a_search_in_tasks_without_validation_rows_or_classes(spark, noisy):
    grid = {"max_depth": [1], "learning_rate": [0.3], "min_child_weight": [2], "subsample": [1.0], "colsample": [1.0], "spw_factor": [0.5, 1.0, 2.0]}
    train = noisy.where("split = 'train'")
    one_class = noisy.where("split = 'train' OR y = 1").withColumn("y", F.expr("if(split = 'val' AND subject_id % 2 = 0, null, y)"))
    for rows in (train, one_class):
        best, table = T.grid_search(rows, "y", 1.0, grid, max_iter=3, threads=1)
        assert [r["val_average_precision"] for r in table.collect()] == [None] * 3 and best["spw_factor"] == 0.5


def test_ranked_precision_takes_ties_together():
    from stayframe.operators.boosting import ranked_precision
    rng = np.random.default_rng(5)
    y, p = rng.integers(0, 2, 90), rng.integers(0, 7, 90) / 7
    assert ranked_precision(y, p) == pytest.approx(slow_ap(y.tolist(), p.tolist()))


def test_the_search_query_tries_the_whole_grid_with_full_patience(spark, noisy, monkeypatch):
    from stayframe.plans import q_model as Q
    asked, search = [], T.grid_search
    few = [{"max_depth": 1, "learning_rate": 0.3, "min_child_weight": 1, "subsample": 1.0, "colsample": 1.0, "spw_factor": 1.0}]

    def seen(x, label, spw, grid=None, *args, **named):
        asked.append((grid, args, named))
        return search(x, label, spw, few, 2)

    monkeypatch.setattr(Q, "_matrix", lambda *a: (*[noisy.withColumnRenamed("y", "quality")] * 2, noisy.withColumnRenamed("y", "quality")))
    monkeypatch.setattr(T, "grid_search", seen)
    assert Q.q_grid_search(spark, None).count() == 1
    # no list of settings, no rounds and no patience of the query's own: the operator's defaults are the whole job
    assert asked == [(None, (), {"target": "mortality"})]
    assert np.prod([len(v) for v in T.grid_for("mortality").values()]) == 729 and (T.MAX_ROUNDS, T.PATIENCE) == (4000, 100)
    assert Q.SEARCHED == T.grid_for("mortality")
