"""Risk model per outcome (T1-T9): boosted trees trained as Spark jobs and
stopped by the validation rows' average precision, isotonic calibration,
importance, persistence, scoring."""

from __future__ import annotations

import itertools
import json
import os
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.operators.boosting import Ensemble, score_of, write_rows
from stayframe.operators.evaluate import average_precision
from stayframe.operators.isotonic import pooled_blocks
from stayframe.operators.prepare import PreparedModel
from stayframe.session import checkpoint_dir, materialize

# Fixed values that must equal the reference: tuned settings per target.
# ``scale_pos_weight`` multiplies the train-set negative/positive ratio.
BEST_PARAMS = {
    "mortality": dict(max_depth=5, learning_rate=0.03, min_child_weight=5, subsample=0.6, colsample=0.6, spw_factor=1.0),
    "prolonged_stay": dict(max_depth=7, learning_rate=0.03, min_child_weight=5, subsample=1.0, colsample=0.6,
                           spw_factor=1.0),
    "readmission": dict(max_depth=3, learning_rate=0.2, min_child_weight=5, subsample=1.0, colsample=0.8,
                        spw_factor=2.0),
}
# Boosting ends here at the latest, or when this many rounds brought no better
# validation average precision.
MAX_ROUNDS, PATIENCE = 4000, 100
MAX_BINS = 64
# A search hands its rows whole to every setting's task up to so many cells (one byte each).
SEARCH_CELLS = 1 << 26
# The grid's last axis multiplies the train-set class weight; its values differ by target.
WEIGHT_FACTORS = {"mortality": [0.5, 1.0, 1.5], "prolonged_stay": [0.75, 1.0, 1.25], "readmission": [0.5, 1.0, 2.0]}
GRID = {"max_depth": [3, 5, 7], "learning_rate": [0.03, 0.10, 0.20], "min_child_weight": [1, 5, 10],
        "subsample": [0.6, 0.8, 1.0], "colsample": [0.6, 0.8, 1.0]}
BLOCK_CODES = "dvlgpne"  # demographics vitals labs gcs prescriptions notes embeddings


def with_weights(df: DataFrame, label: str, spw: float) -> DataFrame:
    """Positive rows weighted by ``spw``."""
    return df.withColumn("weight", F.when(F.col(label).cast("int") == 1, F.lit(float(spw))).otherwise(F.lit(1.0)))


def grid_for(target: str) -> dict:
    """The full grid of a target: the shared axes and its own weight factors."""
    return {**GRID, "spw_factor": WEIGHT_FACTORS[target]}


@dataclass
class Trees:
    """An ensemble as flat arrays: node k goes to ``left[k]`` if its feature is
    at most ``threshold[k]``, else to ``right[k]``; a leaf (feature -1) has
    ``value[k]``. ``root`` and ``weight`` are by tree. The size is bounded by
    rounds x 2^(depth + 1) nodes."""
    root: np.ndarray
    weight: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def outputs(self, x: np.ndarray) -> np.ndarray:
        """Weighted output of every tree (columns) for every row of ``x``."""
        at = np.tile(self.root, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return self.value[at] * self.weight
            left = x[rows, np.maximum(f, 0)] <= self.threshold[at]
            at = np.where(inner, np.where(left, self.left[at], self.right[at]), at)


def _session() -> SparkSession:
    """The session, also in a thread that has none of its own."""
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def node_table(model: GBTClassificationModel) -> DataFrame:
    """The ensemble's nodes as a table: tree, node, feature (null in a leaf),
    threshold, left, right, value, gain (fall of the impurity by the split),
    weight (summed row weights in the node)."""
    spark = _session()
    path = f"{checkpoint_dir(spark)}/nodes-{uuid.uuid4().hex}"
    model.write().save(path)
    n = F.col("nodeData")
    split = n["leftChild"] >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), F.when(split, n["split"]["featureIndex"]).alias("feature"),
        F.when(split, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["prediction"].alias("value"), F.when(split, n["gain"]).alias("gain"), n["impurityStats"][0].alias("weight"))


def flat_trees(nodes: DataFrame, weights: list[float], first: int = 0) -> Trees:
    """``node_table`` rows of the trees from ``first`` on as arrays."""
    rows = nodes.where(F.col("tree") >= first).select("tree", "node", "feature", "threshold", "left", "right", "value").orderBy("tree", "node").toPandas()
    tree = rows["tree"].to_numpy()
    start = np.searchsorted(tree, np.arange(first, len(weights)))
    base = start[tree - first] if len(tree) else tree
    leaf = rows["feature"].isna().to_numpy()
    child = {c: np.where(leaf, 0, base + rows[c].to_numpy()).astype(np.int64) for c in ("left", "right")}
    return Trees(start.astype(np.int64), np.array(weights[first:], float), rows["feature"].fillna(-1).to_numpy().astype(np.int64),
                 rows["threshold"].fillna(0.0).to_numpy().astype(float), child["left"], child["right"], rows["value"].to_numpy().astype(float))


def grown_trees(grown: Ensemble) -> Trees:
    """The trees grown so far as arrays."""
    start = np.cumsum([0] + [len(t["n"]) for t in grown.trees])
    flat = lambda of: np.concatenate([np.array(of(t, b)) for t, b in zip(grown.trees, start)])
    child = lambda side: flat(lambda t, b: np.maximum(t[side], 0) + b)
    return Trees(start[:-1], np.array(grown.weights()), flat(lambda t, _: t["feature"]), flat(lambda t, _: [x or 0.0 for x in grown.thresholds(t)]),
                 child("left"), child("right"), flat(lambda t, _: t["value"]).astype(float))


def staged_margins(rows: DataFrame, trees: Trees, features: str = "features", y_true: str = "y_true", base: str | None = None, first: int = 0) -> DataFrame:
    """(round, y_true, y_pred): the margin of every row after each tree, from
    one pass over the rows (running sums over the trees). ``base`` names a
    column with the margin before the first of these trees; rounds count the
    given trees from 1, and those up to ``first`` are left out."""
    n = len(trees.root)
    size = max(1, (1 << 18) // max(1, n))

    def score(batches):
        for batch in batches:
            x = np.array(batch.column(0).flatten().to_numpy(zero_copy_only=False), float).reshape(batch.num_rows, -1)
            y, start = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
            for k in range(0, len(x), size):
                margin = start[k:k + size, None] + np.cumsum(trees.outputs(x[k:k + size]), axis=1)[:, first:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(first + 1, n + 1, dtype=np.int32), len(margin))), pa.array(np.repeat(y[k:k + size], n - first)),
                     pa.array(margin.reshape(-1))], names=["round", "y_true", "y_pred"])

    x = vector_to_array(features) if dict(rows.dtypes)[features] == "vector" else F.col(features)
    start = F.col(base).cast("double") if base else F.lit(0.0)
    return rows.select(x.alias("x"), F.col(y_true).cast("int").alias("y"), start.alias("start")).mapInArrow(score, "round int, y_true int, y_pred double")


def staged_average_precision(rows: DataFrame, trees: Trees, features: str = "features", y_true: str = "y_true", first: int = 0) -> DataFrame:
    """(round, count, average_precision) after each tree beyond ``first``: E2 keyed by the round."""
    return average_precision(staged_margins(rows, trees, features, y_true, first=first), ["round"])


def best_round(scores: list[float | None], patience: int = PATIENCE) -> tuple[int, bool]:
    """The round (from 1) with the best score so far when ``patience`` rounds
    have passed without a better one, and whether that happened. Rounds
    without a score (one class only) are no better than any other."""
    best, at = -1.0, 1
    for k, s in enumerate(scores, 1):
        if s is not None and s > best:
            best, at = s, k
        if k - at >= patience:
            return at, True
    return at, False


def truncated(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` trees."""
    sc = _session().sparkContext
    jvm, java = sc._jvm, model._java_obj
    trees = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(jvm.double, rounds)
    for k, (tree, weight) in enumerate(zip(list(java.trees())[:rounds], model.treeWeights)):
        trees[k], weights[k] = tree, float(weight)
    short = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights, model.numFeatures, model.numClasses)
    out = GBTClassificationModel(java.copyValues(short, jvm.org.apache.spark.ml.param.ParamMap()))
    out._resetUid(java.uid())
    return model._copyValues(out)


def boost(train: DataFrame, label: str, params: dict, spw: float, rounds: int, seed: int = 1407, held: list | None = None,
          stop: Callable[[Ensemble], bool] | None = None, piece: int = MAX_ROUNDS) -> GBTClassificationModel:
    """``rounds`` boosting rounds on the training rows (``boosting``). (No L1/L2
    terms exist in Spark's boosted trees; ``min_child_weight`` maps to the
    minimum instances of a node.) ``held`` keeps the ensemble: the next call
    with it grows on from there, and the caller closes it. ``stop`` is asked
    after every ``piece`` of rounds whether to end there."""
    gbt = GBTClassifier(featuresCol="features", labelCol="y", weightCol="weight", maxIter=rounds, stepSize=params["learning_rate"],
                        maxDepth=params["max_depth"], subsamplingRate=params["subsample"], featureSubsetStrategy=str(params["colsample"]),
                        minInstancesPerNode=int(params["min_child_weight"]), seed=seed, maxBins=MAX_BINS)
    mine = held if held is not None else []
    try:
        if not mine:
            mine.append(Ensemble(train, label, params, spw, seed, gbt.getMaxBins()))
        while (grown := len(mine[0].trees)) < rounds:
            mine[0].grow(min(rounds, grown + piece))
            if stop and stop(mine[0]):
                break
        return mine[0].model(train.sparkSession, gbt)
    finally:
        if held is None and mine:
            mine[0].close()


def fit_rows(train_val: DataFrame, label: str) -> DataFrame:
    """(features, label, split) of the training and validation rows, written
    once as they lie in memory: boosting sends the way to its rows with every
    task of every level, and every fit reads them several times."""
    return materialize(train_val.where(F.col("split").isin("train", "val")).select("features", label, "split"))


def train_classifier(train_val: DataFrame, label: str, params: dict, spw: float, max_iter: int = MAX_ROUNDS, seed: int = 1407,
                     patience: int = PATIENCE, written: bool = False) -> GBTClassificationModel:
    """Boosted trees with class weights, kept up to the round with the
    best average precision on the validation rows once ``patience`` rounds
    brought no better one (``max_iter`` rounds at most).

    The fit has twice the patience in rounds at first, which holds the stop
    of every fit that is at its best by half of them, and grows on to twice
    the rounds until the stop lies within it. After every half patience the
    new rounds are scored in one pass over the validation rows
    (``staged_average_precision``), and the fit ends once the stop is there;
    only one number for each round reaches the driver. ``written`` says that
    the rows are ``fit_rows`` already."""
    rows = train_val if written else fit_rows(train_val, label)
    val = rows.where(F.col("split") == "val").select("features", F.col(label).alias("y_true"))
    scores: list = []

    def stop(grown: Ensemble) -> bool:
        found = {r["round"]: r["average_precision"] for r in staged_average_precision(val, grown_trees(grown), first=len(scores)).collect()}
        scores.extend(found.get(k) for k in range(len(scores) + 1, len(grown.trees) + 1))
        return best_round(scores, patience)[1]

    rounds, held = min(max_iter, 2 * max(8, patience)), []
    try:
        while True:
            model = boost(rows.where(F.col("split") == "train"), label, params, spw, rounds, seed, held, stop, max(8, patience // 2))
            at, stopped = best_round(scores, patience)
            if stopped or rounds >= max_iter:
                return truncated(model, at)
            rounds = min(max_iter, 2 * rounds)
    finally:
        for e in held:
            e.close()


def positive_probability(model, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("p_raw", vector_to_array("probability")[1])


def grid_search(train_val: DataFrame, label: str, spw: float, grid: dict | list[dict] | None = None, max_iter: int = MAX_ROUNDS,
                threads: int = 8, patience: int = PATIENCE, target: str | None = None, seed: int = 1407) -> tuple[dict, DataFrame]:
    """Every setting of the grid trained on train, scored by validation
    AP (E2). ``grid`` maps axes to values (every combination is tried) or
    lists the settings; the default is the full grid of ``target``. ``spw`` is
    the class weight that ``spw_factor`` multiplies. (Spark's boosted trees
    have no regularisation terms to search.) The rows are written once for
    all settings. Returns the best setting, the first of equals, and the
    (setting, AP) table.

    More settings than ``threads`` over rows of at most ``SEARCH_CELLS`` cells
    are a task each: the rows are binned once, and the task reads them and
    makes the whole fit. Fewer settings, or more rows, are fitted by Spark
    jobs, ``threads`` settings at a time, and twice as many settings are
    scored together, keyed by the setting. Both grow the same trees and stop
    alike."""
    grid = grid or grid_for(target or label)
    combos = grid if isinstance(grid, list) else [dict(zip(grid, vals)) for vals in itertools.product(*grid.values())]
    spark = train_val.sparkSession
    rows = fit_rows(train_val, label)
    val = rows.where(F.col("split") == "val")
    folder = write_rows(rows.where(F.col("split") == "train"), val, label, MAX_BINS, SEARCH_CELLS) if len(combos) > threads else None
    if folder:
        def search(settings):
            for k, c in settings:
                yield k, score_of(folder, c, spw * c.get("spw_factor", 1.0), seed, max_iter, patience)

        found = dict(spark.sparkContext.parallelize(list(enumerate(combos)), len(combos)).mapPartitions(search).collect())
        scored = [(json.dumps(c), found[k]) for k, c in enumerate(combos)]
    else:
        scored = _searched_by_jobs(rows, val, label, spw, combos, max_iter, threads, patience, seed)
    table = spark.createDataFrame(scored, "params string, val_average_precision double")
    best = max(scored, key=lambda r: -1 if r[1] is None else r[1])
    return json.loads(best[0]), table


def _searched_by_jobs(rows: DataFrame, val: DataFrame, label: str, spw: float, combos: list[dict], max_iter: int, threads: int,
                      patience: int, seed: int) -> list[tuple]:
    def one(c):
        return train_classifier(rows, label, c, spw * c.get("spw_factor", 1.0), max_iter, seed, patience, written=True)

    scored = []
    with ThreadPoolExecutor(threads) as pool:
        for first in range(0, len(combos), 2 * threads):
            some = combos[first:first + 2 * threads]
            preds = [positive_probability(m, val).select(F.lit(k).alias("setting"), F.col(label).cast("int").alias("y_true"), F.col("p_raw").alias("y_pred"))
                     for k, m in enumerate(pool.map(one, some))]
            found = {r["setting"]: r["average_precision"] for r in average_precision(reduce(DataFrame.unionByName, preds), ["setting"]).collect()}
            scored += [(json.dumps(c), found.get(k)) for k, c in enumerate(some)]
    return scored


def calibrate_isotonic(scored_val: DataFrame, label: str, p: str = "p_raw") -> IsotonicRegressionModel:
    """Isotonic map fitted on validation scores (interpolates between
    fitted points, clamps outside). The scores are pooled to blocks in tasks
    (``isotonic``); Spark's model is made from the blocks' ends, which is all
    that reaches the driver."""
    blocks = pooled_blocks(scored_val, p, label)
    ends = blocks.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias(p), F.col("value").alias("y"), "weight")
    iso = IsotonicRegression(featuresCol=p, labelCol="y", weightCol="weight", predictionCol="p_cal", isotonic=True)
    return iso.fit(ends)


def predict(model, calibrator: IsotonicRegressionModel | None, df: DataFrame, keep: list[str]) -> DataFrame:
    """T4: (keep..., y_pred) with calibration applied when present."""
    s = positive_probability(model, df)
    if calibrator is not None:
        s = calibrator.transform(s)
        return s.select(*keep, F.col("p_cal").alias("y_pred"))
    return s.select(*keep, F.col("p_raw").alias("y_pred"))


def gain_by_feature(nodes: DataFrame) -> DataFrame:
    """(feature, gain, n_splits): the mean over the feature's splits of the loss
    that each one removes (impurity fall x row weight of the node)."""
    split = nodes.where(F.col("feature").isNotNull())
    return split.groupBy("feature").agg(F.avg(F.col("gain") * F.col("weight")).alias("gain"), F.count(F.lit(1)).alias("n_splits"))


def feature_importance(model, names: list[str], top: int = 30) -> DataFrame:
    """T5: (feature, gain) of the ``top`` features by mean gain of a split, from
    the ensemble's nodes. Not normalised, so it does not depend on the others."""
    found = gain_by_feature(node_table(model))
    name = F.coalesce(F.element_at(F.array(*[F.lit(n) for n in names]), F.when(F.col("feature") < len(names), F.col("feature") + 1)),
                      F.concat(F.lit("f"), F.col("feature").cast("string")))
    return found.select(name.alias("feature"), "gain").orderBy(F.desc("gain"), "feature").limit(top)


def save_bundle(path: str, prep: PreparedModel, model, calibrator, meta: dict) -> None:
    """Preparation statistics, model, calibrator, columns and run
    metadata under one directory (ML writers, no pickles)."""
    spark = SparkSession.getActiveSession()
    model.write().overwrite().save(os.path.join(path, "model"))
    if calibrator is not None:
        calibrator.write().overwrite().save(os.path.join(path, "calibrator"))
    payload = {"prep": prep.to_json(), "meta": json.dumps(meta), "calibrated": calibrator is not None}
    spark.createDataFrame([payload]).coalesce(1).write.mode("overwrite").json(os.path.join(path, "bundle"))


def load_bundle(path: str):
    spark = SparkSession.getActiveSession()
    row = spark.read.json(os.path.join(path, "bundle")).first()
    prep = PreparedModel.from_json(row["prep"])
    model = GBTClassificationModel.load(os.path.join(path, "model"))
    # a bundle that was saved with a calibrator does not load without it
    calibrator = IsotonicRegressionModel.load(os.path.join(path, "calibrator")) if row["calibrated"] else None
    return prep, model, calibrator, json.loads(row["meta"])


def block_choice(include: dict[str, bool]) -> str:
    """Short code of the feature blocks used (letters of ``dvlgpne``)."""
    names = dict(zip("dvlgpne", ["demographics", "vitals", "labs", "gcs", "prescriptions", "notes", "embeddings"]))
    return "".join(ch for ch in BLOCK_CODES if include.get(names[ch], False))
