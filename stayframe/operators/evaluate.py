"""Model evaluation on (y_true, y_pred[, group]) rows.

Everything starts with a group-by on the score (map-side combine), so the
ordered work runs over distinct scores, split into buckets by
``prefix_sums``: exact, and parallel even when every score is distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.operators.prefix import prefix_sums

# Inner edges of the ten equal-width calibration bins, as produced by an
# evenly spaced grid over [0, 1] (so 0.30000000000000004, not 0.3).
CALIBRATION_EDGES = [0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9]


def score_counts(preds: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Positives / negatives per distinct score (and key)."""
    keys = keys or []
    p = preds.where(F.col("y_pred").isNotNull() & F.col("y_true").isNotNull())
    return (p.groupBy(*keys, "y_pred")
            .agg(F.sum(F.col("y_true").cast("long")).alias("pos"),
                 F.sum((1 - F.col("y_true")).cast("long")).alias("neg")))


def auroc(preds: DataFrame, keys: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Rank AUC with ties counted half:
    sum_s pos_s * (neg below s + neg_s / 2) / (P * N); null with one class."""
    keys = keys or []
    c = prefix_sums(score_counts(preds, keys), keys, "y_pred", ["neg"], buckets)
    agg = c.groupBy(*keys).agg(
        F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)).alias("num"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return agg.select(*keys, F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                                    F.col("num") / (F.col("n_pos") * F.col("n_neg"))).alias("auroc"))


def average_precision(preds: DataFrame, keys: list[str] | None = None,
                      buckets: int | None = None) -> DataFrame:
    """Step-wise AP = sum over thresholds (descending) of
    (recall gain) x precision; null when a key has one class only."""
    keys = keys or []
    c = prefix_sums(score_counts(preds, keys), keys, "y_pred", ["pos", "neg"], buckets, descending=True)
    tp = F.col("pos_before") + F.col("pos")
    fp = F.col("neg_before") + F.col("neg")
    # decimals add up to the same in any order, doubles do not
    term = (F.col("pos") * tp / (tp + fp)).cast("decimal(38,18)")
    agg = c.groupBy(*keys).agg(F.sum(term).cast("double").alias("num"),
                               F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return agg.select(*keys, (F.col("n_pos") + F.col("n_neg")).alias("count"),
                      F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                             F.col("num") / F.col("n_pos")).alias("average_precision"))


def basic_metrics(preds: DataFrame) -> DataFrame:
    """Brier score, prevalence, n."""
    y = F.col("y_true").cast("double")
    return preds.agg(F.avg((y - F.col("y_pred")) ** 2).alias("brier"), F.avg(y).alias("prevalence"),
                     F.count(F.lit(1)).alias("n"))


def roc_points(preds: DataFrame, buckets: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, every point kept."""
    c = prefix_sums(score_counts(preds), [], "y_pred", ["pos", "neg"], buckets, descending=True)
    tot = c.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    j = c.crossJoin(tot)
    return j.select(F.col("y_pred").alias("threshold"),
                    ((F.col("neg_before") + F.col("neg")) / F.nullif(F.col("n_neg"), F.lit(0))).alias("fpr"),
                    ((F.col("pos_before") + F.col("pos")) / F.nullif(F.col("n_pos"), F.lit(0))).alias("tpr"))


def pr_points(preds: DataFrame, buckets: int | None = None) -> DataFrame:
    """(threshold, precision, recall) per distinct score."""
    c = prefix_sums(score_counts(preds), [], "y_pred", ["pos", "neg"], buckets, descending=True)
    tot = c.agg(F.sum("pos").alias("n_pos"))
    tp = F.col("pos_before") + F.col("pos")
    fp = F.col("neg_before") + F.col("neg")
    return c.crossJoin(tot).select(F.col("y_pred").alias("threshold"), (tp / (tp + fp)).alias("precision"),
                                   (tp / F.nullif(F.col("n_pos"), F.lit(0))).alias("recall"))


def calibration_bin(p: str = "y_pred") -> F.Column:
    """Bin = number of inner edges strictly below p (equal-width, 10 bins)."""
    b = F.lit(0)
    for e in CALIBRATION_EDGES:
        b = b + (F.col(p) > F.lit(e)).cast("int")
    return b


def calibration_curve(preds: DataFrame) -> DataFrame:
    """E5: mean predicted vs observed per non-empty bin."""
    return (preds.groupBy(calibration_bin().alias("bin"))
            .agg(F.avg("y_pred").alias("mean_predicted"), F.avg(F.col("y_true").cast("double")).alias("fraction_positive"),
                 F.count(F.lit(1)).alias("n")))


def group_average_precision(preds: DataFrame, groups: DataFrame, group_col: str = "grp",
                            buckets: int | None = None) -> DataFrame:
    """AP per group; every group of ``groups`` appears (count 0, AP
    null when empty or one class). Null group labels are excluded (Q23)."""
    ap = average_precision(preds.where(F.col(group_col).isNotNull()), [group_col], buckets)
    g = groups.select(group_col).where(F.col(group_col).isNotNull()).distinct()
    j = g.join(ap, group_col, "left")
    return j.select(group_col, F.coalesce("count", F.lit(0)).cast("bigint").alias("count"), "average_precision")


def group_report(preds: DataFrame, people: DataFrame, groupings: dict[str, list[str] | None], key: str = "subject_id",
                 buckets: int | None = None) -> DataFrame:
    """E6 for several groupings in one job: (grouping, grp, count,
    average_precision). ``people`` has the key and a column for each grouping.
    A grouping's groups are the given list, or every value that the column
    has in ``people``; all appear (count 0, AP null when empty or one class).
    Null labels are no group."""
    def cells(df, *more):
        named = F.array(*[F.struct(F.lit(g).alias("grouping"), F.col(g).cast("string").alias("grp")) for g in groupings])
        return df.select(*more, F.explode(named).alias("g")).select(*more, "g.*").where("grp IS NOT NULL")

    ap = average_precision(cells(preds.join(people, key), "y_true", "y_pred"), ["grouping", "grp"], buckets)
    fixed = [(g, v) for g, values in groupings.items() if values is not None for v in values]
    listed = preds.sparkSession.createDataFrame(fixed, "grouping string, grp string")
    open_ = [g for g, values in groupings.items() if values is None]
    found = cells(people).where(F.col("grouping").isin(open_)).distinct().unionByName(listed)
    return found.join(ap, ["grouping", "grp"], "left").select(
        "grouping", "grp", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"), "average_precision")


def metrics_report(preds: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row with AUROC, AUPRC, Brier, prevalence, n."""
    a = auroc(preds, buckets=buckets)
    p = average_precision(preds, buckets=buckets).select(F.col("average_precision").alias("auprc"))
    return a.crossJoin(p).crossJoin(basic_metrics(preds))
