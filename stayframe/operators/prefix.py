"""Exact ordered prefix sums without a single-partition window.

Ordered statistics (ranks, ROC/PR points, average precision) need, for
each distinct ordering value, the sum of a measure over all smaller values.
A window ordered over the whole table runs in one task; here the ordering
values are cut into ``buckets`` ranges at approximate quantiles (one small
aggregate), bucket totals are prefix-summed over at most ``buckets`` rows,
and the exact in-bucket prefix is a window partitioned by bucket. The sum
of the two parts is exact; work spreads over ``buckets`` tasks.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 256
# Ranges of one key, unless the caller names a number (a generated search over them must stay small).
KEY_BUCKETS = 64


def quantile_splits(df: DataFrame, col: str, buckets: int, rel_err: float = 1e-3) -> list[float]:
    """Bucket boundaries at approximate quantiles (a distributed sketch
    aggregate; only ``buckets`` numbers reach the driver)."""
    probs = [i / buckets for i in range(1, buckets)]
    qs = df.approxQuantile(col, probs, rel_err) if buckets > 1 else []
    inner = sorted({float(q) for q in qs})
    # without rows there are no quantiles, but a Bucketizer needs an inner edge
    return [float("-inf")] + (inner or [0.0]) + [float("inf")]


def _count_below(splits: F.Column, o: F.Column, lo: int, hi: int) -> F.Column:
    """Number of entries of the sorted array ``splits`` (fixed length) that
    are < ``o``, as a generated binary search: nested CASE WHEN, log2(n)
    comparisons per row, code-generated (no lambda per element)."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(splits[mid] < o, _count_below(splits, o, mid + 1, hi)).otherwise(_count_below(splits, o, lo, mid))


def _bucket_per_key(d: DataFrame, keys: list[str], o: str, buckets: int, rel_err: float) -> DataFrame:
    """Bucket index from split points computed per key, so every key (a
    feature, a group) spreads over up to ``buckets`` ranges whatever its
    scale. ``percentile_approx`` is a mergeable sketch aggregate."""
    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    acc = int(round(1.0 / rel_err))
    splits = d.groupBy(*keys).agg(F.percentile_approx(o, probs, acc).alias("__s"))
    j = d.join(splits, keys, "inner")
    return j.withColumn("__b", _count_below(F.col("__s"), F.col(o), 0, buckets - 1).cast("double")).drop("__s")


def prefix_sums(df: DataFrame, keys: list[str], order: str, measures: list[str],
                buckets: int | None = None, descending: bool = False, rel_err: float = 1e-3) -> DataFrame:
    """For rows unique on (keys, order): add ``{m}_before`` = sum of ``m``
    over rows of the same keys whose order value is strictly smaller (or
    strictly larger when ``descending``). Without keys the split points are
    one small sketch result; with keys they are computed per key."""
    o = "__o"
    d = df.withColumn(o, (-F.col(order) if descending else F.col(order)).cast("double"))
    if keys:
        d = _bucket_per_key(d, keys, o, buckets or KEY_BUCKETS, rel_err)
    else:
        splits = quantile_splits(d, o, buckets or DEFAULT_BUCKETS, rel_err)
        d = Bucketizer(splits=splits, inputCol=o, outputCol="__b", handleInvalid="keep").transform(d)
    totals = d.groupBy(*keys, "__b").agg(*[F.sum(m).alias(m) for m in measures])
    w_off = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "__b", *[F.coalesce(F.sum(m).over(w_off), F.lit(0)).alias(f"{m}__off")
                                            for m in measures])
    w_in = Window.partitionBy(*keys, "__b").orderBy(o).rowsBetween(Window.unboundedPreceding, -1)
    inner = d.select("*", *[F.coalesce(F.sum(m).over(w_in), F.lit(0)).alias(f"{m}__in") for m in measures])
    j = inner.join(offsets, [*keys, "__b"], "inner")
    return j.select(*df.columns, *[(F.col(f"{m}__off") + F.col(f"{m}__in")).alias(f"{m}_before")
                                   for m in measures])


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                    buckets: int | None = None) -> DataFrame:
    """Exact continuous quantiles per key (linear interpolation between the
    order statistics at positions floor/ceil of ``p * (n - 1)``), without
    holding a group's values in one task: counts per (key, value), bucketed
    prefix sums, then the two order statistics are picked by position.
    ``probs`` maps output column -> probability."""
    x = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    g = x.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))
    p = prefix_sums(g, keys, "__v", ["__c"], buckets)
    n = p.groupBy(*keys).agg(F.sum("__c").alias("__n"))
    j = p.join(n, keys, "inner") if keys else p.crossJoin(n)

    def at(k):  # 0-based position k falls in this value's run
        return (F.col("__c_before") <= k) & (k < F.col("__c_before") + F.col("__c"))

    aggs = []
    for name, q in probs.items():
        h = (F.col("__n") - 1) * F.lit(q)
        aggs += [F.max(F.when(at(F.floor(h)), F.col("__v"))).alias(f"{name}__lo"),
                 F.max(F.when(at(F.ceil(h)), F.col("__v"))).alias(f"{name}__hi"),
                 F.max(h - F.floor(h)).alias(f"{name}__f")]
    r = j.groupBy(*keys).agg(*aggs)
    return r.select(*keys, *[(F.col(f"{k}__lo") + F.col(f"{k}__f") * (F.col(f"{k}__hi") - F.col(f"{k}__lo")))
                             .alias(k) for k in probs])
