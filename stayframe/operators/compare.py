"""Exploratory group comparison (G1-G10): prevalence, pivoted means,
Mann-Whitney U, Bonferroni, contingency tables, chi-square, moments,
histograms. All statistics are distributed aggregates; ranks come from
exact bucketed prefix sums, not a per-feature sort in one task."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayframe.operators.distributions import EXACT_ROWS, chi_square_tail, normal_two_sided_p, rank_sum_p
from stayframe.operators.prefix import prefix_sums
from stayframe.session import materialize

def label_prevalence(df: DataFrame, labels: list[str]) -> DataFrame:
    """G1: per label, rows, positives and positive share (unpivot + agg)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(l).alias("label"), F.col(l).cast("int").alias("y"))
                                          for l in labels])).alias("kv")).select("kv.*")
    return long.groupBy("label").agg(F.count("y").alias("n"), F.sum("y").alias("positives"),
                                     (F.avg("y") * 100.0).alias("positive_pct"))


def pivot_mean(long: DataFrame, keys: list[str], feature: str, value: str, features: list[str]) -> DataFrame:
    """Mean value per feature as ``{feature}_mean`` columns (explicit
    pivot values: no extra pass to discover them)."""
    p = long.groupBy(*keys).pivot(feature, features).agg(F.avg(value))
    return p.select(*keys, *[F.col(f"`{f}`").alias(f"{f}_mean") for f in features])


def _exact_p(batches):
    """Replace the p-value of rows marked ``exact`` by that of the exact
    distribution: one row for each test."""
    for batch in batches:
        at = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("n0", "n1", "u_statistic", "exact", "p_value")}
        p = [rank_sum_p(n0, n1, u) if exact else p for n0, n1, u, exact, p in zip(*at.values())]
        yield batch.set_column(batch.schema.get_field_index("p_value"), "p_value", pa.array(p, pa.float64()))


def mann_whitney(long: DataFrame, feature: str | list[str] = "feature", group: str = "grp", value: str = "value",
                 buckets: int | None = None) -> DataFrame:
    """Per feature (one or several key columns), U of the ``false`` group,
    medians of both groups, tie-corrected normal z and two-sided p with
    continuity correction; where a group has at most eight rows and no two
    values are equal, p is that of the exact distribution.

    Ranks: counts per (feature, value) then exact bucketed prefix sums, so
    average ranks need no sort of a whole feature in one task. Medians come
    from the same cumulative counts per group."""
    keys = [feature] if isinstance(feature, str) else list(feature)
    x = long.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    g = x.groupBy(*keys, value).agg(
        F.count_if(~F.col(group).cast("boolean")).alias("c0"),
        F.count_if(F.col(group).cast("boolean")).alias("c1"))
    g = g.withColumn("c", F.col("c0") + F.col("c1"))
    c = prefix_sums(g, keys, value, ["c", "c0", "c1"], buckets)
    tot = c.groupBy(*keys).agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1"),
                                 F.sum(F.col("c") ** 3 - F.col("c")).alias("ties"))
    j = c.join(tot, keys)
    avg_rank = F.col("c_before") + (F.col("c") + 1) / 2.0

    def at(before, cnt, k):
        return (F.col(before) < k) & (k <= F.col(before) + F.col(cnt))

    lo0, hi0 = F.floor((F.col("n0") + 1) / 2), F.floor(F.col("n0") / 2) + 1
    lo1, hi1 = F.floor((F.col("n1") + 1) / 2), F.floor(F.col("n1") / 2) + 1
    agg = j.groupBy(*keys, "n0", "n1", "ties").agg(
        F.sum(F.col("c0") * avg_rank).alias("r0"),
        F.max(F.when(at("c0_before", "c0", lo0), F.col(value))).alias("m0_lo"),
        F.max(F.when(at("c0_before", "c0", hi0), F.col(value))).alias("m0_hi"),
        F.max(F.when(at("c1_before", "c1", lo1), F.col(value))).alias("m1_lo"),
        F.max(F.when(at("c1_before", "c1", hi1), F.col(value))).alias("m1_hi"))
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    n = n0 + n1
    u0 = F.col("r0") - n0 * (n0 + 1) / 2.0
    umax = F.greatest(u0, n0 * n1 - u0)
    # nullif guards: under ANSI a zero divisor raises; a single row or an
    # all-tied feature has no defined z
    sigma = F.sqrt(n0 * n1 / 12.0 * ((n + 1) - F.col("ties") / F.nullif(n * (n - 1), F.lit(0.0))))
    z = (umax - n0 * n1 / 2.0 - 0.5) / F.nullif(sigma, F.lit(0.0))
    exact = (F.least("n0", "n1").between(1, EXACT_ROWS)) & (F.col("ties") == 0)
    out = agg.select(
        *keys, F.col("n0").cast("bigint").alias("n0"), F.col("n1").cast("bigint").alias("n1"),
        u0.alias("u_statistic"), ((F.col("m0_lo") + F.col("m0_hi")) / 2.0).alias("median_group_false"),
        ((F.col("m1_lo") + F.col("m1_hi")) / 2.0).alias("median_group_true"),
        z.alias("z"), exact.alias("exact"))
    out = out.select(*[c for c in out.columns if c != "exact"], normal_two_sided_p(F.col("z")).alias("p_value"), "exact")
    return out.mapInArrow(_exact_p, out.schema).drop("exact")


def compare_continuous(df: DataFrame, targets: list[str], features: list[str], alpha: float = 0.05) -> DataFrame:
    """G3 + G4 for every target and feature of a wide table in one job: target,
    feature, the test, p adjusted within the target, significant."""
    cells = F.array(*[F.struct(F.lit(t).alias("target"), F.lit(f).alias("feature"), F.col(t).cast("boolean").alias("grp"),
                               F.col(f"`{f}`").cast("double").alias("value")) for t in targets for f in features])
    tests = mann_whitney(df.select(F.explode(cells).alias("c")).select("c.*"), ["target", "feature"])
    m = Window.partitionBy("target")  # a row for each feature
    return tests.withColumn("p_adj", F.least(F.col("p_value") * F.count(F.lit(1)).over(m), F.lit(1.0))) \
        .withColumn("significant", F.col("p_value") <= F.lit(alpha) / F.count(F.lit(1)).over(m))


def bonferroni(tests: DataFrame, p: str = "p_value", alpha: float = 0.05) -> DataFrame:
    """P x m capped at 1; significant when p <= alpha / m. ``m`` is a
    global count joined from a one-row aggregate."""
    m = tests.agg(F.count(F.lit(1)).alias("__m"))
    j = tests.crossJoin(m)
    return j.select(*tests.columns, F.least(F.col(p) * F.col("__m"), F.lit(1.0)).alias("p_adj"),
                    (F.col(p) <= F.lit(alpha) / F.col("__m")).alias("significant"))


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency table in long form (nulls dropped, as a crosstab
    does)."""
    return (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
            .groupBy(F.col(a).cast("string").alias("category"), F.col(b).cast("string").alias("group"))
            .agg(F.count(F.lit(1)).alias("observed")))


def chi_square(df: DataFrame, features: list[str], group: str) -> DataFrame:
    """Per feature chi-square statistic over the full table (zero
    cells included), dof, share of expected < 5, Yates for 2x2, and the
    p-value (incomplete gamma function)."""
    long = (df.where(F.col(group).isNotNull())
            .select(F.col(group).cast("string").alias("group"), F.explode(F.array(*[
                F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("string").alias("category")) for f in features])).alias("c"))
            .select("c.feature", "c.category", "group").where(F.col("category").isNotNull()))
    # one pass over the rows; everything below reads the table of counts
    ct = materialize(long.groupBy("feature", "category", "group").agg(F.count(F.lit(1)).alias("observed")))
    rows = ct.groupBy("feature", "category").agg(F.sum("observed").alias("row_t"))
    cols = ct.groupBy("feature", "group").agg(F.sum("observed").alias("col_t"))
    size = (rows.groupBy("feature").agg(F.sum("row_t").alias("n"), F.count(F.lit(1)).alias("r"))
            .join(cols.groupBy("feature").agg(F.count(F.lit(1)).alias("k")), "feature"))
    cells = (rows.join(cols, "feature").join(size, "feature").join(ct, ["feature", "category", "group"], "left")
             .withColumn("observed", F.coalesce("observed", F.lit(0))))
    e = F.col("row_t") * F.col("col_t") / F.col("n")
    dof = (F.col("r") - 1) * (F.col("k") - 1)
    diff = e - F.col("observed")
    adj = F.when(dof == 1, F.col("observed") + F.signum(diff) * F.least(F.lit(0.5), F.abs(diff))) \
        .otherwise(F.col("observed"))
    cells = cells.select("feature", dof.alias("dof"), ((adj - e) ** 2 / e).alias("term"), (e < 5).alias("low"))
    out = cells.groupBy("feature", "dof").agg(F.sum("term").alias("chi2_statistic"),
                                              (F.avg(F.col("low").cast("double")) * 100.0).alias("percent_low_expected"))
    return out.withColumn("p_value", F.when(F.col("dof") > 0, chi_square_tail(F.col("chi2_statistic"), F.col("dof"))))


def normality_moments(df: DataFrame, value: str, group: str) -> DataFrame:
    """Skewness, excess kurtosis and Jarque-Bera per group on all rows
    (re-aim of a 500-row sample test)."""
    g = df.where(F.col(value).isNotNull()).groupBy(group).agg(
        F.count(value).alias("n"), F.skewness(value).alias("skewness"), F.kurtosis(value).alias("kurtosis"))
    return g.withColumn("jarque_bera", F.col("n") / 6.0 * (F.col("skewness") ** 2 + F.col("kurtosis") ** 2 / 4.0))


def histogram(df: DataFrame, value: str, group: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Equal-width bin counts per group (values outside go to the edge
    bins 0 / bins+1, as ``width_bucket`` does)."""
    return (df.where(F.col(value).isNotNull())
            .groupBy(group, F.width_bucket(F.col(value), F.lit(lo), F.lit(hi), F.lit(bins)).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))


def unique_subject_check(df: DataFrame, key: str = "subject_id") -> DataFrame:
    """Rows vs distinct subjects."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_subjects"),
                  (F.count(F.lit(1)) == F.count_distinct(key)).alias("unique"))
