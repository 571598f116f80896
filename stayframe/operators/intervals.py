"""Interval (order) features: text normalisation, family tags, exposure
hours and union coverage (P1-P14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayframe.functions.expressions import HOUR_US, safe_ratio, std_text
from stayframe.session import materialize

# Fixed values that must equal the reference: medication families (each a
# list of case-insensitive patterns, any match tags the order) and the two
# route sets.
FAMILY_PATTERNS: dict[str, list[str]] = {
    "antibiotic": [r"\bVANCOMYCIN\b", r"\bCEF[AOIU]\w+", r"\bPIPERACILLIN\b", r"\bTAZOBACTAM\b",
                   r"\bLEVOFLOXACIN\b", r"\bCIPROFLOXACIN\b", r"\bMEROPENEM\b", r"\bERTAPENEM\b",
                   r"\bAZITHROMYCIN\b"],
    "insulin": [r"\bINSULIN\b", r"SLIDING SCALE"],
    "diuretic_loop": [r"\bFUROSEMIDE\b"],
    "statin": [r"\b(ATORVASTATIN|SIMVASTATIN|ROSUVASTATIN|PRAVASTATIN)\b"],
    "beta_blocker": [r"\bMETOPROLOL\b"],
    "anticoagulant": [r"\bHEPARIN\b", r"\bENOXAPARIN\b", r"\bWARFARIN\b"],
    "antiplatelet": [r"\bASPIRIN\b", r"\bCLOPIDOGREL\b"],
    "ppi": [r"\b(PANTOPRAZOLE|OMEPRAZOLE|ESOMEPRAZOLE|LANSOPRAZOLE)\b"],
    "h2_blocker": [r"\b(RANITIDINE|FAMOTIDINE)\b"],
    "laxative": [r"\b(DOCUSATE|SENNA|BISACODYL|POLYETHYLENE GLYCOL|MILK OF MAGNESIA)\b"],
    "opioid": [r"\b(MORPHINE|HYDROMORPHONE|FENTANYL|OXYCODONE)\b"],
    "benzodiazepine": [r"\b(LORAZEPAM|MIDAZOLAM|DIAZEPAM)\b"],
    "bronchodilator": [r"\b(ALBUTEROL|IPRATROPIUM)\b"],
}
IV_ROUTES = ["IV", "IV DRIP", "IVPCA", "IV BOLUS"]
PO_ROUTES = ["PO", "ORAL", "PO/NG", "NG"]

WINDOW_HOURS = 48.0
SUFFIX = "_0_48h"


def family_regex(patterns: list[str]) -> str:
    """One case-insensitive alternation per family."""
    return "(?i)" + "|".join(f"(?:{p})" for p in patterns)


def normalise(orders: DataFrame) -> DataFrame:
    """Standardised generic name, drug name and route."""
    return (orders.withColumn("std_generic", std_text("drug_name_generic"))
            .withColumn("std_drug", std_text("drug"))
            .withColumn("std_route", std_text("route")))


def tag_name() -> F.Column:
    """Generic name, else the raw drug name when the generic is null or
    empty (P5)."""
    return F.coalesce(F.nullif(F.col("std_generic"), F.lit("")), F.nullif(F.col("std_drug"), F.lit("")))


def tag(orders: DataFrame, families: dict[str, list[str]] | None = None,
        iv_routes=None, po_routes=None, window_hours: float = WINDOW_HOURS) -> DataFrame:
    """P3-P6 per order: route flags, capped hours, family tags and hours."""
    families = FAMILY_PATTERNS if families is None else families
    iv_routes = IV_ROUTES if iv_routes is None else iv_routes
    po_routes = PO_ROUTES if po_routes is None else po_routes
    o = normalise(orders)
    hrs = F.least(F.greatest(F.coalesce(F.col("overlap_hours"), F.lit(0.0)), F.lit(0.0)), F.lit(window_hours))
    cols = [F.coalesce(F.col("std_route").isin(iv_routes), F.lit(False)).cast("int").alias("route_iv_flag"),
            F.coalesce(F.col("std_route").isin(po_routes), F.lit(False)).cast("int").alias("route_po_flag"),
            hrs.alias("hours_capped")]
    cols += family_flags(tag_name(), families)
    return o.select("*", *cols)


def family_flags(name: F.Column, families: dict[str, list[str]]) -> list[F.Column]:
    """P5: 0/1 for each family whose patterns a name matches."""
    return [F.coalesce(name.rlike(family_regex(pats)), F.lit(False)).cast("int").alias(f"fam_{fam}") for fam, pats in families.items()]


def tag_by_name(orders: DataFrame, families: dict[str, list[str]] | None = None, iv_routes=None, po_routes=None,
                window_hours: float = WINDOW_HOURS) -> DataFrame:
    """``tag`` with every distinct name matched once: the orders are staged
    without families, their names are tagged as a dictionary, and the flags
    are joined back. The dictionary is unique by name, so adaptive execution
    sends it to the orders where it is small and splits the rows of a name
    that a third of all orders carry where it is not."""
    families = FAMILY_PATTERNS if families is None else families
    keep = ["subject_id", "admission_id", "admittime", "overlap_start", "overlap_end", "std_generic", "std_route",
            "route_iv_flag", "route_po_flag", "hours_capped"]
    o = materialize(tag(orders, {}, iv_routes, po_routes, window_hours).select(*keep, tag_name().alias("__name")))
    names = o.select("__name").where(F.col("__name").isNotNull()).distinct()
    codes = materialize(names.select("__name", *family_flags(F.col("__name"), families)))
    flags = [F.coalesce(f"fam_{fam}", F.lit(0)).alias(f"fam_{fam}") for fam in families]
    return o.join(codes, "__name", "left").select(*keep, *flags)


def order_stats(tagged: DataFrame, families: list[str], suffix: str = SUFFIX) -> DataFrame:
    """P7-P10 per episode in one aggregation (map-side partial)."""
    aggs = [F.count(F.lit(1)).cast("int").alias(f"n_orders{suffix}"),
            F.count_distinct("std_generic").cast("int").alias(f"n_unique_generic{suffix}"),
            F.count_distinct("std_route").cast("int").alias(f"n_unique_route{suffix}"),
            F.sum("route_iv_flag").cast("int").alias(f"n_iv_orders{suffix}"),
            F.sum("route_po_flag").cast("int").alias(f"n_po_orders{suffix}")]
    for fam in families:
        aggs += [F.max(f"fam_{fam}").alias(f"{fam}_any{suffix}"),
                 F.sum(F.when(F.col(f"fam_{fam}") == 1, F.col("hours_capped")).otherwise(F.lit(0.0)))
                 .alias(f"{fam}_hours{suffix}")]
    g = tagged.groupBy("subject_id", "admission_id").agg(*aggs)
    n, iv, po = F.col(f"n_orders{suffix}"), F.col(f"n_iv_orders{suffix}"), F.col(f"n_po_orders{suffix}")
    return (g.withColumn(f"frac_iv_orders{suffix}", safe_ratio(iv, n))
            .withColumn(f"iv_any{suffix}", (iv > 0).cast("int"))
            .withColumn(f"po_any{suffix}", (po > 0).cast("int"))
            .withColumn(f"no_meds{suffix}", (n == 0).cast("int")))


def _swept(tagged: DataFrame, families: list[str], window_hours: float, buckets: int) -> DataFrame:
    """Intervals by (episode, family) with distinct starts s, ends e, and the
    largest end before each (``prev``), in microseconds from admission."""
    width = int(round(window_hours * HOUR_US / buckets))
    long = tagged.select("admission_id", "subject_id", "overlap_start", "overlap_end", "admittime",
                         F.explode(F.array(*[F.when(F.col(f"fam_{f}") == 1, F.lit(f)) for f in families]))
                         .alias("family")).where(F.col("family").isNotNull())
    rel_s = F.timestamp_diff("MICROSECOND", F.col("admittime"), F.col("overlap_start"))
    rel_e = F.timestamp_diff("MICROSECOND", F.col("admittime"), F.col("overlap_end"))
    keys = ["admission_id", "subject_id", "family"]
    d = long.select(*keys, rel_s.alias("s"), rel_e.alias("e")).groupBy(*keys, "s").agg(F.max("e").alias("e"))
    d = d.withColumn("slice", F.least(F.greatest(F.floor(F.col("s") / F.lit(width)), F.lit(0)),
                                      F.lit(buckets - 1)))
    tops = d.groupBy(*keys, "slice").agg(F.max("e").alias("slice_max"))
    w_off = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tops.select(*keys, "slice", F.max("slice_max").over(w_off).alias("before_slice"))
    w_in = Window.partitionBy(*keys, "slice").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("before_in", F.max("e").over(w_in)).join(offsets, [*keys, "slice"], "inner")
    return d.withColumn("prev", F.greatest(F.col("before_in"), F.col("before_slice")))        # greatest skips nulls


def count_islands(tagged: DataFrame, families: list[str], window_hours: float = WINDOW_HOURS, buckets: int = 32) -> DataFrame:
    """P11 audit: groups (episode, family), islands of touching intervals, and
    interval rows; the same two-level sweep as ``union_coverage``."""
    islands = _swept(tagged, families, window_hours, buckets).agg(
        F.count_distinct("admission_id", "family").alias("n_groups"),
        F.count_if(F.col("prev").isNull() | (F.col("prev") < F.col("s"))).alias("n_islands"))
    rows = tagged.agg(F.sum(sum((F.col(f"fam_{f}") for f in families), F.lit(0))).cast("long").alias("n_rows"))
    return islands.crossJoin(rows)


def union_coverage(tagged: DataFrame, families: list[str], window_hours: float = WINDOW_HOURS,
                   buckets: int = 32) -> DataFrame:
    """Length of the union of overlap intervals per (episode, family),
    touching intervals merged; coverage = min(union, W) / W.

    Sweep form: with intervals ordered by (start, end), interval i adds
    ``max(0, end_i - max(start_i, M_{i-1}))`` where ``M_{i-1}`` is the
    largest end seen before it; the sum is the union length, exactly. The
    running max is two-level so a hot episode never sits in one task: each
    interval goes to ONE time slice by its start (``buckets`` slices of the
    window), slice maxima are prefix-maxed over at most ``buckets`` rows,
    and the in-slice running max is a window per (episode, family, slice).
    No row is duplicated. Intervals of one start count as the longest of
    them, which a map-side maximum finds first; so the many orders that are
    clipped to the window's start reach their slice as one row.
    """
    d = _swept(tagged, families, window_hours, buckets)
    prev = F.col("prev")
    start = F.when(prev.isNull(), F.col("s")).otherwise(F.greatest(F.col("s"), prev))
    added = F.greatest(F.col("e") - start, F.lit(0))
    total = (d.groupBy("subject_id", "admission_id", "family")
             .agg((F.sum(added) / F.lit(float(HOUR_US))).alias("union_hours")))
    return total.withColumn("coverage", F.least(F.col("union_hours"), F.lit(window_hours)) / F.lit(window_hours))


def coverage_check(block: DataFrame, families: list[str], window_hours: float = WINDOW_HOURS,
                   suffix: str = SUFFIX) -> DataFrame:
    """Violation counts (coverage outside [0, 1] or above
    hours / W + 1e-6) as a ledger row rather than an abort."""
    aggs = []
    for fam in families:
        cov, hrs = F.col(f"{fam}_coverage{suffix}"), F.col(f"{fam}_hours{suffix}")
        aggs.append(F.count_if((cov < 0) | (cov > 1) | (cov > hrs / F.lit(window_hours) + F.lit(1e-6)))
                    .alias(f"{fam}_violations"))
    return block.agg(*aggs)


def interval_features(overlaps: DataFrame, cohort: DataFrame, families: dict[str, list[str]] | None = None,
                      iv_routes=None, po_routes=None, window_hours: float = WINDOW_HOURS,
                      suffix: str = SUFFIX, buckets: int = 32, no_meds_fill: int = 0) -> DataFrame:
    """One row per cohort episode: 9 order columns + any / hours /
    coverage per family. ``overlaps`` is the X5 output."""
    families = FAMILY_PATTERNS if families is None else families
    names = list(families)
    tagged = tag_by_name(overlaps, families, iv_routes, po_routes, window_hours)
    stats = order_stats(tagged, names, suffix)
    cov = union_coverage(tagged, names, window_hours, buckets)
    cov_wide = (cov.groupBy("subject_id", "admission_id").pivot("family", names).agg(F.first("coverage")))
    cov_wide = cov_wide.select("subject_id", "admission_id",
                               *[F.col(f).alias(f"{f}_coverage{suffix}") for f in names])
    base = cohort.select("subject_id", "admission_id").distinct()
    out = base.join(stats, ["subject_id", "admission_id"], "left") \
              .join(cov_wide, ["subject_id", "admission_id"], "left")
    return fill_and_cast(out, names, suffix, no_meds_fill)


def block_columns(families: list[str], suffix: str = SUFFIX) -> tuple[list[str], list[str], list[str]]:
    counts = [f"n_orders{suffix}", f"n_unique_generic{suffix}", f"n_unique_route{suffix}",
              f"n_iv_orders{suffix}", f"n_po_orders{suffix}"]
    flags = [f"iv_any{suffix}", f"po_any{suffix}", f"no_meds{suffix}"] + [f"{f}_any{suffix}" for f in families]
    doubles = ([f"{f}_hours{suffix}" for f in families] + [f"frac_iv_orders{suffix}"]
               + [f"{f}_coverage{suffix}" for f in families])
    return counts, flags, doubles


def fill_and_cast(df: DataFrame, families: list[str], suffix: str = SUFFIX, no_meds_fill: int = 0) -> DataFrame:
    """Zeros for episodes without orders, fixed dtypes, stable order.
    ``no_meds_fill=0`` reproduces the reference (the flag is then always 0,
    Q3); ``1`` marks episodes without any order."""
    counts, flags, doubles = block_columns(families, suffix)
    df = df.withColumn(f"no_meds{suffix}", F.coalesce(F.col(f"no_meds{suffix}"), F.lit(no_meds_fill)))
    cols = [F.col("subject_id"), F.col("admission_id")]
    cols += [F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in counts]
    cols.append(F.coalesce(F.col(f"frac_iv_orders{suffix}"), F.lit(0.0)).cast("double").alias(f"frac_iv_orders{suffix}"))
    cols += [F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in flags]
    for f in families:
        for c in (f"{f}_hours{suffix}", f"{f}_coverage{suffix}"):
            cols.append(F.coalesce(F.col(c), F.lit(0.0)).cast("double").alias(c))
    return df.select(*cols)
