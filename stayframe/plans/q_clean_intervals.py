"""Cleaning (M1-M9) and interval (X5, P1-P14) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.functions.expressions import std_text, std_unit
from stayframe.operators import clean as M
from stayframe.operators import extract as X
from stayframe.operators import intervals as P
from stayframe.plans import sql_adapters as A
from stayframe.plans.registry import register, round_sql
from stayframe.sources import adapters as ad

# ---- cleaning over the dirty events view ------------------------------------

DIRTY_F = ["view"]  # items recorded in Fahrenheit in the dirty view


def _dirty(spark, d):
    return ad.dirty_measurements(spark, d)


@register("drop_both_null", A.with_(A.DIRTY) + """
SELECT itemid, count(*) AS n FROM dirty WHERE NOT (value IS NULL AND valuenum IS NULL) GROUP BY 1""")
def q_drop_both_null(spark, d):
    """M1."""
    return M.drop_both_null(_dirty(spark, d)).groupBy("itemid").agg(F.count(F.lit(1)).alias("n"))


@register("null_audit", A.with_(A.DIRTY) + """
SELECT itemid, count(*) FILTER (WHERE value IS NULL AND valuenum IS NULL) AS n_both_null,
       count(*) FILTER (WHERE value IS NULL AND valuenum IS NOT NULL) AS n_only_value_null,
       count(*) FILTER (WHERE value IS NOT NULL AND valuenum IS NULL) AS n_only_valuenum_null
FROM dirty GROUP BY 1""")
def q_null_audit(spark, d):
    """M1 ledger."""
    return M.null_audit(_dirty(spark, d))


@register("to_numeric_drop", A.with_(A.DIRTY) + """
SELECT itemid, count(*) AS n, round(sum(valuenum), 6) AS total FROM dirty
WHERE TRY_CAST(valuenum AS DOUBLE) IS NOT NULL AND NOT isnan(valuenum) GROUP BY 1""")
def q_to_numeric_drop(spark, d):
    """M2."""
    return M.to_numeric_drop(_dirty(spark, d)).groupBy("itemid").agg(
        F.count(F.lit(1)).alias("n"), F.sum("valuenum").alias("total"))


BOUNDED = """b AS (
  SELECT m.*, k.min_bound, k.max_bound FROM dirty m LEFT JOIN dict k ON m.itemid = k.itemid
  WHERE NOT (m.value IS NULL AND m.valuenum IS NULL) AND m.valuenum IS NOT NULL
    AND NOT (k.min_bound IS NOT NULL AND k.max_bound IS NOT NULL
             AND (m.valuenum < k.min_bound OR m.valuenum > k.max_bound)))"""


@register("bounds_filter", A.with_(A.DIRTY, A.DICTIONARY, BOUNDED) + """
SELECT itemid, count(*) AS n, min(valuenum) AS vmin, max(valuenum) AS vmax FROM b GROUP BY 1""")
def q_bounds_filter(spark, d):
    """M3: inclusive bounds, unbounded items kept."""
    c = M.bounds_filter(M.drop_both_null(_dirty(spark, d)), ad.dirty_dictionary(spark))
    return c.groupBy("itemid").agg(F.count(F.lit(1)).alias("n"), F.min("valuenum").alias("vmin"),
                                   F.max("valuenum").alias("vmax"))


@register("bounds_audit", A.with_(A.DIRTY, A.DICTIONARY) + """
SELECT m.itemid, count(*) AS n_rows, count(*) FILTER (WHERE m.valuenum IS NULL) AS n_non_numeric,
  count(*) FILTER (WHERE k.min_bound IS NOT NULL AND k.max_bound IS NOT NULL AND m.valuenum IS NOT NULL
                   AND (m.valuenum < k.min_bound OR m.valuenum > k.max_bound)) AS n_out_of_bounds,
  count(*) FILTER (WHERE k.min_bound IS NULL OR k.max_bound IS NULL) AS n_no_bounds,
  count(*) FILTER (WHERE m.valuenum = 0) AS n_zero
FROM dirty m LEFT JOIN dict k ON m.itemid = k.itemid GROUP BY 1""")
def q_bounds_audit(spark, d):
    """M4."""
    return M.bounds_audit(_dirty(spark, d), ad.dirty_dictionary(spark))


@register("map_feature_name", A.with_(A.DIRTY, A.DICTIONARY) + """
SELECT k.feature_name, count(*) AS n FROM dirty m LEFT JOIN dict k ON m.itemid = k.itemid GROUP BY 1""")
def q_map_feature_name(spark, d):
    """M5 (warn policy: unmapped rows keep a null name)."""
    return M.map_feature_name(_dirty(spark, d), ad.dirty_dictionary(spark)) \
        .groupBy("feature_name").agg(F.count(F.lit(1)).alias("n"))


@register("unmapped_items", A.with_(A.DIRTY, A.DICTIONARY) + """
SELECT itemid, count(*) AS n_rows FROM dirty WHERE itemid NOT IN (SELECT itemid FROM dict) GROUP BY 1""")
def q_unmapped_items(spark, d):
    """M5 ledger."""
    return M.unmapped_items(_dirty(spark, d), ad.dirty_dictionary(spark))


@register("assert_unique_mapping", A.with_(A.DICTIONARY) + """
SELECT itemid, count(DISTINCT feature_name) AS n_names FROM (
  SELECT event_type AS itemid, event_type AS feature_name FROM events
  UNION ALL SELECT itemid, feature_name FROM dict) t GROUP BY 1 HAVING count(DISTINCT feature_name) > 1""")
def q_assert_unique_mapping(spark, d):
    """M6: conflicts in a dictionary merged from the data's own item names
    and the bounds dictionary (every renamed item conflicts)."""
    e = ad.measurements(spark, d).select("itemid", "feature_name").distinct()
    return M.mapping_conflicts(e.unionByName(ad.dirty_dictionary(spark).select("itemid", "feature_name")))


@register("convert_unit", A.with_(A.DIRTY, A.DICTIONARY) + """
SELECT CASE WHEN m.itemid IN ('view') THEN 'TempC' ELSE k.feature_name END AS feature_name,
       count(*) AS n,
       round(sum(CASE WHEN m.itemid IN ('view') THEN (m.valuenum - 32.0) * (5.0 / 9.0) ELSE m.valuenum END), 6) AS total
FROM dirty m LEFT JOIN dict k ON m.itemid = k.itemid WHERE m.valuenum IS NOT NULL GROUP BY 1""")
def q_convert_unit(spark, d):
    """M7: Fahrenheit items converted, feature and unit renamed."""
    m = M.map_feature_name(_dirty(spark, d).where(F.col("valuenum").isNotNull()), ad.dirty_dictionary(spark))
    c = M.convert_unit(m, DIRTY_F)
    return c.groupBy("feature_name").agg(F.count(F.lit(1)).alias("n"), F.sum("valuenum").alias("total"))


@register("alias_feature", A.with_(A.DIRTY, A.DICTIONARY) + """
SELECT CASE WHEN k.feature_name = 'TempF' THEN 'TempC' ELSE k.feature_name END AS feature_name, count(*) AS n
FROM dirty m LEFT JOIN dict k ON m.itemid = k.itemid GROUP BY 1""")
def q_alias_feature(spark, d):
    """M8: TempF -> TempC by name."""
    m = M.map_feature_name(_dirty(spark, d), ad.dirty_dictionary(spark))
    return M.alias_feature(m).groupBy("feature_name").agg(F.count(F.lit(1)).alias("n"))


@register("clean_measurements", round_sql(A.with_(A.DIRTY, A.DICTIONARY, BOUNDED) + """
SELECT b.row_id, CASE WHEN b.itemid IN ('view') THEN 'TempC' ELSE k.feature_name END AS feature_name,
       CASE WHEN b.itemid IN ('view') THEN (b.valuenum - 32.0) * (5.0 / 9.0) ELSE b.valuenum END AS valuenum,
       CASE WHEN b.itemid IN ('view') THEN 'C' ELSE b.valueuom END AS valueuom
FROM b LEFT JOIN dict k ON b.itemid = k.itemid""", ["valuenum"]))
def q_clean_measurements(spark, d):
    """M9: M1 -> M2/M3 -> M5 -> M7, one lazy plan."""
    c = M.clean_measurements(_dirty(spark, d), ad.dirty_dictionary(spark), DIRTY_F)
    return c.select("row_id", "feature_name", "valuenum", "valueuom")


# ---- intervals ----------------------------------------------------------------

WORD2 = ["widget", "gear", "rod", "ring", "anvil", "bolt", "gizmo", "plate"]
WORD1 = ["small", "old", "hot", "cold", "red", "blue", "large", "new"]
FAMILIES = {w: [rf"\b{w.upper()}\b"] for w in WORD2 + WORD1}
IV, PO = ["R"], ["A"]
W_H = ad.INTERVAL_WINDOW_HOURS
SFX = "_win"


def _overlaps(spark, d):
    return X.interval_overlap(ad.intervals(spark, d), ad.interval_episodes(spark, d), W_H)


def _tagged(spark, d):
    return P.tag(_overlaps(spark, d), FAMILIES, IV, PO, W_H)


def _block(spark, d):
    return P.interval_features(_overlaps(spark, d), ad.interval_episodes(spark, d), FAMILIES, IV, PO, W_H, SFX)


OVL = f"""ovl AS (
  SELECT i.*, c.admittime, greatest(i.startdate, c.admittime) AS os,
         least(i.enddate, c.admittime + INTERVAL {int(W_H)} HOUR) AS oe
  FROM ivl i JOIN icohort c ON i.admission_id = c.admission_id),
ov AS (
  SELECT *, CAST(date_diff('minute', os, oe) AS DOUBLE) / 60.0 AS overlap_hours,
         upper(regexp_replace(regexp_replace(drug_name_generic, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')) AS g,
         upper(regexp_replace(regexp_replace(route, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')) AS r
  FROM ovl WHERE os IS NOT NULL AND oe IS NOT NULL AND oe > os)"""

FAM_VALUES = ", ".join(f"('{f}', '(?i)\\b{f.upper()}\\b')" for f in FAMILIES)
FAMS = f"fams AS (SELECT * FROM (VALUES {FAM_VALUES}) t(family, pat))"
TAGGED = """tg AS (
  SELECT ov.*, f.family, least(greatest(coalesce(overlap_hours, 0.0), 0.0), 2160.0) AS hc
  FROM ov JOIN fams f ON regexp_matches(ov.g, f.pat))"""
ISL = """isl AS (
  SELECT admission_id, family, os, oe,
         CASE WHEN max(oe) OVER (PARTITION BY admission_id, family ORDER BY os, oe
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= os THEN 0 ELSE 1 END AS nw
  FROM tg),
isl2 AS (SELECT *, sum(nw) OVER (PARTITION BY admission_id, family ORDER BY os, oe
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM isl),
uni AS (SELECT admission_id, family, sum(len) / 3600000000.0 AS union_hours FROM (
  SELECT admission_id, family, island, epoch_us(max(oe)) - epoch_us(min(os)) AS len FROM isl2 GROUP BY 1, 2, 3) z
  GROUP BY 1, 2)"""
BASE_I = [A.INTERVALS, A.INTERVAL_COHORT, OVL]


@register("interval_overlap", round_sql(A.with_(*BASE_I) + """
SELECT admission_id, count(*) AS n, sum(overlap_hours) AS hours, min(os) AS first_start, max(oe) AS last_end
FROM ov GROUP BY 1""", ["hours"]))
def q_interval_overlap(spark, d):
    """Clip to the window, positive overlaps, minute-boundary hours."""
    return _overlaps(spark, d).groupBy("admission_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("overlap_hours").alias("hours"),
        F.min("overlap_start").alias("first_start"), F.max("overlap_end").alias("last_end"))


@register("std_text", """
SELECT p_partkey, upper(regexp_replace(regexp_replace(concat(' ', p_name, chr(9), ' ', p_type, '  '),
       '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')) AS std FROM part""")
def q_std_text(spark, d):
    """Trim all whitespace, upper, collapse runs."""
    p = spark.read.parquet(f"{d}/part.parquet")
    return p.select("p_partkey", std_text(F.concat(F.lit(" "), "p_name", F.lit("\t "), "p_type", F.lit("  ")))
                    .alias("std"))


@register("std_unit", """
SELECT p_partkey, upper(regexp_replace(concat(p_brand, '. ', p_type), '[.\\s]', '', 'g')) AS unit FROM part""")
def q_std_unit(spark, d):
    """Upper, no dots or whitespace."""
    p = spark.read.parquet(f"{d}/part.parquet")
    return p.select("p_partkey", std_unit(F.concat("p_brand", F.lit(". "), "p_type")).alias("unit"))


@register("route_flags", A.with_(*BASE_I) + """
SELECT CAST(r IN ('R') AS INTEGER) AS route_iv_flag, CAST(r IN ('A') AS INTEGER) AS route_po_flag, count(*) AS n
FROM ov GROUP BY 1, 2""")
def q_route_flags(spark, d):
    """P3."""
    return _tagged(spark, d).groupBy("route_iv_flag", "route_po_flag").agg(F.count(F.lit(1)).alias("n"))


@register("cap_hours", round_sql(A.with_(*BASE_I) + """
SELECT admission_id, sum(least(greatest(overlap_hours, 0.0), 2160.0)) AS capped, max(overlap_hours) AS raw_max
FROM ov GROUP BY 1""", ["capped", "raw_max"]))
def q_cap_hours(spark, d):
    """Hours clipped to [0, W]."""
    return _tagged(spark, d).groupBy("admission_id").agg(F.sum("hours_capped").alias("capped"),
                                                         F.max("overlap_hours").alias("raw_max"))


@register("tag_families", A.with_(*BASE_I, FAMS, TAGGED) + "SELECT family, count(*) AS n FROM tg GROUP BY 1")
def q_tag_families(spark, d):
    """P5: multi-label family tags, one alternation per family."""
    t = _tagged(spark, d)
    long = t.select(F.explode(F.array(*[F.when(F.col(f"fam_{f}") == 1, F.lit(f)) for f in FAMILIES]))
                    .alias("family")).where(F.col("family").isNotNull())
    return long.groupBy("family").agg(F.count(F.lit(1)).alias("n"))


@register("family_hours", round_sql(A.with_(*BASE_I, FAMS, TAGGED) + """
SELECT admission_id, family, sum(hc) AS hours FROM tg GROUP BY 1, 2""", ["hours"]))
def q_family_hours(spark, d):
    """P6 (long form): exposure hours per episode and family."""
    t = _tagged(spark, d)
    long = t.select("admission_id", "hours_capped", F.explode(F.array(
        *[F.when(F.col(f"fam_{f}") == 1, F.lit(f)) for f in FAMILIES])).alias("family")) \
        .where(F.col("family").isNotNull())
    return long.groupBy("admission_id", "family").agg(F.sum("hours_capped").alias("hours"))


ORDER_SQL = """oc AS (
  SELECT admission_id, count(*) AS n_orders, count(DISTINCT g) AS n_generic, count(DISTINCT r) AS n_route,
         count(*) FILTER (WHERE r IN ('R')) AS n_iv, count(*) FILTER (WHERE r IN ('A')) AS n_po
  FROM ov GROUP BY 1)"""


@register("order_counts", A.with_(*BASE_I, ORDER_SQL) + f"""
SELECT admission_id, CAST(n_orders AS INTEGER) AS n_orders{SFX}, CAST(n_generic AS INTEGER) AS n_unique_generic{SFX},
       CAST(n_route AS INTEGER) AS n_unique_route{SFX}, CAST(n_iv AS INTEGER) AS n_iv_orders{SFX},
       CAST(n_po AS INTEGER) AS n_po_orders{SFX} FROM oc""")
def q_order_counts(spark, d):
    """P7."""
    s = P.order_stats(_tagged(spark, d), list(FAMILIES), SFX)
    return s.select("admission_id", *[f"{c}{SFX}" for c in
                                      ["n_orders", "n_unique_generic", "n_unique_route", "n_iv_orders", "n_po_orders"]])


@register("safe_ratio", A.with_(*BASE_I, ORDER_SQL) + f"""
SELECT admission_id, round(coalesce(n_iv / nullif(n_orders, 0), 0.0), 6) AS frac_iv_orders{SFX} FROM oc""")
def q_safe_ratio(spark, d):
    """P8."""
    return P.order_stats(_tagged(spark, d), list(FAMILIES), SFX).select("admission_id", f"frac_iv_orders{SFX}")


@register("any_flags", A.with_(*BASE_I, FAMS, TAGGED, ORDER_SQL) + f"""
SELECT oc.admission_id, CAST(n_iv > 0 AS INTEGER) AS iv_any{SFX}, CAST(n_po > 0 AS INTEGER) AS po_any{SFX},
       CAST(n_orders = 0 AS INTEGER) AS no_meds{SFX}, coalesce(t.n_fam, 0) AS n_families_any
FROM oc LEFT JOIN (SELECT admission_id, count(DISTINCT family) AS n_fam FROM tg GROUP BY 1) t
  ON oc.admission_id = t.admission_id""")
def q_any_flags(spark, d):
    """iv/po/no-meds flags plus how many families are present."""
    s = P.order_stats(_tagged(spark, d), list(FAMILIES), SFX)
    n_any = sum((F.col(f"{f}_any{SFX}") for f in FAMILIES), F.lit(0)).cast("bigint")
    return s.select("admission_id", f"iv_any{SFX}", f"po_any{SFX}", f"no_meds{SFX}", n_any.alias("n_families_any"))


@register("family_total_hours", round_sql(A.with_(*BASE_I, FAMS, TAGGED) + """
SELECT admission_id, sum(hc) AS total_family_hours FROM tg GROUP BY 1""", ["total_family_hours"]))
def q_family_total_hours(spark, d):
    """P10: summed family hours, overlaps double-counted."""
    s = P.order_stats(_tagged(spark, d), list(FAMILIES), SFX)
    tot = sum((F.col(f"{f}_hours{SFX}") for f in FAMILIES), F.lit(0.0))
    return s.select("admission_id", tot.alias("total_family_hours")).where(
        sum((F.col(f"{f}_any{SFX}") for f in FAMILIES), F.lit(0)) > 0)


@register("union_coverage", round_sql(A.with_(*BASE_I, FAMS, TAGGED, ISL) + f"""
SELECT admission_id, family, union_hours, least(union_hours, {W_H}) / {W_H} AS coverage FROM uni""",
                                      ["union_hours", "coverage"]))
def q_union_coverage(spark, d):
    """Gaps-and-islands union length per (episode, family), split into
    time slices so a hot episode spreads over many tasks."""
    return P.union_coverage(_tagged(spark, d), list(FAMILIES), W_H).select(
        "admission_id", "family", "union_hours", "coverage")


@register("union_islands", A.with_(*BASE_I, FAMS, TAGGED, ISL) + """
SELECT count(DISTINCT (admission_id, family)) AS n_groups, count(*) FILTER (WHERE nw = 1) AS n_islands,
       count(*) AS n_rows FROM isl""")
def q_union_islands(spark, d):
    """P11 audit: groups, islands and rows, by the two-level sweep."""
    return P.count_islands(_tagged(spark, d), list(FAMILIES), W_H)


def _block_sql():
    fams = list(FAMILIES)
    counts, flags, doubles = P.block_columns(fams, SFX)
    sel = ["c.subject_id", "c.admission_id",
           f"CAST(coalesce(oc.n_orders, 0) AS INTEGER) AS n_orders{SFX}",
           f"CAST(coalesce(oc.n_generic, 0) AS INTEGER) AS n_unique_generic{SFX}",
           f"CAST(coalesce(oc.n_route, 0) AS INTEGER) AS n_unique_route{SFX}",
           f"CAST(coalesce(oc.n_iv, 0) AS INTEGER) AS n_iv_orders{SFX}",
           f"CAST(coalesce(oc.n_po, 0) AS INTEGER) AS n_po_orders{SFX}",
           f"coalesce(oc.n_iv / nullif(oc.n_orders, 0), 0.0) AS frac_iv_orders{SFX}",
           f"CAST(coalesce(oc.n_iv, 0) > 0 AS INTEGER) AS iv_any{SFX}",
           f"CAST(coalesce(oc.n_po, 0) > 0 AS INTEGER) AS po_any{SFX}",
           f"CAST(coalesce(oc.n_orders = 0, false) AS INTEGER) AS no_meds{SFX}"]
    for f in fams:
        sel.append(f"CAST(coalesce(fh.any_{f}, 0) AS INTEGER) AS {f}_any{SFX}")
    for f in fams:
        sel.append(f"coalesce(fh.h_{f}, 0.0) AS {f}_hours{SFX}")
        sel.append(f"coalesce(cv.c_{f}, 0.0) AS {f}_coverage{SFX}")
    fh = ", ".join(f"max(CASE WHEN family = '{f}' THEN 1 ELSE 0 END) AS any_{f}, "
                   f"sum(CASE WHEN family = '{f}' THEN hc ELSE 0.0 END) AS h_{f}" for f in fams)
    cv = ", ".join(f"max(CASE WHEN family = '{f}' THEN least(union_hours, {W_H}) / {W_H} END) AS c_{f}" for f in fams)
    sql = (A.with_(*BASE_I, FAMS, TAGGED, ISL, ORDER_SQL,
                   f"fh AS (SELECT admission_id, {fh} FROM tg GROUP BY 1)",
                   f"cv AS (SELECT admission_id, {cv} FROM uni GROUP BY 1)")
           + f"SELECT {', '.join(sel)} FROM icohort c LEFT JOIN oc ON c.admission_id = oc.admission_id "
             f"LEFT JOIN fh ON c.admission_id = fh.admission_id LEFT JOIN cv ON c.admission_id = cv.admission_id")
    return sql, doubles


_BSQL, _BDBL = _block_sql()


@register("interval_features", round_sql(_BSQL, _BDBL))
def q_interval_features(spark, d):
    """Whole interval block per episode."""
    return _block(spark, d)


_COUNTS, _FLAGS, _DOUBLES = P.block_columns(list(FAMILIES), SFX)
_EMPTY_SQL = ", ".join(f"0 AS {c}" for c in [*_COUNTS, *_FLAGS]) + ", " + ", ".join(f"CAST(0 AS DOUBLE) AS {c}" for c in _DOUBLES)


@register("fill_and_cast", round_sql(f"""SELECT * FROM ({_BSQL}) b
UNION ALL BY NAME SELECT subject_id, admission_id + 10000000 AS admission_id, {_EMPTY_SQL} FROM ({_BSQL}) b""", _DOUBLES))
def q_fill_and_cast(spark, d):
    """A second episode without orders beside each cohort episode; its row
    is filled with zeros of the fixed types."""
    cohort = ad.interval_episodes(spark, d)
    without = cohort.withColumn("admission_id", F.col("admission_id") + 10000000)
    return P.interval_features(_overlaps(spark, d), cohort.unionByName(without), FAMILIES, IV, PO, W_H, SFX)


@register("coverage_check", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {f}_coverage{SFX} < 0 OR {f}_coverage{SFX} > 1 OR "
    f"{f}_coverage{SFX} > {f}_hours{SFX} / {W_H} + 1e-6) AS {f}_violations" for f in FAMILIES)
    + f" FROM ({_BSQL}) b")
def q_coverage_check(spark, d):
    """Invariant violations as a ledger row."""
    return P.coverage_check(_block(spark, d), list(FAMILIES), W_H, SFX)
