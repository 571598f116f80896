"""Demographic attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.functions.expressions import coarse_group

# Fixed values that must equal the reference: allow-lists (anything else
# becomes null) and the ordered ethnicity rules. Rules are applied in
# order and the LAST matching rule wins. Each rule: (label, kind, values)
# with kind "eq" (equals one of values), "contains" (contains one of
# values), or "contains_not" (contains one of values[0] and none of
# values[1]).
INSURANCE_ALLOWED = ["medicare", "private", "medicaid", "government", "self pay"]
ADMISSION_TYPE_ALLOWED = ["EMERGENCY", "NEWBORN", "ELECTIVE", "URGENT"]
ADMISSION_LOCATION_ALLOWED = [
    "EMERGENCY ROOM ADMIT", "TRANSFER FROM HOSP/EXTRAM", "TRANSFER FROM OTHER HEALT",
    "CLINIC REFERRAL/PREMATURE", "** INFO NOT AVAILABLE **", "TRANSFER FROM SKILLED NUR",
    "TRSF WITHIN THIS FACILITY", "HMO REFERRAL/SICK", "PHYS REFERRAL/NORMAL DELI",
]
ETHNICITY_RULES = [
    ("DECLINED", "eq", ["patient declined to answer"]),
    ("OTHER", "eq", ["other"]),
    ("MULTI RACE", "eq", ["multi race ethnicity"]),
    ("UNKNOWN", "eq", ["unknown/not specified", "unable to obtain"]),
    ("AFRICAN AMERICAN", "contains", ["african american"]),
    ("AFRICAN", "contains_not", [["black", "african"], ["american"]]),
    ("CARIBBEAN", "eq_or_contains", [["black/haitian"], ["caribbean"]]),
    ("NATIVE AMERICAN", "contains", ["native american", "alaska native", "american indian"]),
    ("PACIFIC ISLANDER", "contains", ["native hawaiian", "pacific islander"]),
    ("HISPANIC", "eq_or_contains", [["portuguese"], ["hispanic", "latino", "central american", "south american"]]),
    ("ASIAN", "contains", ["asian"]),
    ("WHITE", "contains", ["white"]),
    ("MIDDLE EASTERN", "contains", ["middle eastern", "arab"]),
]


def standardise(c, case: str = "upper") -> F.Column:
    """Trim (all whitespace) and upper/lower case; null stays null."""
    t = F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"^\s+|\s+$", "")
    return F.upper(t) if case == "upper" else F.lower(t)


def allow_list(c, allowed: list[str]) -> F.Column:
    """Value outside the list -> null."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x.isin(allowed), x)


def _rule_pred(x: F.Column, kind: str, values) -> F.Column:
    def any_contains(vals):
        p = F.lit(False)
        for v in vals:
            p = p | x.contains(v)
        return p
    if kind == "eq":
        return x.isin(values)
    if kind == "contains":
        return any_contains(values)
    if kind == "contains_not":
        return any_contains(values[0]) & ~any_contains(values[1])
    if kind == "eq_or_contains":
        return x.isin(values[0]) | any_contains(values[1])
    raise ValueError(kind)


def rule_classifier(c, rules=None) -> F.Column:
    """D3: ordered rules, last match wins, no match -> null. Built as a
    reversed ``when`` chain so the first true branch is the last rule."""
    rules = ETHNICITY_RULES if rules is None else rules
    x = F.col(c) if isinstance(c, str) else c
    expr = None
    for label, kind, values in reversed(rules):
        pred = F.coalesce(_rule_pred(x, kind, values), F.lit(False))
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def demographics_block(cohort: DataFrame, subjects: DataFrame, episodes: DataFrame, age_col=None,
                       attrs: dict | None = None, rules=None) -> DataFrame:
    """D4 + D5: one left join to subjects and one to episodes (not one per
    attribute), then every attribute as an expression. ``attrs`` maps each
    output to (source column, case, allow-list or None)."""
    from stayframe.functions.expressions import age_years
    attrs = attrs or {
        "gender": ("gender_raw", "upper", None),
        "insurance": ("insurance_raw", "lower", INSURANCE_ALLOWED),
        "admission_type": ("admission_type_raw", "upper", ADMISSION_TYPE_ALLOWED),
        "admission_location": ("admission_location_raw", "upper", ADMISSION_LOCATION_ALLOWED),
    }
    j = (cohort.select("subject_id", "admission_id", "admittime")
         .join(subjects, "subject_id", "left")
         .join(episodes.drop("subject_id", "admittime", "dischtime"), "admission_id", "left"))
    cols = [F.col("subject_id"), F.col("admission_id"), age_years("admittime", "dob").alias("age")]
    eth_raw = standardise("ethnicity_raw", "lower")
    cols += [eth_raw.alias("eth_raw"), rule_classifier(eth_raw, rules).alias("eth_broad")]
    for out, (src, case, allowed) in attrs.items():
        v = standardise(src, case)
        cols.append((allow_list(v, allowed) if allowed else v).alias(out))
    return j.select(*cols)


def coarse_groups(df: DataFrame, raw: str = "eth_raw") -> DataFrame:
    """White / black / asian / hispanic / other by prefix."""
    return df.withColumn("eth_coarse", coarse_group(raw))


def prefix_canonicalise(values: DataFrame, col: str = "value") -> DataFrame:
    """D7 (optional in the reference): letters-only lower-case codes mapped
    to their longest observed superstring that starts with them (the last by
    name among equally long ones). Every code is exploded into its prefixes
    (bounded by the string length), and a prefix keeps its longest member
    before anything is joined: the maximum combines map-side, so a first
    letter that most codes share is one row a task, and the join is one to
    one."""
    v = (values.select(F.regexp_replace(F.lower(F.col(col)), r"[^a-z]", "").alias("code"))
         .where(F.length("code") > 0).distinct())
    member = F.expr("transform(sequence(1, length(code)), n -> substring(code, 1, n))")
    longest = (v.select("code", F.explode(member).alias("prefix"))
               .groupBy("prefix").agg(F.max(F.struct(F.length("code").alias("n"), F.col("code").alias("canonical"))).alias("best")))
    return v.join(longest, F.col("code") == F.col("prefix")).select("code", F.col("best.canonical").alias("canonical"))
