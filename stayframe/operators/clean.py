"""Measurement cleaning against an item dictionary (M1-M9).

The dictionary is configuration (tens of items), so it is broadcast; the
measurement side never shuffles for cleaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference: the single Fahrenheit item it
# converts, and the feature renamed after conversion.
FAHRENHEIT_ITEMS = [223761]
FEATURE_ALIASES = {"TempF": "TempC"}


def drop_both_null(df: DataFrame) -> DataFrame:
    """M1: drop rows whose text value and numeric value are both null."""
    return df.where(~(F.col("value").isNull() & F.col("valuenum").isNull()))


def null_audit(df: DataFrame) -> DataFrame:
    """M1 ledger: per item, both-null (dropped) and one-sided null counts."""
    v, n = F.col("value").isNull(), F.col("valuenum").isNull()
    return df.groupBy("itemid").agg(F.count_if(v & n).alias("n_both_null"),
                                    F.count_if(v & ~n).alias("n_only_value_null"),
                                    F.count_if(~v & n).alias("n_only_valuenum_null"))


def _numeric(c: str = "valuenum") -> F.Column:
    x = F.col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def to_numeric_drop(df: DataFrame) -> DataFrame:
    """M2: coerce the numeric value, drop failures and NaN."""
    return df.withColumn("valuenum", _numeric()).where(F.col("valuenum").isNotNull())


def _with_bounds(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    b = dictionary.select("itemid", "min_bound", "max_bound").dropDuplicates(["itemid"])
    return df.join(b, "itemid", "left")


def bounds_filter(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """M2 + M3: numeric values only, then keep ``min <= v <= max``; items
    without both bounds are kept."""
    j = _with_bounds(df, dictionary).withColumn("valuenum", _numeric())
    have = F.col("min_bound").isNotNull() & F.col("max_bound").isNotNull()
    oob = have & ((F.col("valuenum") < F.col("min_bound")) | (F.col("valuenum") > F.col("max_bound")))
    return j.where(F.col("valuenum").isNotNull() & ~oob).drop("min_bound", "max_bound")


def bounds_audit(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """M4: per item, non-numeric, out-of-bounds, no-bounds and zero counts."""
    j = _with_bounds(df, dictionary).withColumn("v", _numeric())
    have = F.col("min_bound").isNotNull() & F.col("max_bound").isNotNull()
    oob = have & F.col("v").isNotNull() & ((F.col("v") < F.col("min_bound")) | (F.col("v") > F.col("max_bound")))
    return j.groupBy("itemid").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("v").isNull()).alias("n_non_numeric"),
        F.count_if(oob).alias("n_out_of_bounds"),
        F.count_if(~have).alias("n_no_bounds"),
        F.count_if(F.col("v") == 0).alias("n_zero"))


def map_feature_name(df: DataFrame, dictionary: DataFrame, policy: str = "warn") -> DataFrame:
    """M5: item -> feature name by left join. ``policy``: ``warn``
    / ``keep`` keep unmapped rows with a null name (see ``unmapped_items``
    for the ledger); ``raise`` fails when any row is unmapped."""
    mapping = dictionary.select("itemid", "feature_name").dropDuplicates(["itemid"])
    out = df.drop("feature_name").join(mapping, "itemid", "left")
    if policy == "raise":
        bad = out.where(F.col("feature_name").isNull()).select("itemid").limit(1).collect()
        if bad:
            raise ValueError(f"item(s) without a feature name, e.g. {bad[0]['itemid']}")
    return out


def unmapped_items(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """M5 ledger: rows per item that has no dictionary entry."""
    return (df.join(dictionary.select("itemid"), "itemid", "left_anti")
            .groupBy("itemid").agg(F.count(F.lit(1)).alias("n_rows")))


def mapping_conflicts(dictionary: DataFrame) -> DataFrame:
    """M6: items with more than one distinct feature name (nulls count as a
    name, as in the reference)."""
    name = F.coalesce(F.col("feature_name"), F.lit("\u0000null"))
    return (dictionary.groupBy("itemid").agg(F.count_distinct(name).alias("n_names"))
            .where(F.col("n_names") > 1))


def assert_unique_mapping(dictionary: DataFrame) -> DataFrame:
    bad = mapping_conflicts(dictionary).limit(1).collect()
    if bad:
        raise ValueError(f"non-unique item -> feature mapping for item {bad[0]['itemid']}")
    return dictionary


def convert_unit(df: DataFrame, items: list, to_name: str = "TempC", to_unit: str = "C") -> DataFrame:
    """M7: Fahrenheit -> Celsius for the listed items; rename feature and
    unit on those rows only (bounds were tested before, in the item's own
    unit: Q2)."""
    hit = F.col("itemid").isin(items)
    return (df.withColumn("valuenum", F.when(hit & F.col("valuenum").isNotNull(),
                                             (F.col("valuenum") - 32.0) * (5.0 / 9.0)).otherwise(F.col("valuenum")))
            .withColumn("feature_name", F.when(hit, F.lit(to_name)).otherwise(F.col("feature_name")))
            .withColumn("valueuom", F.when(hit, F.lit(to_unit)).otherwise(F.col("valueuom"))))


def alias_feature(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """M8: rename feature names (TempF -> TempC by default)."""
    aliases = FEATURE_ALIASES if aliases is None else aliases
    c = F.col("feature_name")
    expr = c
    for src, dst in aliases.items():
        expr = F.when(c == src, F.lit(dst)).otherwise(expr)
    return df.withColumn("feature_name", expr)


def clean_measurements(df: DataFrame, dictionary: DataFrame, fahrenheit_items=None,
                       policy: str = "warn") -> DataFrame:
    """M9: M1 -> M2/M3 -> M5 -> M7 as one lazy plan."""
    items = FAHRENHEIT_ITEMS if fahrenheit_items is None else fahrenheit_items
    out = bounds_filter(drop_both_null(df), dictionary)
    out = map_feature_name(out, dictionary, policy)
    return convert_unit(out, items)
