"""Sources and sinks (S1-S10). Typed scans, dictionaries, stage I/O."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, base_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Column-pruned parquet read of one source table."""
    df = spark.read.parquet(os.path.join(base_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def conform(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename source columns onto the library's names ({source: target})."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])


def scan_typed(df: DataFrame, schema: dict[str, tuple[str, str]]) -> DataFrame:
    """Typed projection {target: (source column, spark type)}. Uses
    ``try_cast`` so malformed text becomes null as the reference's coercion
    does; a column already of the target type is passed through untouched so
    parquet filters still push down."""
    types = dict(df.dtypes)
    cols = []
    for target, (source, typ) in schema.items():
        c = F.col(f"`{source}`")
        if types.get(source) != typ:
            c = c.try_cast(typ)
        cols.append(c.alias(target))
    return df.select(*cols)


COHORT_IDS_SCHEMA = T.StructType([T.StructField("subject_id", T.LongType(), True)])


def cohort_ids(spark: SparkSession, path: str) -> DataFrame:
    """Id list CSV (one ``subject_id`` column, header) as a distinct
    DataFrame, never a driver-side list."""
    return (spark.read.schema(COHORT_IDS_SCHEMA).option("header", True).csv(path)
            .where(F.col("subject_id").isNotNull()).distinct())


ITEM_DICT_SCHEMA = T.StructType([
    T.StructField("itemid", T.LongType(), True),
    T.StructField("measurement name", T.StringType(), True),
    T.StructField("feature name", T.StringType(), True),
    T.StructField("min", T.DoubleType(), True),
    T.StructField("max", T.DoubleType(), True),
    T.StructField("units", T.StringType(), True),
])


def item_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """S3: item dictionary CSV -> (itemid, feature_name, min_bound,
    max_bound). Raises if a required column is missing."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    require_columns(raw, ["itemid", "feature name"])
    cols = {c.strip(): c for c in raw.columns}
    out = raw.select(
        F.col(f"`{cols['itemid']}`").try_cast("bigint").alias("itemid"),
        F.col(f"`{cols['feature name']}`").alias("feature_name"),
        (F.col(f"`{cols['min']}`").try_cast("double") if "min" in cols else F.lit(None).cast("double")).alias("min_bound"),
        (F.col(f"`{cols['max']}`").try_cast("double") if "max" in cols else F.lit(None).cast("double")).alias("max_bound"),
    )
    return out


def read_stage(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Column-pruned stage read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_stage(df: DataFrame, path: str, overwrite: bool = True,
                partition_by: list[str] | None = None) -> DataFrame:
    """Write a stage as parquet and return the re-read table (cuts the
    lineage, survives executor loss). ``overwrite=False`` reuses an
    existing stage instead of recomputing it."""
    spark = df.sparkSession
    if not overwrite and _exists(spark, path):
        return spark.read.parquet(path)
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")  # left by a write that finished
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Aggregate-size reports (metrics, per-group scores, importances)
    as one CSV/JSON file. Row-size outputs (predictions, split ids) go
    through ``write_stage`` instead."""
    w = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.json(path)


def register_frame(df: DataFrame, name: str) -> DataFrame:
    """Expose a frame to SQL."""
    df.createOrReplaceTempView(name)
    return df


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Schema check before the plan runs."""
    have = {c.strip() for c in df.columns}
    missing = [c for c in columns if c not in have]
    if missing:
        raise ValueError(f"missing required column(s): {missing}")
    return df


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column, value -> count (nulls included), all columns in one
    pass: unpivot to (column, value) then one aggregation."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in columns])).alias("kv")).select("kv.column", "kv.value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
