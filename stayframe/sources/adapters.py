"""Adapters: the driver's star-schema tables seen as the five abstractions
(subject, episode, measurement, interval, note) plus predictions and
vectors. Derived columns are integer arithmetic on keys so every engine
computes the same values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.sources.io import read_table

EPOCH_1900 = "1900-01-01"


def _days_after(base: str, n) -> F.Column:
    return F.date_add(F.lit(base).cast("date"), n.cast("int")).cast("timestamp_ntz")


def subjects(spark: SparkSession, d: str) -> DataFrame:
    """customer (+ nation, region): subject_id, dob, dod, gender_raw,
    ethnicity_raw, region_raw."""
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    n = read_table(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, d, "region", ["r_regionkey", "r_name"])
    k = F.col("c_custkey")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
            .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey, "left")
            .select(
                k.alias("subject_id"),
                F.when(k % 50 != 0, _days_after(EPOCH_1900, k * 37 % 40000)).alias("dob"),
                F.when(k % 3 == 0, _days_after("1995-01-01", k * 53 % 2500)).alias("dod"),
                F.col("c_mktsegment").alias("gender_raw"),
                F.col("n_name").alias("ethnicity_raw"),
                F.col("r_name").alias("region_raw"),
            ))


def episodes(spark: SparkSession, d: str) -> DataFrame:
    """orders: subject_id, admission_id, admittime, dischtime, expire_flag,
    priority_raw, status_raw."""
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                        "o_orderdate", "o_orderpriority"])
    k = F.col("o_orderkey")
    start = F.timestamp_add("MINUTE", (k % 1440).cast("int"), F.col("o_orderdate"))
    end = F.timestamp_add("HOUR", (k * 7 % 400 - 5).cast("int"), start)
    flag = (F.when((F.col("o_orderstatus") == "F") & (k % 5 == 0), F.lit(1))
            .when(k % 41 == 0, F.lit(None).cast("int")).otherwise(F.lit(0)))
    return o.select(
        F.col("o_custkey").alias("subject_id"),
        k.alias("admission_id"),
        F.when(k % 97 != 0, start).alias("admittime"),
        F.when(k % 89 != 0, end).alias("dischtime"),
        flag.alias("expire_flag"),
        F.col("o_orderpriority").alias("priority_raw"),
        F.col("o_orderstatus").alias("status_raw"),
    )


def measurements(spark: SparkSession, d: str) -> DataFrame:
    """events as measurements: one episode per user."""
    e = read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return e.select(
        F.col("user_id").alias("subject_id"),
        F.col("user_id").alias("admission_id"),
        F.col("event_type").alias("itemid"),
        F.col("event_type").alias("feature_name"),
        F.col("ts").alias("charttime"),
        F.col("value").alias("valuenum"),
        F.col("event_id").alias("row_id"),
    )


def measurement_episodes(spark: SparkSession, d: str) -> DataFrame:
    """Episode start per user = first event time."""
    e = read_table(spark, d, "events", ["user_id", "ts"])
    return (e.groupBy("user_id").agg(F.min("ts").alias("admittime"))
            .select(F.col("user_id").alias("subject_id"), F.col("user_id").alias("admission_id"),
                    "admittime"))


def dirty_measurements(spark: SparkSession, d: str) -> DataFrame:
    """Measurements with the text/number nulls the cleaning operators handle."""
    e = read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    k = F.col("event_id")
    text = (F.when(k % 17 == 0, F.lit(None).cast("string"))
            .when(k % 19 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")))
    return e.select(
        F.col("user_id").alias("subject_id"),
        F.col("user_id").alias("admission_id"),
        F.col("event_type").alias("itemid"),
        F.col("ts").alias("charttime"),
        F.when(k % 13 != 0, F.col("value")).alias("valuenum"),
        text.alias("value"),
        F.lit("u").alias("valueuom"),
        k.alias("row_id"),
    )


# Bounds dictionary for the dirty view (item -> feature, min, max); the
# item ``purchase`` is deliberately absent (no bounds, no mapping).
DIRTY_DICTIONARY = [
    ("error", "Error", 1.0, 150.0),
    ("click", "Click", 1.0, 150.0),
    ("view", "TempF", 5.0, 120.0),
    ("signup", "Signup", 0.0, 200.0),
]


def dirty_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DIRTY_DICTIONARY,
                                 "itemid string, feature_name string, min_bound double, max_bound double")


def intervals(spark: SparkSession, d: str) -> DataFrame:
    """lineitem x part as interval orders."""
    li = read_table(spark, d, "lineitem", ["l_partkey", "l_suppkey", "l_quantity",
                                           "l_returnflag", "l_shipdate", "l_linenumber", "l_orderkey"])
    p = read_table(spark, d, "part", ["p_partkey", "p_name"])
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    return j.select(
        F.col("l_suppkey").alias("subject_id"),
        F.col("l_suppkey").alias("admission_id"),
        F.col("l_shipdate").alias("startdate"),
        F.timestamp_add("DAY", F.col("l_quantity").cast("int"), F.col("l_shipdate")).alias("enddate"),
        F.col("p_name").alias("drug"),
        F.col("p_name").alias("drug_name_generic"),
        F.col("l_returnflag").alias("route"),
    )


INTERVAL_WINDOW_HOURS = 90 * 24.0


def interval_episodes(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier", ["s_suppkey"])
    return s.select(F.col("s_suppkey").alias("subject_id"), F.col("s_suppkey").alias("admission_id"),
                    _days_after("1998-01-01", F.col("s_suppkey")).alias("admittime"))


def notes(spark: SparkSession, d: str) -> DataFrame:
    """conversations as timed notes with a date fallback and error flag."""
    c = read_table(spark, d, "conversations", ["conv_id", "turn", "role", "text"])
    k = F.col("conv_id") + F.col("turn")
    base = F.lit("2024-01-01").cast("timestamp_ntz")
    return c.select(
        F.col("conv_id").alias("subject_id"),
        F.col("conv_id").alias("admission_id"),
        F.when(k % 11 != 0, F.timestamp_add("HOUR", (F.col("turn") * 7).cast("int"), base)).alias("charttime"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("turn").cast("int")).alias("chartdate"),
        F.col("role").alias("category"),
        F.col("role").alias("description"),
        F.col("text"),
        F.when(k % 13 == 0, F.lit(1)).when(k % 7 == 0, F.lit(None).cast("int")).otherwise(F.lit(0)).alias("iserror"),
        F.col("turn").alias("row_id"),
    )


def note_episodes(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "conversations", ["conv_id"]).distinct()
    return c.select(F.col("conv_id").alias("subject_id"), F.col("conv_id").alias("admission_id"),
                    F.lit("2024-01-01").cast("timestamp_ntz").alias("admittime"),
                    F.lit("2024-01-03").cast("timestamp_ntz").alias("dischtime"))


def document_notes(spark: SparkSession, d: str) -> DataFrame:
    """documents as untimed notes: subject = doc_id % 150."""
    doc = read_table(spark, d, "documents", ["doc_id", "text", "lang", "source"])
    return doc.select(
        (F.col("doc_id") % 150).alias("subject_id"),
        (F.col("doc_id") % 150).alias("admission_id"),
        F.col("source").alias("category"),
        F.col("lang").alias("description"),
        F.col("text"),
        F.col("doc_id").alias("row_id"),
    )


def predictions(spark: SparkSession, d: str, target: str = "quality") -> DataFrame:
    """labels x documents as scored predictions: (id, y_true, y_pred, grp)."""
    lab = read_table(spark, d, "labels", ["doc_id", target])
    doc = read_table(spark, d, "documents", ["doc_id", "n_chars", "lang"])
    return (lab.join(doc, "doc_id", "inner")
            .select(F.col("doc_id").alias("subject_id"),
                    F.col(target).cast("int").alias("y_true"),
                    ((F.col("n_chars") % 1000) / F.lit(1000.0)).alias("y_pred"),
                    F.col("lang").alias("grp")))


def bench_predictions(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"])
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("subject_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"),
        ((F.col("l_partkey") * 31 + F.col("l_linenumber")) % 1000 / F.lit(1000.0)).alias("y_pred"),
        F.col("l_returnflag").alias("grp"))


def vectors(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "embeddings", ["vec_id", "embedding", "label"])
    return e.select(F.col("label").cast("long").alias("subject_id"),
                    F.col("label").cast("long").alias("admission_id"),
                    F.col("vec_id").alias("row_id"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
