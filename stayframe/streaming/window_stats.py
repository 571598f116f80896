"""Structured Streaming version of X6 + X7 + F5.

The batch reference has no streaming; measurements do arrive continuously
in practice, so the per-(subject, feature, window) statistics are kept as
streaming state: a stream-static join to the episode table, the same
window expression as the batch plan, and mergeable aggregates (count, sum,
sum of squares, min, max, first/last by time). ``update`` mode emits the
changed groups each trigger; the sink upserts them. The watermark drops late
rows only: no grouping key carries event time, so the state keeps one row for
each (subject, feature, window) seen and grows with the subjects, not with
the measurements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stayframe.functions.expressions import hours_between, window_index


def stream_rows(spark: SparkSession, source_dir: str, schema, max_files: int = 1) -> DataFrame:
    """Measurements (subject_id, admission_id, feature_name, charttime,
    valuenum[, row_id]) from parquet files landing in ``source_dir``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source_dir)


def window_stats_stream(rows: DataFrame, cohort: DataFrame, window_hours: float = 12.0, n_windows: int = 4,
                        lateness: str = "1 hour") -> DataFrame:
    c = cohort.select("subject_id", "admission_id", "admittime")
    # watermarks need TIMESTAMP (not NTZ); with the session in UTC the cast
    # keeps the wall-clock value
    timed = rows.withColumn("event_time", F.col("charttime").cast("timestamp"))
    j = timed.withWatermark("event_time", lateness).join(c, ["admission_id", "subject_id"], "inner")
    h = hours_between("admittime", "charttime")
    j = j.where((h >= 0) & (h < window_hours * n_windows) & F.col("feature_name").isNotNull()
                & F.col("valuenum").isNotNull())
    j = j.withColumn("window", window_index("admittime", "charttime", window_hours))
    v = F.col("valuenum")
    order = F.struct(F.col("charttime"), F.col("row_id"))
    return (j.groupBy("subject_id", "feature_name", "window")
            .agg(F.count(v).alias("n"), F.sum(v).alias("sum"), F.sum(v * v).alias("sumsq"),
                 F.min(v).alias("min"), F.max(v).alias("max"),
                 F.min_by(v, order).alias("first"), F.max_by(v, order).alias("last")))


def finish_stats(state: DataFrame) -> DataFrame:
    """Mean and sample std (0 when n = 1) from the mergeable state."""
    n = F.col("n").cast("double")
    mean = F.col("sum") / n
    var = (F.col("sumsq") - n * mean * mean) / (n - 1)
    std = F.when(F.col("n") == 1, F.lit(0.0)).otherwise(F.sqrt(F.greatest(var, F.lit(0.0))))
    return state.select("subject_id", "feature_name", "window", "n", "min", "max", mean.alias("mean"),
                        std.alias("std"), "first", "last")


def start_window_stats(rows: DataFrame, cohort: DataFrame, checkpoint: str, sink=None, query_name: str = "ws",
                       window_hours: float = 12.0, n_windows: int = 4) -> StreamingQuery:
    """Start the incremental query. ``sink(batch_df, batch_id)`` receives
    the updated groups (default: an in-memory table ``query_name`` for
    tests). The checkpoint location makes the query restartable."""
    agg = window_stats_stream(rows, cohort, window_hours, n_windows)
    w = agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if sink is None:
        return w.format("memory").queryName(query_name).start()
    return w.foreachBatch(sink).start()
