"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (timestamps are NTZ end to
# end), adaptive execution for runtime re-planning of joins and skew, and
# Arrow for the few pandas hand-offs.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "stayframe", extra: dict | None = None) -> SparkSession:
    """Return the active session or build a local one for tests and benches.

    On a cluster the session already exists (spark-submit) and is returned
    as is; only the local builder sets a master and a scratch checkpoint dir.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set a scratch one
    only when nothing is configured (local tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.startswith("local")
    if configured and configured.startswith("file:") and not local:
        raise RuntimeError(f"spark.checkpoint.dir is {configured}: a cluster needs a folder that all executors share")
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not local:
        # a machine-local folder would vanish with its executor
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for cluster runs")
    scratch = tempfile.mkdtemp(prefix="stayframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", scratch)
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def checkpoint_dir(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``, with its file system
    named in full; removed when the application ends."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(path)
    return fs.makeQualified(path).toString()


def stage(df, name: str):
    """Cut the lineage of a large frame through Parquet in the shared folder:
    compressed, where ``materialize`` writes rows as they lie in memory."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of numbers that a packed partition holds.
PACKED_BYTES = 16 << 20


def packed_partitions(cells: int) -> int:
    """Partitions for a frame of ``cells`` numbers: what its size asks for."""
    return max(1, -(-8 * cells // PACKED_BYTES))


def stage_packed(df, name: str, width: int):
    """``stage`` for a frame of ``width`` numbers a row that is read many
    times: its reads get a task for each 16 MB, not one for each shuffle
    partition or file that it was written from."""
    out = stage(df, name)
    return out.coalesce(packed_partitions(out.count() * width))


def materialize(df):
    """Cut the lineage with a reliable checkpoint under
    ``spark.checkpoint.dir`` (survives executor loss; never a local
    checkpoint). The frame is persisted first so the checkpoint write reads
    the cached partitions instead of recomputing the plan a second time;
    the cache is dropped once the checkpoint exists."""
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def recommended_conf(shuffle_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Partition sizing for a cluster run: about 128 MB per shuffle
    partition (AQE coalesces the small ones and splits skewed ones), never
    fewer than two tasks per core; input splits of the same size."""
    parts = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
