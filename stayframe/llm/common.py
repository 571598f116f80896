"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.session import checkpoint_dir

#: A word is a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def quoted(name: str) -> str:
    """A column's name as Spark reads it back, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def text_of(name: str = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder, with its
    file system named in full; removed when the application ends."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(path)
    return fs.makeQualified(path).toString()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it back: cuts
    the lineage, and a lost executor costs no recomputation."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete a staged frame that nothing reads any more."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def trim() -> None:
    """Give a Python worker's freed memory back; workers live on and serve
    later stages beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    ctypes.CDLL(None).malloc_trim(0)


def frugal(run):
    """A mapInArrow function that trims its worker when a partition ends."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped
