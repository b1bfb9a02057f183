"""Places that the driver and all executors share, and tables kept there to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one of this machine is set where a local session has none, as in tests.

    A cluster without such a folder is an error: executors would each write to a disk of their own.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it again: later steps neither recompute it nor depend on an executor's disk."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()  # Spark deletes shuffle files that nothing refers to any more when the driver collects garbage
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes tables that materialize() wrote, once nothing will read them."""
    for df in tables:
        remove(df.sparkSession, df._written_to)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path in any file system that Spark knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path in any file system that Spark knows."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
