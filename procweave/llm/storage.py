"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a local master without one (tests) gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not (spark.sparkContext.master + "[").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir().rstrip("/")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The table, written as Parquet and read again, and its path."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete tables of earlier steps, and the shuffle files of plans that no one holds any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    jvm.System.gc()
