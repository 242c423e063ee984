"""The folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def ensure_checkpoints(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; a local master without one gets a folder of its own."""
    if spark.sparkContext.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not (spark.sparkContext.master + "[").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp"))


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that the driver and all executors share."""
    ensure_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"
