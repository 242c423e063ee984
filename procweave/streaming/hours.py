"""Hours that wait for their stragglers: what a stream brings is collected by hour, and an hour is released, once and
whole, when no writer has it open any more.

Folders under one path, all safe to write again: ``collecting/batch=B/hour=H`` (what batch B brought), ``released/hour=H`` (the
whole hour) and ``marks/hour=H`` (written last: the hour is out). A batch that is done again replaces its own collection;
an hour without a mark is released again over what an interrupted release has left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import report

Hours = Callable[[SparkSession], DataFrame]


def open_hours(writers: DataFrame) -> DataFrame:
    """Hours that a writer has open, from a log (writer, recording_start, closed): the last word on each file counts if the log
    has a column ``seq``; else a file is open until any row says that it is closed."""
    files = writers.groupBy("writer", "recording_start")
    closed = F.max_by("closed", "seq") if "seq" in writers.columns else F.bool_or("closed")
    return files.agg(closed.alias("closed")).where(~F.col("closed")).select(F.date_trunc("hour", "recording_start").alias("hour")).distinct()


def hour_of(rows: DataFrame) -> DataFrame:
    """Rows with ``hour`` (yyyyMMddHH, UTC) of their record time."""
    return rows.withColumn("hour", F.date_format(F.timestamp_seconds("recTime"), "yyyyMMddHH"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # nothing is there yet


def collected(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return _read(spark, f"{path}/collecting", f"{schema}, batch long, hour string")


def marks(spark: SparkSession, path: str) -> DataFrame:
    """Released hours and the last batch that each holds."""
    return _read(spark, f"{path}/marks", "upto long, hour string")


def released(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of hours that are out; without a mark an hour's folder does not count."""
    return _read(spark, f"{path}/released", f"{schema}, hour string").join(marks(spark, path).select("hour"), "hour", "left_semi")


def stragglers(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows that came after their hour was out. They stay collected and change no released hour."""
    late = collected(spark, path, schema).join(marks(spark, path), "hour").where(F.col("batch") > F.col("upto"))
    return late.drop("upto")


def release(spark: SparkSession, path: str, schema: str, batch: int, is_open: Hours) -> int:
    """Release all collected hours that are neither out nor open; returns how many. One hour per row comes here."""
    held = collected(spark, path, schema).select("hour").distinct().join(marks(spark, path), "hour", "left_anti")
    free = report.closed_hours(held, is_open(spark).select(F.date_format("hour", "yyyyMMddHH").alias("hour")))
    names = [r["hour"] for r in free.collect()]
    if names:
        whole = collected(spark, path, schema).where(F.col("hour").isin(names)).drop("batch")
        whole.repartition("hour", F.pmod(F.xxhash64(*[c for c in whole.columns if c != "hour"]), F.lit(16))).write.partitionBy("hour").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{path}/released")
        done = spark.createDataFrame([(batch, h) for h in names], "upto long, hour string")
        done.coalesce(1).write.partitionBy("hour").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{path}/marks")
    return len(names)


def release_closed(stream: DataFrame, path: str, checkpoint: str, is_open: Hours) -> StreamingQuery:
    """Collect a stream of records and, after each batch, release what ``is_open`` no longer holds back; returns the query,
    which ends when the input does. Hours still open then are released by a later run or by ``release``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)

    def work(rows: DataFrame, batch: int) -> None:
        hour_of(rows).write.partitionBy("hour").mode("overwrite").parquet(f"{path}/collecting/batch={batch}")
        release(rows.sparkSession, path, schema, batch, is_open)

    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
