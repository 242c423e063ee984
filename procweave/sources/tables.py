"""Reading record tables, job files and choosing files by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import JOBS_4, JOBS_9, JOBS_12

_JOBS = {4: (",", JOBS_4), 12: (":", JOBS_12), 9: (",", JOBS_9)}


def raw(spark: SparkSession, path: str, start: int, end: int, hosts: Sequence[str] = ()) -> DataFrame:
    """Records of a time range and, if given, some hosts; both reach the Parquet scan."""
    rows = spark.read.parquet(path).where(F.col("recTime").between(start, end))
    return rows.where(F.col("host").isin(*hosts)) if hosts else rows


def jobs(spark: SparkSession, path: str, columns: int) -> DataFrame:
    """Job accounting of 4 (comma), 12 (colon) or 9 (comma) columns, texts trimmed."""
    sep, schema = _JOBS[columns]
    rows = spark.read.csv(path, sep=sep, schema=schema, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return rows


def intervals(files: DataFrame) -> DataFrame:
    """Files (path, recording_start) with ``recording_stop``: a second before the next one starts, an hour after the start for
    the last one. The catalogue has a row per file, so one sorted pass is small."""
    following = F.lead("recording_start").over(Window.orderBy("recording_start", "path"))
    return files.withColumn("recording_stop", F.coalesce(following - F.expr("INTERVAL 1 SECOND"), F.col("recording_start") + F.expr("INTERVAL 1 HOUR")))


def overlapping(files: DataFrame, start, end) -> DataFrame:
    """Files that overlap [start, end]; see ``intervals``."""
    return intervals(files).where((F.col("recording_start") <= end) & (F.col("recording_stop") >= start))


def by_date_in_name(paths: DataFrame, pattern: str, first: str, last: str, fmt: str = "yyyyMMdd") -> DataFrame:
    """Paths whose name holds, in the pattern's first group, a date of the range."""
    day = F.to_date(F.nullif(F.regexp_extract("path", pattern, 1), F.lit("")), fmt)
    return paths.withColumn("day", day).where(F.col("day").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))


def process_log(spark: SparkSession, path: str, columns: Sequence[str], fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Older logs: one line per process, the timestamp first."""
    rows = spark.read.csv(path, schema=", ".join(f"`{c}` string" for c in columns))
    return rows.withColumn(columns[0], F.try_to_timestamp(F.col(columns[0]), F.lit(fmt)))
