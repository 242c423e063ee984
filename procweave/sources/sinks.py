"""Writing record tables, reports and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import PROCESS, TIME
from .shared import ensure_checkpoints

#: Files at most that one part of a table is dealt to.
FILES = 64


def by_hour(rows: DataFrame, hosts: int = 0) -> DataFrame:
    """Rows with the parts of the hourly tables: date (yyyyMMdd) and hour, and the number of their host's group if there are any."""
    at = F.timestamp_seconds("recTime")
    parts = {"date": F.date_format(at, "yyyyMMdd"), "hour": F.hour(at)}
    return rows.withColumns(parts | ({"hosts": host_group(F.col("host"), hosts)} if hosts else {}))


def host_group(host: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(host), F.lit(groups)).cast("int")


def hourly(rows: DataFrame, path: str, *, hosts: int = 0, most: int = 10_000_000) -> None:
    """Parquet by date and hour, sorted by process within files; a file turns over after ``most`` rows. ``hosts``: also by that many
    groups of hosts, for readers that want few of them."""
    parts = ["date", "hour", *(["hosts"] if hosts else [])]
    dealt = by_hour(rows, hosts).repartition(*parts, F.pmod(F.xxhash64("host"), F.lit(FILES)))
    dealt.sortWithinPartitions(*parts, *PROCESS, *TIME).write.option("maxRecordsPerFile", most).partitionBy(*parts).mode("append").parquet(path)


def good_and_bad(rows: DataFrame, code: Column, good: str, bad: str) -> None:
    """Good rows, and rejected ones with the check that they failed; the rows are computed once and kept, on disk where
    memory lacks, for both writes."""
    coded = rows.withColumn("bad_code", code).persist(StorageLevel.MEMORY_AND_DISK)
    coded.where("bad_code = 0").drop("bad_code").write.parquet(good)
    coded.where("bad_code > 0").write.parquet(bad)
    coded.unpersist()


def summaries(tables: Mapping[str, DataFrame], path: str) -> None:
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}")


def in_parts(rows: DataFrame, path: str, most: int = 500_000) -> None:
    rows.write.option("maxRecordsPerFile", most).mode("overwrite").parquet(path)


def whole_texts(rows: DataFrame) -> DataFrame:
    """Rows without broken texts (a replacement character in any of them)."""
    for c in [c for c, t in rows.dtypes if t == "string"]:
        rows = rows.where(F.col(c).isNull() | ~F.contains(c, F.lit("\ufffd")))
    return rows


def deposit(rows: DataFrame, path: str, part: Sequence[str] = ("date", "type")) -> DataFrame:
    """Daily deposit: of each part in the rows the number of rows is compared with what is stored, and only parts that differ
    are written, in place of the stored ones. Spark stages these and swaps them in when all are complete, so a run that
    is lost leaves the old parts, and one that is done again writes nothing. Rows with broken texts are left out; stored parts
    that the rows lack stay. An empty text as part is stored as null, and null is a part like others. Returns part, stored,
    new and action (``written``, ``equal`` or ``kept``), as found before."""
    spark, part = rows.sparkSession, list(part)
    good = whole_texts(rows)
    good = good.withColumns({c: F.nullif(F.col(c), F.lit("")) for c, t in good.dtypes if c in part and t == "string"})
    new = good.groupBy(*[F.col(c).alias(f"__{c}") for c in part]).agg(F.count("*").alias("new"))
    try:
        there = spark.read.schema(good.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        there = spark.createDataFrame([], good.schema)
    stored = there.groupBy(*part).agg(F.count("*").alias("stored"))
    n = lambda c: F.coalesce(c, F.lit(0))
    action = F.when(F.col("new").isNull(), "kept").when(n("stored") == F.col("new"), "equal").otherwise("written")
    ensure_checkpoints(spark)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in part]
    either = [F.when(F.col("stored").isNull(), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in part]
    found = stored.join(new, same, "full_outer").select(*either, n("stored").alias("stored"), n("new").alias("new"), action.alias("action")).checkpoint()
    differing = found.where("action = 'written'").select(*[F.col(c).alias(f"__{c}") for c in part])
    if not differing.isEmpty():
        changed = good.join(differing, same, "left_semi")
        changed.repartition(*part, F.pmod(F.xxhash64(*[c for c in rows.columns if c not in part]), F.lit(FILES))).write.partitionBy(*part).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    return found


def daily(rows: DataFrame, path: str) -> None:
    """Only the (date, type) parts present in the rows are replaced, equal or not; see ``deposit``."""
    whole_texts(rows).write.partitionBy("date", "type").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def delimited(queries: Mapping[str, DataFrame], path: str, sep: str = ",") -> None:
    for name, rows in queries.items():
        rows.write.csv(f"{path}/{name}", header=True, sep=sep, mode="overwrite")


def json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def sorted_by_process(rows: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Canonical order inside each partition: job, start, pid, then ``more``, then time."""
    return rows.sortWithinPartitions("identifier", "subidentifier", "startTime", "pid", *more, *TIME)
