"""Reports over many axes, pages of them, and set operations between tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import ensure_checkpoints
from .workload import axes

#: The fifteen groupings of the daily report.
_WHAT = ("executable", "script", "command")
GROUPINGS: tuple[tuple[str, ...], ...] = (*[(w,) for w in _WHAT], ("project",), ("user",), ("host",), *[(w, by) for w in _WHAT for by in ("user", "project", "host")])


def daily(processes: DataFrame, groupings: Sequence[Sequence[str]] = GROUPINGS) -> DataFrame:
    """cpu_time, walltime and nobs by every grouping, labelled ``type``."""
    rows = processes.withColumns({"cpu_time": F.col("utime") + F.col("stime"), "walltime": F.col("recTime") - F.col("startTime"), "nobs": F.lit(1)})
    out = axes(rows, groupings, ("cpu_time", "walltime", "nobs"), deal=("user", "host"))
    return out.withColumnRenamed("axis", "type").withColumn("cpu_time", F.col("cpu_time") / 100.0)


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table by host."""
    rows = None
    for kind, t in tables.items():
        part = t.groupBy("host").count().withColumn("kind", F.lit(kind))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("host").pivot("kind", list(tables)).agg(F.sum("count")).fillna(0)


def merge_files(files: DataFrame) -> DataFrame:
    return files.agg(F.min("recording_start").alias("recording_start"), F.max("recording_stop").alias("recording_stop"), F.sum("n_writes").alias("n_writes"), F.array_join(F.array_sort(F.collect_list("path")), ",").alias("sources"))


def names(rows: DataFrame, column: str) -> DataFrame:
    """Distinct names that are not empty, "Any" first."""
    found = rows.where(F.coalesce(F.col(column), F.lit("")) != "").select(F.col(column).alias("name")).distinct().withColumn("place", F.lit(1))
    return rows.sparkSession.range(1).select(F.lit("Any").alias("name"), F.lit(0).alias("place")).unionByName(found)


def kinds_by(rows: DataFrame, key: str, is_exe: Column) -> DataFrame:
    """Executables and scripts by key."""
    return rows.groupBy(key).agg(F.count_if(is_exe).alias("n_exe"), F.count_if(~is_exe).alias("n_script"))


def days_around(rows: DataFrame, day: Column, centre: str, around: int, first: str, last: str, is_exe: Column) -> DataFrame:
    """Executables and scripts by day from ``around`` days before to after a date, within [first, last]; 0 on days without rows."""
    c, lo, hi = (F.to_date(F.lit(x)) for x in (centre, first, last))
    days = rows.sparkSession.range(1).select(F.explode(F.sequence(F.greatest(F.date_sub(c, around), lo), F.least(F.date_add(c, around), hi))).alias("day"))
    counts = kinds_by(rows.withColumn("day", day), "day", is_exe)
    return days.join(counts, "day", "left").fillna(0, ["n_exe", "n_script"])


def page(rows: DataFrame, order: Sequence[tuple[str, bool]], start: int, length: int, tiebreak: Sequence[str]) -> DataFrame:
    """Rows ``start`` to ``start + length`` of a report sorted by (column, descending) pairs."""
    keys = [F.col(c).desc() if down else F.col(c).asc() for c, down in order]
    return rows.orderBy(*keys, *tiebreak).offset(start).limit(length)


def top_per_key(rows: DataFrame, key: str, value: str, k: int, tiebreak: str) -> DataFrame:
    order = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(value), tiebreak))
    return rows.withColumn("place", order).where(F.col("place") <= k)


def replace_or_append(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """New rows in place of old ones of the same key, the others as they are."""
    rest = [c for c in old.columns if c not in key]
    both = old.withColumn("__rank", F.lit(0)).unionByName(new.withColumn("__rank", F.lit(1)))
    return both.groupBy(*key).agg(F.max_by(F.struct(*rest), "__rank").alias("r")).select(*key, "r.*")


def add_fill(one: DataFrame, two: DataFrame, key: Sequence[str]) -> DataFrame:
    """Sums by key over both tables; a key or value that one lacks counts as 0."""
    rest = [c for c in one.columns if c not in key]
    return one.unionByName(two, allowMissingColumns=True).groupBy(*key).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in rest])


def adhoc(rows: DataFrame, declare: Sequence[tuple[str, str]], where: str, select: Sequence[tuple[str, str]]) -> DataFrame:
    """A query in expressions: named columns first, then a condition (which must be boolean), then ``(label, expression)``."""
    for name, expression in declare:
        rows = rows.withColumn(name, F.expr(expression))
    if rows.select(F.expr(where).alias("w")).schema["w"].dataType.typeName() != "boolean":
        raise ValueError(f"not a condition: {where}")
    return rows.where(where).select(*[F.expr(e).alias(label) for label, e in select])


def numbered(rows: DataFrame, order: Sequence[str | Column], name: str = "place") -> DataFrame:
    """Rows with their gapless number from 1 in an order that should be total. They are sorted by ranges and kept at that (a
    checkpoint), so numbers need only the sizes of the partitions, one row each."""
    ensure_checkpoints(rows.sparkSession)
    kept = rows.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("__at", 33)
    sizes = sorted((r["part"], r["count"]) for r in kept.groupBy(part.alias("part")).count().collect())
    starts, at = [], 1
    for number, size in sizes:
        starts.append((number, at))
        at += size
    first = rows.sparkSession.createDataFrame(starts, "__part long, __start long")
    return kept.withColumn("__part", part).join(first, "__part").withColumn(name, F.col("__start") + F.col("__at").bitwiseAND((1 << 33) - 1)).drop("__part", "__start", "__at")


#: Sort keys of the live view and the columns that they mean.
LIVE_KEYS = {
    "duration": "duration", "vmem": "vsize", "rss": "rss", "host": "host", "user": "user", "cpu": "cpu_rate", "mpi_rank": "mpi_rank", "pid": "pid", "ppid": "ppid", "threads": "numThreads", "io_read": "io_rchar", "io_write": "io_wchar", "age": "age",
}


def ranking(rows: DataFrame, key: str, n: int, ascending: bool = False, ties: Sequence[str] = ("host", "startTime", "pid")) -> DataFrame:
    """The first ``n`` rows of the live view by one of its keys (see ``LIVE_KEYS``) with their ``rank``; rows without a value come
    last either way. Each task keeps its best ``n``, so no more than that is sorted in one place."""
    if key not in LIVE_KEYS:
        raise ValueError(f"not a key of the view: {key}; keys are {', '.join(LIVE_KEYS)}")
    value = F.col(LIVE_KEYS[key])
    best = rows.orderBy(value.asc_nulls_last() if ascending else value.desc_nulls_last(), *ties).limit(n)
    w = Window.orderBy(value.asc_nulls_last() if ascending else value.desc_nulls_last(), *ties)  # over n rows
    return best.withColumn("rank", F.row_number().over(w))


def wrong_host(rows: DataFrame, host: str, expected: str) -> DataFrame:
    return rows.where(F.col(host) != F.col(expected)).groupBy(expected).agg(F.count("*").alias("n"))


def closed_hours(hours: DataFrame, open_hours: DataFrame) -> DataFrame:
    """Hours that no writer holds open."""
    return hours.join(open_hours, "hour", "left_anti")


def resolve_sockets(procfd: DataFrame, netstat: DataFrame) -> DataFrame:
    """``socket:[inode]`` paths as ``tcp:local:port:remote:port`` where the socket table of the host knows the inode."""
    from ..functions.text import ipv4

    known = netstat.select("host", F.col("inode").alias("__inode"), F.concat_ws(":", F.when(F.col("type") == 0, "tcp").otherwise("udp"), ipv4(F.col("local_address")), F.col("local_port").cast("string"), ipv4(F.col("remote_address")), F.col("remote_port").cast("string")).alias("__path"))
    inode = F.regexp_extract("path", r"^socket:\[([0-9]+)\]$", 1).try_cast("bigint")
    rows = procfd.withColumn("__inode", inode)
    return rows.join(known, ["host", "__inode"], "left").withColumn("path", F.coalesce("__path", "path")).drop("__inode", "__path")
