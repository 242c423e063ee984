"""Queries of the live views: record tables are written to the shared folder in slices of time whose borders are blurred, so
that rows come in other batches than their times say; a stream reads them slice by slice, runs to its end and its output is
read back. The SQL gives the same rows from the tables at rest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean
from ..schemas import PROCESS, TIME
from ..sources import messages, shared
from ..streaming import hours, live
from . import fixtures as fx

#: Slices of a feed, the seconds by which a row may come late, and files of a slice.
SLICES, BLUR, FILES = 4, 86_400, 2
#: Time between a row and the newest one before it, at most: a slice of a month and the blur.
LATE = f"{BLUR * 12} seconds"
_FAR = 10 * 365 * 86_400
#: Records in a file of messages, about, and files of such a batch, at most: what a batch holds does not grow with the table.
RECORDS, BATCH = 125_000, 16
#: Rows in a file of a feed's slice, at most, about.
ROWS = 500_000


def feed(spark: SparkSession, rows: DataFrame, name: str, close_after: int | None = _FAR) -> DataFrame:
    """A stream of the rows in slices, and in the end one more like the newest but without a host, ``close_after`` seconds behind the newest, that
    moves the watermark past all others (if not null)."""
    path, all_rows = shared.new_folder(spark, name), shared.new_folder(spark, f"{name}-rows")
    rows.write.parquet(all_rows)  # made once, since they are read for the ends, each slice and the last row
    rows = spark.read.schema(rows.schema).parquet(all_rows)
    ends = rows.agg(F.min("recTime").alias("first"), F.max("recTime").alias("last"), F.count("*").alias("n")).first()
    files = max(FILES, -(-ends["n"] // (SLICES * ROWS)))
    first, width = ends["first"] or 0, max(((ends["last"] or 0) - (ends["first"] or 0)) // SLICES + 1, 1)
    blurred = F.col("recTime") - first + F.pmod(F.xxhash64(*rows.columns), F.lit(BLUR))
    table = rows.withColumn("__slice", F.least(F.floor(blurred / width), F.lit(SLICES - 1)))
    for i in range(SLICES):
        table.where(F.col("__slice") == i).drop("__slice").repartition(files).write.mode("append").parquet(path)
    if close_after is not None:
        newest = rows.orderBy(F.desc("recTime")).limit(1)
        newest.withColumns({"host": F.lit(""), "recTime": F.col("recTime") + close_after}).select(*rows.columns).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def finished(stream: DataFrame, name: str) -> DataFrame:
    """The stream's output, after it has run to the end of its input; the row that closes the feed is left out."""
    spark, path = stream.sparkSession, shared.new_folder(stream.sparkSession, name)
    out = stream.where("host != ''") if "host" in stream.columns else stream
    out.writeStream.format("parquet").option("path", path).option("checkpointLocation", shared.new_folder(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = fx.SQL + sql
        return f

    return register


def _coarse(spark, d) -> DataFrame:
    """Samples whose counters move in large steps, so that many equal the one before."""
    rows = fx.procstat(spark, d)
    steps = [F.floor(F.col(c) / n).cast("long").alias(c) for c, n in (("utime", 20_000), ("stime", 2000), ("io_rchar", 4_000_000), ("io_wchar", 4_000_000))]
    return rows.select("event_id", "host", "pid", "ppid", *TIME, "startTime", "state", "realUid", *steps)


_COARSE = "SELECT event_id, host, pid, recTime, recTimeUSec, startTime, state, realUid, ppid, CAST(floor(utime / 20000.0) AS BIGINT) AS utime, stime // 2000 AS stime, io_rchar // 4000000 AS io_rchar, io_wchar // 4000000 AS io_wchar FROM procstat"
_FIELDS = "(ppid, state, realUid, utime, stime, io_rchar, io_wchar, startTime)"
_KEPT = f"SELECT event_id, host, pid, recTime, state, utime FROM (SELECT *, lead({_FIELDS}) OVER w AS later, lead(1) OVER w AS has FROM ({_COARSE}) WINDOW w AS (PARTITION BY host, pid{{hour}} ORDER BY recTime, recTimeUSec, event_id)) WHERE has IS NULL OR later IS DISTINCT FROM {_FIELDS}"


@query(_KEPT.format(hour=", recTime // 86400"))
def str2_collapse_stream(spark, d):
    """Here state starts anew each day, since a process of the table has few samples in an hour."""
    rows = _coarse(spark, d)
    out = live.collapse(feed(spark, rows, "str2"), ("host", "pid"), clean.compared("procstat", rows.columns), reset=86_400, late=LATE)
    return finished(out, "str2").select("event_id", "host", "pid", "recTime", "state", "utime")


_FD_ROWS = "SELECT host, pid, fd, recTime, min(startTime) AS startTime, min(mode) AS mode, min(regexp_replace(path, '[0-9]', '', 'g')) AS path FROM procfd WHERE fd BETWEEN 3 AND 7 GROUP BY host, pid, fd, recTime"


@query(f"""SELECT host, pid, fd, recTime, path FROM (SELECT *, lead((startTime, path, mode)) OVER w AS later, lead(1) OVER w AS has FROM ({_FD_ROWS}) WINDOW w AS (PARTITION BY host, pid, fd, recTime // 3600 ORDER BY recTime))
  WHERE has IS NULL OR later IS DISTINCT FROM (startTime, path, mode)""")
def str2_collapse_descriptors(spark, d):
    rows = fx.procfd(spark, d).groupBy("host", "pid", "fd", "recTime").agg(F.min("startTime").alias("startTime"), F.min("mode").alias("mode"), F.min(F.regexp_replace("path", "[0-9]", "")).alias("path"))
    # limited before the feed too, so that the row that closes it is one that the collapse does not leave out
    return finished(live.collapse_descriptors(feed(spark, clean.limit_fds(rows, 5), "str2_fd"), most=5, late=LATE), "str2_fd").select("host", "pid", "fd", "recTime", "path")


_RATES = ("utime", "stime", "io_rchar", "io_wchar", "m_size", "m_resident", "numThreads")


@query(f"""SELECT host, startTime, pid, recTime, recTimeUSec, {", ".join(f"round(({c} - lag({c}) OVER w) / gap, 6) AS {c}_rate" for c in _RATES)} FROM (
  SELECT *, recTime + recTimeUSec / 1e6 - lag(recTime + recTimeUSec / 1e6) OVER w AS gap FROM (SELECT *, row_number() OVER (PARTITION BY host, startTime, pid, recTime, recTimeUSec ORDER BY event_id) AS copy FROM procstat) WHERE copy = 1
  WINDOW w AS (PARTITION BY host, startTime, pid ORDER BY recTime, recTimeUSec)) WINDOW w AS (PARTITION BY host, startTime, pid ORDER BY recTime, recTimeUSec) QUALIFY gap <= 200000""")
def str3_rates_stream(spark, d):
    rows = fx.procstat(spark, d).select("event_id", *PROCESS, *TIME, *_RATES)
    out = finished(live.rates(feed(spark, rows, "str3"), PROCESS, _RATES, silence=200_000, late=LATE), "str3")
    return out.select(*PROCESS, *TIME, *[F.round(f"{c}_rate", 6).alias(f"{c}_rate") for c in _RATES])


_JOB = ("host", "identifier", "subidentifier")


@query("""SELECT host, identifier, subidentifier, pid, startTime, recTime, event_id, utime, state FROM (
  SELECT *, max(hour) OVER (PARTITION BY host, identifier, subidentifier) AS newest, max(hour) OVER () AS now, row_number() OVER (PARTITION BY host, identifier, subidentifier, pid, startTime, hour ORDER BY recTimeUSec DESC, event_id DESC) AS k
  FROM (SELECT * EXCLUDE (recTime), recTime // 3600 * 3600 AS hour, recTime // 3600 * 3600 AS recTime FROM procstat)) WHERE hour = newest AND k = 1 AND newest >= now - 7200""")
def str4_live_cache(spark, d):
    """Batches of an hour; jobs that are silent for more than two hours have left the view."""
    rows = fx.procstat(spark, d).withColumn("recTime", F.floor(F.col("recTime") / 3600) * 3600).select("event_id", *_JOB, "pid", "startTime", *TIME, "utime", "state")
    updates = live.cache(feed(spark, rows, "str4", BLUR * 12), counters=("utime",), state="state", timeout=7200, late=LATE)
    path = shared.new_folder(spark, "str4")
    live.keep_updates(updates.where("host != ''"), path, shared.new_folder(spark, "progress")).awaitTermination()
    kept = spark.read.schema(updates.schema.add("batch", "long")).option("basePath", path).parquet(path)
    return live.view(kept).select(*_JOB, "pid", "startTime", "recTime", "event_id", "utime", "state")


@query("SELECT host, pid, startTime, max(recTime) AS recTime, arg_max(event_id, (recTime, recTimeUSec, event_id)) AS event_id FROM procstat GROUP BY host, pid, startTime")
def str5_fresh_records(spark, d):
    rows = fx.procstat(spark, d).select("event_id", *PROCESS, *TIME)
    out = finished(live.fresh(feed(spark, rows, "str5", None), most_age=BLUR * 12), "str5")
    return out.groupBy("host", "pid", "startTime").agg(F.max("recTime").alias("recTime"), F.max_by("event_id", F.struct(*TIME, "event_id")).alias("event_id"))


@query("""SELECT s.host, s.pid, s.startTime, s.recTime, s.event_id, s.utime, d.exePath FROM (SELECT *, row_number() OVER (PARTITION BY host, pid, startTime, recTime ORDER BY recTimeUSec DESC, event_id DESC) AS k FROM procstat) s
  JOIN (SELECT *, row_number() OVER (PARTITION BY host, pid, startTime, recTime ORDER BY recTimeUSec DESC, event_id DESC) AS k FROM procdata WHERE exePath != 'Unknown') d USING (host, pid, startTime, recTime) WHERE s.k = 1 AND d.k = 1""")
def jn15_newest_with_newest(spark, d):
    data = fx.procdata(spark, d).where("exePath != 'Unknown'").select("event_id", *PROCESS, *TIME, "exePath", "cmdArgs")
    stat = fx.procstat(spark, d).select("event_id", *PROCESS, *TIME, "utime")
    both = live.join_identity(feed(spark, stat, "jn15_stat"), feed(spark, data, "jn15_data"), late=LATE)
    return finished(both, "jn15").select(*PROCESS, "recTime", "event_id", "utime", "exePath")


@query("SELECT strftime(make_timestamp(recTime * 1000000), '%Y%m%d') AS date, CAST(recTime // 3600 % 24 AS INT) AS hour, host, count(*) AS n, CAST(sum(utime) AS BIGINT) AS utime FROM procstat GROUP BY ALL")
def str1_messages_to_hours(spark, d):
    from .catalog import _wide_stat

    path, out = shared.new_folder(spark, "messages"), shared.new_folder(spark, "hours")
    topics = messages.render(_wide_stat(spark, d), "procstat")
    files = max(2 * FILES, fx.table(spark, d, "events").count() // RECORDS + 1)
    topics.repartition(files).write.parquet(path)
    stream = spark.readStream.schema(topics.schema).option("maxFilesPerTrigger", min(-(-files // 2), BATCH)).parquet(path)
    live.ingest_messages(stream, "procstat", out, shared.new_folder(spark, "progress")).awaitTermination()
    rows = spark.read.option("basePath", out).parquet(out)
    return rows.groupBy(F.col("date").cast("string").alias("date"), "hour", "host").agg(F.count("*").alias("n"), F.sum("utime").alias("utime"))


@query("SELECT strftime(make_timestamp(recTime * 1000000), '%Y%m%d%H') AS hour, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM procstat WHERE strftime(make_timestamp(recTime * 1000000), '%Y%m%d%H') NOT IN (SELECT path FROM hours WHERE n_writes % 4 = 1) GROUP BY ALL")
def str7_released_hours(spark, d):
    """Writers keep an hour open for as long as its rows may still come; some never close theirs, and those hours wait."""
    rows = fx.procstat(spark, d).select("event_id", *PROCESS, *TIME)
    schema, path = ", ".join(f"{n} {t}" for n, t in rows.dtypes), shared.new_folder(spark, "str7")
    never = fx.hours(spark, d).where("n_writes % 4 = 1").select(F.col("recording_start").alias("hour"))

    def is_open(session):
        so_far = hours.collected(session, path, schema)
        newest = so_far.agg(F.max("recTime").alias("newest")).first()["newest"] or 0
        writing = so_far.where(F.col("recTime") >= newest - 2 * BLUR).select(F.date_trunc("hour", F.timestamp_seconds("recTime")).cast("timestamp_ntz").alias("hour"))
        return never.unionByName(writing)

    hours.release_closed(feed(spark, rows, "str7", None), path, shared.new_folder(spark, "progress"), is_open).awaitTermination()
    hours.release(spark, path, schema, SLICES, lambda session: never)
    return hours.released(spark, path, schema).groupBy("hour").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("SELECT host, identifier, count(*) AS n FROM procstat WHERE host LIKE 'h%' AND identifier LIKE '%3' GROUP BY ALL")
def str8_by_topic(spark, d):
    return live.by_topic(fx.procstat(spark, d), host="h*", identifier="*3").groupBy("host", "identifier").agg(F.count("*").alias("n"))
