"""Batch jobs and users: attaching them to processes, and job reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..sources.shared import ensure_checkpoints
from ..sources.sinks import host_group


def one_per_key(rows: DataFrame, key: Sequence[str], order: str, last: bool = True) -> DataFrame:
    """One row for each key: that of the largest or smallest ``order``."""
    pick = F.max_by if last else F.min_by
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(pick(F.struct(*rest), F.col(order)).alias("r")).select(*key, "r.*")


def attach_project(processes: DataFrame, jobs: DataFrame, *, by_task: bool = True, last: bool = True, unknown: str = "Unknown") -> DataFrame:
    """Project and job user by ``identifier.subidentifier`` or by identifier alone. jobs: job, task, user, project and
    line_no, which says which of several lines for a job wins. Jobs are a dimension; Spark broadcasts them if their
    measured size allows."""
    key = ["job", "task"] if by_task else ["job"]
    one = one_per_key(jobs, key, "line_no", last).select(*[F.col(k).alias(f"__{k}") for k in key], F.col("project"))
    match = F.col("identifier") == F.col("__job")
    if by_task:
        match = match & (F.col("subidentifier") == F.col("__task"))
    return processes.join(one, match, "left").drop(*[f"__{k}" for k in key]).withColumn("project", F.coalesce("project", F.lit(unknown)))


def attach_user(processes: DataFrame, users: DataFrame, uid: str = "realUid", unknown: str | None = None) -> DataFrame:
    """User name by uid (users: uid, name); without one ``unknown``, or the uid as text."""
    names = users.select(F.col("uid").alias("__uid"), F.col("name").alias("user"))
    other = F.col(uid).cast("string") if unknown is None else F.lit(unknown)
    return processes.join(names, F.col(uid) == F.col("__uid"), "left").drop("__uid").withColumn("user", F.coalesce("user", other))


def with_records(jobs: DataFrame, records: DataFrame, slot: int = 21_600) -> DataFrame:
    """Records of each job: same host, identifier and subidentifier, taken between the job's start and end. Both sides
    also meet by time slots of ``slot`` seconds, so jobs that share a name and a host do not meet all records of either."""
    slots = F.explode(F.sequence(F.floor(F.col("start") / slot), F.floor(F.col("end") / slot)))
    j = jobs.where("start <= end").withColumn("__slot", slots).alias("j")
    r = records.withColumn("__slot", F.floor(F.col("recTime") / slot)).alias("r")
    same = (F.col("j.host") == F.col("r.host")) & (F.col("j.job") == F.col("r.identifier")) & (F.col("j.task") == F.col("r.subidentifier")) & (F.col("j.__slot") == F.col("r.__slot"))
    return j.join(r, same & F.col("r.recTime").between(F.col("j.start"), F.col("j.end"))).drop(F.col("j.__slot"), F.col("r.__slot"))


def totals_of_records(jobs: DataFrame, records: DataFrame, by: Sequence[str], maxima: Sequence[str], radix: int = 2) -> DataFrame:
    """How many records the jobs of each ``by`` have (``n``) and the maxima of some of their columns: what grouping
    ``with_records`` gives, without its pairs, whose number grows with jobs times records.

    Time is cut into blocks of ``2 ** (radix * level)`` seconds, the longest that are no longer than a job. A job is then the end of a
    block, at most ``2 ** radix - 1`` whole blocks and the beginning of one; it asks for each of them once, and running totals
    of a block's records in both directions answer. Records are first added up by second."""
    key = ["host", "job", "task"]
    length = F.col("end") - F.col("start") + 1
    level = F.floor(F.log2(length) / radix).cast("int")
    level = level - F.when(F.pow(F.lit(2.0), level * radix) > length, 1).otherwise(0)  # logarithms are not exact
    j = jobs.where("start <= end").withColumn("__level", level).withColumn("__size", F.pow(F.lit(2.0), F.col("__level") * radix).cast("long"))
    block = lambda x: F.floor(x / F.col("__size"))
    a, b = block(F.col("start")), block(F.col("end"))
    levels = [r["__level"] for r in j.select("__level").distinct().collect()]  # at most 32
    ask = lambda at, forward: F.struct(at.cast("long").alias("at"), F.lit(forward).alias("forward"))
    none = F.array().cast("array<struct<at:bigint,forward:boolean>>")
    # a whole block is asked for as its beginning up to its last second
    between = F.when(b - a > 1, F.transform(F.sequence(a + 1, b - 1), lambda x: ask((x + 1) * F.col("__size") - 1, True))).otherwise(none)
    last = F.when(b > a, F.array(ask(F.col("end"), True))).otherwise(none)  # else the job is one block
    asked = F.concat(F.array(ask(F.col("start"), False)), between, last)
    lookups = j.select(*key, *by, "__level", "__size", F.explode(asked).alias("__ask")).select(*key, "__level", block(F.col("__ask.at")).alias("__block"), F.col("__ask.at").alias("__at"), F.col("__ask.forward").alias("__forward"), F.struct(*by).alias("__by"))
    seconds = records.groupBy("host", F.col("identifier").alias("job"), F.col("subidentifier").alias("task"), F.col("recTime").alias("__at")).agg(F.count("*").alias("n"), *[F.max(c).alias(c) for c in maxima])
    sizes = F.array(*[F.struct(F.lit(x).alias("level"), F.lit(1 << (x * radix)).cast("long").alias("size")) for x in levels]) if levels else F.array().cast("array<struct<level:int,size:bigint>>")
    held = seconds.where(" AND ".join(f"{k} IS NOT NULL" for k in (*key, "__at"))).withColumn("__s", F.explode(sizes)).select(*key, F.col("__s.level").alias("__level"), F.floor(F.col("__at") / F.col("__s.size")).alias("__block"), "__at", "n", *maxima)
    parts = []
    for forward in (True, False):
        both = held.unionByName(lookups.where(F.col("__forward") == forward).drop("__forward"), allowMissingColumns=True)
        # records of a second stand before the questions of it
        w = Window.partitionBy(*key, "__level", "__block").orderBy(F.col("__at").asc() if forward else F.col("__at").desc(), F.col("__by").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
        parts.append(both.select("__by", F.sum("n").over(w).alias("n"), *[F.max(c).over(w).alias(c) for c in maxima]).where(F.col("__by").isNotNull() & F.col("n").isNotNull()))
    return parts[0].unionByName(parts[1]).groupBy(*[F.col(f"__by.{c}").alias(c) for c in by]).agg(F.sum("n").alias("n"), *[F.max(c).alias(c) for c in maxima])


def wanted_parts(jobs: DataFrame, files: DataFrame, hosts: int = 0) -> DataFrame:
    """Parts (date, hour and, with ``hosts``, the group of the job's host) of the hourly tables that hold a file (recording_start,
    recording_stop as timestamps) which overlaps a job's interval. Jobs and files meet by the hours that they touch."""
    hour = lambda x: F.floor(x / 3600)
    touched = lambda a, b: F.explode(F.sequence(hour(a), hour(b)))
    j = jobs.where("start <= end").select("host", "start", "end", touched(F.col("start"), F.col("end")).alias("__hour"))
    seconds = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    f = files.select(seconds("recording_start").alias("__start"), seconds("recording_stop").alias("__stop"))
    f = f.withColumn("__hour", touched(F.col("__start"), F.col("__stop")))
    both = j.join(f, "__hour").where((F.col("__start") <= F.col("end")) & (F.col("__stop") >= F.col("start")))
    at = F.timestamp_seconds(F.col("__hour") * 3600)
    group = [host_group(F.col("host"), hosts).alias("hosts")] if hosts else []
    return both.select(F.date_format(at, "yyyyMMdd").alias("date"), F.hour(at).alias("hour"), *group).distinct()


def with_stored_records(jobs: DataFrame, stored: DataFrame, files: DataFrame, *, hosts: int = 0, most: int = 1_000_000, slot: int = 3600) -> DataFrame:
    """``with_records`` of a table that is stored by date and hour (``sinks.hourly``), of which only parts that can matter are read:
    those of ``wanted_parts`` are sent to the scan, which drops all other parts before it opens a file. There are at most as
    many as the table has parts; beyond ``most`` they are not broadcast and the scan is not pruned. ``stored`` must read
    date as text."""
    parts = ["date", "hour", *(["hosts"] if hosts else [])]
    wanted = wanted_parts(jobs, files, hosts)
    ensure_checkpoints(jobs.sparkSession)
    wanted = wanted.checkpoint()
    near = stored.join(F.broadcast(wanted.where("hour >= 0")) if wanted.count() <= most else wanted, parts, "left_semi")
    return with_records(jobs, near.drop(*parts), slot)


def all_jobs(running: DataFrame, finished: DataFrame, start: int, end: int, longest_queue: int) -> DataFrame:
    """Running jobs and those finished in a window widened by a day back and the longest queue time ahead; no task is task 1."""
    window = finished.where((F.col("start") >= start - 86_400) & (F.col("start") <= end + longest_queue))
    return running.unionByName(window, allowMissingColumns=True).withColumn("task", F.greatest(F.col("task"), F.lit(1)))


def totals(processes: DataFrame, job: Sequence[str] = ("identifier",)) -> DataFrame:
    """Per job: earliest start, duration and most threads."""
    return processes.groupBy(*job).agg(F.min("startTime").alias("job_start"), (F.max("recTime") - F.min("startTime")).alias("job_duration"), F.max("numThreads").alias("max_threads"))


def shares(processes: DataFrame, job: Sequence[str] = ("identifier",)) -> DataFrame:
    """Each process with its start and duration as percent of its job's."""
    joined = processes.join(totals(processes, job), list(job))
    part = lambda x: F.try_divide(F.lit(100.0) * x, F.col("job_duration"))
    return joined.withColumns({"start_pct": part(F.col("startTime") - F.col("job_start")), "duration_pct": part(F.col("recTime") - F.col("startTime"))})


def coverage(records: DataFrame, kind: str, by: Sequence[str] = ("identifier", "host"), per_source: str | None = None) -> DataFrame:
    """First and last time, distinct times, distinct processes and largest gap of the records of a kind. Times are made
    distinct before the window, so that only they are sorted. ``per_source``: a column (the file of a record) by which the
    table is covered too, so that a time that two files have counts in both."""
    by = (*by, per_source) if per_source else by
    counts = records.groupBy(*by).agg(F.min("recTime").alias("first_time"), F.max("recTime").alias("last_time"), F.count_distinct("recTime").alias("n_times"), F.count_distinct("pid", "startTime").alias("n_processes"))
    w = Window.partitionBy(*by).orderBy("recTime")
    gaps = records.select(*by, "recTime").distinct().withColumn("gap", F.col("recTime") - F.lag("recTime").over(w)).groupBy(*by).agg(F.coalesce(F.max("gap"), F.lit(0)).alias("largest_gap"))
    return counts.join(gaps, list(by)).withColumn("kind", F.lit(kind))


def peaks(procstat: DataFrame, value: str, job: Sequence[str] = ("identifier",)) -> DataFrame:
    """The largest sum over a job's processes at one time, with that time, and the largest single value with its process."""
    sums = procstat.groupBy(*job, "recTime").agg(F.sum(value).alias("s"))
    # of equal sums the earliest time
    peak = sums.groupBy(*job).agg(F.max("s").alias("peak_sum"), (-F.max_by(-F.col("recTime"), F.struct("s", -F.col("recTime")))).alias("peak_time"))
    single = procstat.groupBy(*job).agg(F.max(F.struct(F.col(value), F.col("pid"), F.col("startTime"))).alias("m")).select(*job, F.col(f"m.{value}").alias("max_value"), F.col("m.pid").alias("max_pid"))
    return peak.join(single, list(job))


def overall_rates(procstat: DataFrame) -> DataFrame:
    """Rates since a process began, for each sample."""
    age = text.seconds(F.col("recTime") - F.col("startTime"), F.col("recTimeUSec"))
    return procstat.withColumns({"cpu_rate": F.try_divide((F.col("utime") + F.col("stime")) / 100.0, age), "io_rate": F.try_divide((F.col("io_rchar") + F.col("io_wchar")).cast("double"), age)})


def rate_from_start(procstat: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rates between samples; before the first stands zero at the start of the process."""
    w = Window.partitionBy(*key).orderBy(*order)
    cpu = F.col("utime") + F.col("stime")
    before = F.coalesce(F.lag("recTime").over(w), F.col("startTime"))
    return procstat.withColumn("cpu_rate", F.try_divide((cpu - F.coalesce(F.lag(cpu).over(w), F.lit(0))) / 100.0, (F.col("recTime") - before).cast("double")))


#: Columns of the three arrays of a process in a job report.
NESTED = {
    "ps": ("recTime", "recTimeUSec", "state", "utime", "stime", "priority", "numThreads", "vsize", "rss", "rsslim", "vmpeak", "rsspeak", "io_rchar", "io_wchar", "io_readBytes", "io_writeBytes", "m_size", "m_resident", "m_share", "m_text", "m_data"),
    "fd": ("recTime", "fd", "path", "mode"),
    "obs": ("recTime", "recTimeUSec"),
}


def nested(samples: DataFrame, files: DataFrame | None = None, observations: DataFrame | None = None, key: Sequence[str] = ("host", "startTime", "pid")) -> DataFrame:
    """One row per process that any of the record tables has, with its samples (``ps``), files (``fd``) and observations (``obs``)
    in arrays in order of time, for JSON output by job. The tables are put together and meet in one shuffle by process; a
    job's processes are rows too, so that no job is gathered in one place. Of the columns in ``NESTED`` those are taken that
    a table has; a process takes the least job that its records name."""
    tables = {name: t for name, t in (("ps", samples), ("fd", files), ("obs", observations)) if t is not None}
    kinds = {name: F.struct(*[c for c in NESTED[name] if c in t.columns]) for name, t in tables.items()}
    types = {name: t.select(kinds[name].alias("s")).schema["s"].dataType for name, t in tables.items()}
    job = ("identifier", "subidentifier")

    def part(name: str, t: DataFrame) -> DataFrame:
        named = [F.col(c) if c in t.columns else F.lit(None).cast("string").alias(c) for c in job]
        return t.select(*key, *named, *[(kinds[n] if n == name else F.lit(None).cast(types[n])).alias(n) for n in tables])

    both = None
    for name, t in tables.items():
        both = part(name, t) if both is None else both.unionByName(part(name, t))
    out = both.groupBy(*key).agg(F.min(F.when(F.col("identifier").isNotNull(), F.struct(*job))).alias("__job"), *[F.sort_array(F.collect_list(n)).alias(n) for n in tables])
    return out.select(F.col("__job.identifier").alias("identifier"), F.col("__job.subidentifier").alias("subidentifier"), *key, *tables)
