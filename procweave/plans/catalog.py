"""All queries of the process-accounting library by name, with DuckDB SQL for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scripts, text
from ..operators import clean, jobs, report, summary, tree, workload
from ..schemas import PROCESS, TIME
from ..sources import messages, tables
from ..streaming import live
from . import fixtures as fx
from . import records, streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
ORDER = (*TIME, "event_id")
#: Seconds that count as now: the middle of the events, so that some are in the future.
NOW = 1_705_000_000
START = 3946 * fx.BUCKET
LABELS = (("projectb", "/global/projectb/.*"), ("project", "(/chos)?/global/project/.*"), ("any_global", ".*/global/.*"))
BINS = {"duration": (0.0, 10_000.0, 50_000.0, 86_400.0), "cpu": (0.0, 1000.0, 5000.0, 10_000.0)}
MEASURES = (workload.Measure("duration", "duration", BINS["duration"]), workload.Measure("cpu", "cpu_net", BINS["cpu"]))


def query(sql: str = ""):
    """Register a function by its name; ``sql`` continues the fixtures' WITH clause."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = fx.SQL + sql
        return f

    return register


def _hist(column: str, name: str, bins) -> str:
    """Histogram columns as SQL."""
    last = len(bins) - 2
    return ", ".join(f"count(*) FILTER (coalesce({column}, 0) >= {a} AND coalesce({column}, 0) {'<=' if i == last else '<'} {b}) AS {name}_{i}" for i, (a, b) in enumerate(zip(bins, bins[1:], strict=False)))


def _flat(df: DataFrame, column: str, n: int, name: str) -> DataFrame:
    """A histogram array as columns."""
    return df.withColumns({f"{name}_{i}": F.get(column, i) for i in range(n)}).drop(column)


# --- the flagship: samples to rates to processes to projects ---


@query("""SELECT coalesce(j.project, 'Unknown') AS project, count(*) AS n_processes, CAST(sum(p.utime + p.stime) AS BIGINT) AS cpu_ticks, round(max(p.cpuMax), 4) AS max_cpu_rate FROM (
  SELECT host, startTime, pid, min(identifier) AS identifier, max(cpuRate) AS cpuMax, arg_max(utime, (recTime, recTimeUSec, event_id)) FILTER (undamaged) AS utime, arg_max(stime, (recTime, recTimeUSec, event_id)) FILTER (undamaged) AS stime FROM rated GROUP BY ALL) p
  LEFT JOIN (SELECT job, arg_max(project, line_no) AS project FROM jobs GROUP BY job) j ON p.identifier = j.job GROUP BY 1""")
def project_cpu(spark, d):
    processes = summary.summarize(fx.procstat(spark, d), order=ORDER)
    named = jobs.attach_project(processes, fx.jobs(spark, d))
    return named.groupBy("project").agg(F.count("*").alias("n_processes"), F.sum(F.col("utime") + F.col("stime")).alias("cpu_ticks"), F.round(F.max("cpuRateMax"), 4).alias("max_cpu_rate"))


# --- 2.1 sources and sinks ---


@query(f"SELECT host, count(*) AS n FROM procstat WHERE recTime BETWEEN {NOW - 864000} AND {NOW} AND host IN ('h1', 'h3') GROUP BY host")
def src1_raw_range(spark, d):
    rows = fx.procstat(spark, d).where(F.col("recTime").between(NOW - 864_000, NOW) & F.col("host").isin("h1", "h3"))
    return rows.groupBy("host").agg(F.count("*").alias("n"))


def _wide_stat(spark, d) -> DataFrame:
    from ..schemas import PROCSTAT_FIELDS

    rows = fx.procstat(spark, d).withColumn("rsslim", F.lit("18446744073709551615").cast("decimal(20,0)"))
    return rows.select("host", "identifier", "subidentifier", *[F.col(n) if n in rows.columns else F.lit(0).cast(t).alias(n) for n, t in PROCSTAT_FIELDS])


@query("SELECT host, pid, recTime, recTimeUSec, utime, stime, io_rchar, CAST(18446744073709551615 AS DECIMAL(20,0)) AS rsslim, state FROM procstat")
def src2_procstat_messages(spark, d):
    return messages.procstat(messages.render(_wide_stat(spark, d), "procstat")).select("host", "pid", "recTime", "recTimeUSec", "utime", "stime", "io_rchar", "rsslim", "state")


@query("SELECT host, pid, recTime, recTimeUSec, cmdArgs, exePath, '/tmp' AS cwdPath FROM procdata")
def src2_procdata_messages(spark, d):
    rows = fx.procdata(spark, d).withColumn("startTimeUSec", F.lit(0).cast("long"))
    return messages.texts(messages.render(rows, "procdata"), "procdata").select("host", "pid", "recTime", "recTimeUSec", "cmdArgs", "exePath", "cwdPath")


@query("SELECT host, pid, fd, mode, path, recTime FROM procfd")
def src2_procfd_messages(spark, d):
    rows = fx.procfd(spark, d).withColumns({"startTimeUSec": F.lit(0).cast("long"), "identifier": F.lit("i"), "subidentifier": F.lit("s")})
    return messages.texts(messages.render(rows, "procfd"), "procfd").select("host", "pid", "fd", "mode", "path", "recTime")


@query("SELECT host, pid, recTime, recTimeUSec, cmdArgs, exePath FROM procdata")
def src3_tagged_lines(spark, d):
    rows = messages.render(fx.procdata(spark, d).withColumn("startTimeUSec", F.lit(0).cast("long")), "procdata")
    lines = rows.select(F.split("topic", "[.]").alias("t"), F.explode(F.filter(F.split("value", "\n"), lambda x: (x != "") & ~x.startswith("nRecords="))).alias("body")).select(F.concat_ws(",", F.lit("procdata"), F.get("t", 0), F.get("t", 1), F.get("t", 2), "body").alias("value"))
    return messages.texts(messages.tagged(lines, "procdata"), "procdata").select("host", "pid", "recTime", "recTimeUSec", "cmdArgs", "exePath")


@query("""SELECT path, recording_start, stop AS recording_stop FROM (SELECT *, coalesce(lead(recording_start) OVER (ORDER BY recording_start, path) - INTERVAL 1 SECOND, recording_start + INTERVAL 1 HOUR) AS stop FROM hours)
  WHERE recording_start <= TIMESTAMP '2024-01-10 12:00:00' AND stop >= TIMESTAMP '2024-01-08 03:30:00'""")
def src5_overlapping_files(spark, d):
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    return tables.overlapping(fx.hours(spark, d), at("2024-01-08 03:30:00"), at("2024-01-10 12:00:00")).select("path", "recording_start", "recording_stop")


@query("SELECT 'sum_' || path || '.h5' AS path, CAST(date_trunc('day', recording_start) AS DATE) AS day FROM hours WHERE recording_start BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-07 23:59:59'")
def src6_files_by_date(spark, d):
    paths = fx.hours(spark, d).select(F.concat(F.lit("sum_"), "path", F.lit(".h5")).alias("path"))
    return tables.by_date_in_name(paths, r"sum_([0-9]{8})[0-9]{2}[.]h5", "2024-01-05", "2024-01-07")


@query(f"SELECT code AS bad_code, count(*) AS n FROM (SELECT CASE WHEN pid < 1 OR pid > 1000000 THEN 1 WHEN ppid > 1000000 THEN 2 WHEN startTime = 0 OR startTime > {NOW} THEN 3 WHEN recTime = 0 OR recTime > {NOW} THEN 4 ELSE 0 END AS code FROM procstat) GROUP BY code")
def snk2_good_and_bad(spark, d):
    return fx.procstat(spark, d).withColumn("bad_code", clean.stat_code(NOW)).groupBy("bad_code").agg(F.count("*").alias("n"))


@query("SELECT identifier, host, startTime, pid, count(*) AS n_samples FROM procstat GROUP BY ALL")
def snk7_nested_samples(spark, d):
    return jobs.nested(fx.procstat(spark, d)).select("identifier", "host", "startTime", "pid", F.size("ps").cast("long").alias("n_samples"))


# --- 2.2 filters and projections ---

_CODE = f"CASE WHEN pid < 1 OR pid > 1000000 THEN 1 WHEN ppid > 1000000 THEN 2 WHEN startTime = 0 OR startTime > {NOW} THEN 3 WHEN recTime = 0 OR recTime > {NOW} THEN 4"


@query(f"SELECT event_id, {_CODE} ELSE 0 END AS bad_code FROM procstat")
def flt1_stat_codes(spark, d):
    return fx.procstat(spark, d).select("event_id", clean.stat_code(NOW).alias("bad_code"))


@query(f"SELECT event_id, {_CODE} WHEN length(exePath) > 1024 THEN 5 WHEN regexp_matches(exePath, '[^\\x00-\\x7F]') THEN 6 ELSE 0 END AS bad_code FROM (SELECT * REPLACE (CASE WHEN event_id % 31 = 0 THEN repeat('a', 1025) WHEN event_id % 37 = 0 THEN 'é' ELSE exePath END AS exePath) FROM procdata)")
def flt2_data_codes(spark, d):
    path = F.when(F.col("event_id") % 31 == 0, F.repeat(F.lit("a"), 1025)).when(F.col("event_id") % 37 == 0, "é").otherwise(F.col("exePath"))
    return fx.procdata(spark, d).withColumn("exePath", path).select("event_id", clean.data_code(NOW).alias("bad_code"))


@query(f"SELECT bad_code, count(*) AS n FROM (SELECT {_CODE} WHEN length(path) > 1024 THEN 5 WHEN regexp_matches(path, '[^\\x00-\\x7F]') THEN 6 WHEN fd * 100000 > 500000 THEN 7 ELSE 0 END AS bad_code FROM procfd) GROUP BY bad_code")
def flt3_fd_codes(spark, d):
    return fx.procfd(spark, d).withColumn("fd", F.col("fd") * 100_000).withColumn("bad_code", clean.fd_code(NOW)).groupBy("bad_code").agg(F.count("*").alias("n"))


@query("SELECT type, count(*) AS n FROM netstat WHERE type IN (0, 1) AND inode != 0 GROUP BY type")
def flt4_good_sockets(spark, d):
    return clean.good_sockets(fx.netstat(spark, d)).groupBy("type").agg(F.count("*").alias("n"))


@query("SELECT fd, count(*) AS n FROM procfd WHERE fd BETWEEN 3 AND 6 GROUP BY fd")
def flt5_fd_limit(spark, d):
    return clean.limit_fds(fx.procfd(spark, d), 4).groupBy("fd").agg(F.count("*").alias("n"))


_USEFUL = "(volatilityScore >= 0.1 OR isParent = 0 OR cpu_net >= 0.5 * duration) AND cpu_net < 1382400 AND duration < 86700"


@query(f"SELECT project, count(*) AS n, count(*) FILTER ({_USEFUL}) AS n_useful FROM repaired GROUP BY project")
def flt6_useful(spark, d):
    rows = workload.repair(fx.summary(spark, d))
    return rows.groupBy("project").agg(F.count("*").alias("n"), F.count_if(workload.useful()).alias("n_useful"))


@query("SELECT project AS p, host AS h, round(utime_net / 100.0 / nullif(duration, 0), 9) AS use FROM summary WHERE utime_net / 100.0 / nullif(duration, 0) > 0.5 AND numThreads > 3")
def flt7_adhoc(spark, d):
    return report.adhoc(fx.summary(spark, d), [("busy", "try_divide(utime_net / 100.0, duration)")], "busy > 0.5 AND numThreads > 3", [("p", "project"), ("h", "host"), ("use", "round(busy, 9)")])


@query("SELECT numThreads AS threads, rsspeak AS memory, count(*) AS n FROM summary GROUP BY ALL")
def flt8_aliases(spark, d):
    return fx.summary(spark, d).withColumnsRenamed({"numThreads": "threads", "rsspeak": "memory"}).groupBy("threads", "memory").agg(F.count("*").alias("n"))


@query("SELECT event_id, exePath FROM procdata WHERE regexp_matches(exePath, '^(/chos)?/house') OR regexp_matches(exePath, 'blast')")
def flt9_regexes(spark, d):
    return clean.match_any(fx.procdata(spark, d), "exePath", ["^(/chos)?/house", "blast"]).select("event_id", "exePath")


@query("SELECT host, identifier, count(*) AS n FROM procstat WHERE host IN ('h0', 'h2') AND identifier = 'j3' GROUP BY ALL")
def flt10_topic_filter(spark, d):
    rows = fx.procstat(spark, d).where(F.col("host").isin("h0", "h2"))
    return live.by_topic(rows, identifier="j3").groupBy("host", "identifier").agg(F.count("*").alias("n"))


_CATEGORIES = (("ring", (".* ring",)), ("ignore", ("red .*", ".*[(]deleted[)]")), ("bolt", (".*bolt.*",)))
_CATEGORY = "CASE WHEN regexp_full_match(command, '.* ring') THEN 'category_ring' WHEN regexp_full_match(command, 'red .*|.*[(]deleted[)]') THEN 'category_ignore' WHEN regexp_full_match(command, '.*bolt.*') THEN 'category_bolt' ELSE 'category_other' END"


@query(f"SELECT project, cat, count(*) AS n FROM (SELECT project, {_CATEGORY} AS cat FROM summary) WHERE cat != 'category_ignore' GROUP BY ALL")
def flt11_drop_ignored(spark, d):
    rows = workload.classify_distinct(fx.summary(spark, d), "command", scripts.categorize(F.col("command"), _CATEGORIES, "other"), "cat")
    return rows.where("cat != 'category_ignore'").groupBy("project", "cat").agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (coalesce(user, '') = '') AS empty_user, count(*) FILTER (coalesce(host, '') = '') AS empty_host, count(*) FILTER (coalesce(CASE WHEN isParent = 1 THEN '' ELSE command END, '') = '') AS empty_command FROM summary")
def flt12_empty_names(spark, d):
    return workload.empty_names(fx.summary(spark, d).withColumn("command", F.when(F.col("isParent") == 1, "").otherwise(F.col("command"))), ["user", "host", "command"])


@query("SELECT project, round(sum(cpu_net), 2) AS cpu, round(sum(volatilityScore), 4) AS vol, CAST(sum(duration) AS BIGINT) AS duration FROM repaired GROUP BY project")
def prj1_repair(spark, d):
    return workload.repair(fx.summary(spark, d)).groupBy("project").agg(F.round(F.sum("cpu_net"), 2).alias("cpu"), F.round(F.sum("volatilityScore"), 4).alias("vol"), F.sum("duration").alias("duration"))


@query("SELECT s.event_id, s.pid, s.utime, d.exePath FROM procstat s JOIN procdata d USING (event_id)")
def prj2_merge_trim(spark, d):
    data = fx.procdata(spark, d).select("event_id", "exePath", "cwdPath", "execName")
    return fx.procstat(spark, d).join(data, "event_id").drop("cwdPath", "execName").select("event_id", "pid", "utime", "exePath")


@query("SELECT host, count(*) AS n FROM procstat GROUP BY host")
def prj3_short_context(spark, d):
    rows = fx.procstat(spark, d).withColumn("host", F.concat("host", F.lit(".example.org")))
    return rows.groupBy(text.short_context(F.col("host")).alias("host")).agg(F.count("*").alias("n"))


# --- 2.3 joins ---

_KEYS = "host, startTime, pid"


@query(f"""SELECT coalesce(a.host, b.host, c.host) AS host, coalesce(a.startTime, b.startTime, c.startTime) AS startTime, coalesce(a.pid, b.pid, c.pid) AS pid, coalesce(n_stat, 0) AS n_stat, coalesce(n_data, 0) AS n_data, coalesce(n_fd, 0) AS n_fd
  FROM (SELECT {_KEYS}, count(*) AS n_stat FROM procstat GROUP BY ALL) a FULL JOIN (SELECT {_KEYS}, count(*) AS n_data FROM procdata WHERE exePath != 'Unknown' GROUP BY ALL) b USING ({_KEYS}) FULL JOIN (SELECT {_KEYS}, count(*) AS n_fd FROM procfd GROUP BY ALL) c USING ({_KEYS})""")
def jn1_assemble_any(spark, d):
    n = lambda rows, name: rows.groupBy(*PROCESS).agg(F.count("*").alias(name))
    parts = {"stat": n(fx.procstat(spark, d), "n_stat"), "data": n(fx.procdata(spark, d).where("exePath != 'Unknown'"), "n_data"), "fd": n(fx.procfd(spark, d), "n_fd")}
    return summary.assemble(parts).select(*PROCESS, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_stat", "n_data", "n_fd")])


@query(f"SELECT {_KEYS}, n_stat, n_fd FROM (SELECT {_KEYS}, count(*) AS n_stat FROM procstat GROUP BY ALL) JOIN (SELECT {_KEYS}, count(*) AS n_fd FROM procfd GROUP BY ALL) USING ({_KEYS})")
def jn2_assemble_both(spark, d):
    n = lambda rows, name: rows.groupBy(*PROCESS).agg(F.count("*").alias(name))
    parts = {"stat": n(fx.procstat(spark, d), "n_stat"), "fd": n(fx.procfd(spark, d), "n_fd")}
    return summary.assemble(parts, require=("stat", "fd")).select(*PROCESS, "n_stat", "n_fd")


_MID = START + 200_000
_LAST = "arg_max(utime, (recTime, recTimeUSec, event_id)) AS utime, arg_max(stime, (recTime, recTimeUSec, event_id)) AS stime"


@query(f"""SELECT s.host, s.startTime, s.pid, s.utime - CASE WHEN s.startTime < {_MID} THEN coalesce(b.utime, 0) ELSE 0 END AS utime_net, s.stime - CASE WHEN s.startTime < {_MID} THEN coalesce(b.stime, 0) ELSE 0 END AS stime_net, CASE WHEN s.startTime < {_MID} AND b.utime IS NOT NULL THEN {_MID} ELSE s.startTime END AS baseline_startTime
  FROM (SELECT {_KEYS}, {_LAST} FROM procstat WHERE recTime >= {_MID} GROUP BY ALL) s LEFT JOIN (SELECT {_KEYS}, {_LAST} FROM procstat WHERE recTime < {_MID} GROUP BY ALL) b USING ({_KEYS})""")
def jn3_baseline(spark, d):
    at = F.struct(*ORDER)
    last = lambda rows: rows.groupBy(*PROCESS).agg(*[F.max_by(c, at).alias(c) for c in ("utime", "stime")])
    rows = fx.procstat(spark, d)
    out = summary.net_of_baseline(last(rows.where(F.col("recTime") >= _MID)), last(rows.where(F.col("recTime") < _MID)), _MID, ["utime", "stime"])
    return out.select(*PROCESS, "utime_net", "stime_net", "baseline_startTime")


@query(f"SELECT {_KEYS}, arg_max(utime, (recTime, recTimeUSec, event_id)) - CASE WHEN startTime < {_MID} THEN arg_min(utime, (recTime, recTimeUSec, event_id)) ELSE 0 END AS utime_net FROM procstat WHERE recTime >= {_MID} GROUP BY {_KEYS}")
def jn4_first_sample(spark, d):
    return summary.net_of_first(fx.procstat(spark, d).where(F.col("recTime") >= _MID), _MID, ["utime"], order=ORDER)


def _processes(spark, d) -> DataFrame:
    return fx.procstat(spark, d).groupBy("host", "startTime", "pid", "identifier", "subidentifier").agg(F.min("ppid").alias("ppid"), F.min("realUid").alias("realUid"), F.max("recTime").alias("recTime"), F.max("numThreads").alias("numThreads"))


_PROCESSES = f"(SELECT {_KEYS}, identifier, subidentifier, min(ppid) AS ppid, min(realUid) AS realUid, max(recTime) AS recTime, max(numThreads) AS numThreads FROM procstat GROUP BY ALL)"


@query(f"SELECT {_KEYS}, coalesce(project, 'Unknown') AS project FROM {_PROCESSES} p LEFT JOIN (SELECT job, task, arg_max(project, line_no) AS project FROM jobs GROUP BY ALL) j ON identifier = job AND subidentifier = task")
def jn5_project_last(spark, d):
    return jobs.attach_project(_processes(spark, d), fx.jobs(spark, d)).select(*PROCESS, "project")


@query(f"SELECT {_KEYS}, coalesce(project, 'unknown project') AS project FROM {_PROCESSES} p LEFT JOIN (SELECT job, arg_min(project, line_no) AS project FROM jobs GROUP BY ALL) j ON identifier = job")
def jn6_project_first(spark, d):
    return jobs.attach_project(_processes(spark, d), fx.jobs(spark, d), by_task=False, last=False, unknown="unknown project").select(*PROCESS, "project")


@query(f"SELECT {_KEYS}, project FROM {_PROCESSES} p LEFT JOIN (SELECT job, arg_max(project, line_no) AS project FROM jobs GROUP BY ALL) j ON identifier = job")
def jn7_project_or_null(spark, d):
    return jobs.attach_project(_processes(spark, d), fx.jobs(spark, d), by_task=False).select(*PROCESS, F.nullif("project", F.lit("Unknown")).alias("project"))


@query(f"SELECT {_KEYS}, coalesce(name, CAST(realUid AS VARCHAR)) AS user FROM {_PROCESSES} p LEFT JOIN users ON realUid = uid")
def jn8_user(spark, d):
    return jobs.attach_user(_processes(spark, d), fx.users(spark, d)).select(*PROCESS, "user")


@query(f"SELECT {_KEYS}, CAST((host, pid) IN (SELECT (host, ppid) FROM procstat) AS INT) AS isParent FROM {_PROCESSES} p")
def jn9_parents(spark, d):
    return tree.flag_parents(_processes(spark, d)).select(*PROCESS, "isParent")


@query("""SELECT startTime, pid, host, CAST(sum(f) AS BIGINT) AS n_parent_files, CAST(sum(f) > 0 AS INT) AS isParent FROM (SELECT DISTINCT a.file, a.host, a.startTime, a.pid, CAST((a.file, a.host, a.pid) IN (SELECT (recTime // 86400, host, ppid) FROM procstat) AS INT) AS f FROM (SELECT DISTINCT recTime // 86400 AS file, host, startTime, pid FROM procstat) a) GROUP BY ALL""")
def jn10_daily_parents(spark, d):
    return tree.daily_parents(fx.procstat(spark, d).withColumn("file", F.floor(F.col("recTime") / 86400)))


@query(f"SELECT {_KEYS} FROM {_PROCESSES} p WHERE (identifier, ppid) NOT IN (SELECT (identifier, pid) FROM procstat)")
def jn11_roots(spark, d):
    return tree.roots(_processes(spark, d)).select(*PROCESS)


@query("SELECT job_row, count(*) AS n, CAST(max(r.utime) AS BIGINT) AS utime FROM job_intervals j JOIN procstat r ON j.host = r.host AND j.job = r.identifier AND j.task = r.subidentifier AND r.recTime BETWEEN j.start AND j.stop GROUP BY job_row")
def jn12_job_records(spark, d):
    return jobs.totals_of_records(fx.job_intervals(spark, d), fx.procstat(spark, d), ["job_row"], ["utime"])


@query("SELECT c.host, c.pid, c.startTime, c.ppid, max(p.startTime) AS parentStart FROM (SELECT DISTINCT host, pid, startTime, ppid FROM procstat) c LEFT JOIN (SELECT DISTINCT host, pid, startTime FROM procstat) p ON p.host = c.host AND p.pid = c.ppid AND p.startTime <= c.startTime GROUP BY ALL")
def jn13_parent_at_start(spark, d):
    return tree.parent_at_start(_processes(spark, d).select("host", "pid", "startTime", "ppid").distinct())


_IP = lambda c: f"({c} & 255) || '.' || (({c} >> 8) & 255) || '.' || (({c} >> 16) & 255) || '.' || (({c} >> 24) & 255)"


@query(f"SELECT f.host, f.pid, f.fd, f.recTime, f.mode, coalesce(CASE WHEN type = 0 THEN 'tcp' ELSE 'udp' END || ':' || {_IP('la')} || ':' || lp || ':' || {_IP('ra')} || ':' || rp, f.path) AS path FROM procfd f LEFT JOIN (SELECT * FROM netstat WHERE type IN (0, 1) AND inode != 0) n ON n.host = f.host AND f.path = 'socket:[' || n.inode || ']'")
def jn14_sockets(spark, d):
    return report.resolve_sockets(fx.procfd(spark, d), clean.good_sockets(fx.netstat(spark, d))).select("host", "pid", "fd", "recTime", "mode", "path")


@query("SELECT recording_start AS hour FROM hours WHERE n_writes % 4 != 1")
def jn16_closed_hours(spark, d):
    h = fx.hours(spark, d).withColumn("hour", F.col("recording_start"))
    return report.closed_hours(h.select("hour"), h.where("n_writes % 4 = 1").select("hour"))


@query("SELECT event_id, utime - lag(utime) OVER (PARTITION BY host, startTime, pid ORDER BY recTime, recTimeUSec, event_id) AS d_utime FROM procstat")
def jn17_previous(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy(*PROCESS).orderBy(*ORDER)
    return fx.procstat(spark, d).select("event_id", (F.col("utime") - F.lag("utime").over(w)).alias("d_utime"))


@query(", nodes AS (SELECT DISTINCT host, pid, ppid FROM procstat), sub(host, pid) AS (SELECT host, pid FROM nodes WHERE pid IN (7, 12) UNION SELECT n.host, n.pid FROM nodes n JOIN sub s ON n.host = s.host AND n.ppid = s.pid) SELECT host, pid FROM sub")
def jn18_subtree(spark, d):
    rows = _processes(spark, d)
    return tree.subtree(rows, rows.where(F.col("pid").isin(7, 12)), ("host",))


@query(", nodes AS (SELECT DISTINCT host, pid, ppid FROM procstat), lv(host, pid, level, path) AS (SELECT host, pid, 0, CAST(pid AS VARCHAR) FROM nodes a WHERE NOT EXISTS (SELECT 1 FROM nodes b WHERE b.host = a.host AND b.pid = a.ppid) UNION ALL SELECT n.host, n.pid, l.level + 1, l.path || '/' || n.pid FROM nodes n JOIN lv l ON n.host = l.host AND n.ppid = l.pid WHERE n.pid != n.ppid) SELECT host, pid, level, path FROM lv")
def jn19_levels(spark, d):
    return tree.levels(_processes(spark, d), ("host",)).select("host", "pid", "level", F.concat_ws("/", F.transform("path", lambda p: p.cast("string"))).alias("path"))


# --- 2.4 aggregations ---


@query(f"SELECT {_KEYS}, arg_max(utime, (recTime, recTimeUSec, event_id)) FILTER (undamaged) AS utime, arg_max(state, (recTime, recTimeUSec, event_id)) FILTER (undamaged) AS state, count(*) AS nRecords FROM rated GROUP BY {_KEYS}")
def agg1_latest_sample(spark, d):
    return summary.summarize(fx.procstat(spark, d), order=ORDER).select(*PROCESS, "utime", "state", "nRecords")


@query(f"SELECT {_KEYS}, arg_max(exePath, (recTime, recTimeUSec, event_id)) FILTER (NOT contains(exePath, 'Unknown')) AS exePath FROM procdata GROUP BY {_KEYS}")
def agg2_identity(spark, d):
    return summary.identity(fx.procdata(spark, d), order=ORDER).select(*PROCESS, "exePath")


@query(f"SELECT {_KEYS}, count(*) AS nObservations FROM procstat GROUP BY {_KEYS}")
def agg3_observations(spark, d):
    return summary.observed(clean.observations(fx.procstat(spark, d)))


@query(f"SELECT {_KEYS}, round(max(cpuRate), 6) AS cpu, round(max(iowRate), 4) AS iow, round(max(iorRate), 4) AS ior, max(msizeRate) AS msize, max(mresidentRate) AS mres FROM rated GROUP BY {_KEYS}")
def agg4_rate_maxima(spark, d):
    rows = summary.series(fx.procstat(spark, d), order=ORDER)
    return rows.groupBy(*PROCESS).agg(F.round(F.max("cpuRate"), 6).alias("cpu"), F.round(F.max("iowRate"), 4).alias("iow"), F.round(F.max("iorRate"), 4).alias("ior"), F.max("msizeRate").alias("msize"), F.max("mresidentRate").alias("mres"))


def _corr(a: str, b: str) -> str:
    n, flat = f"count({a} + {b})", lambda x: f"sum({x} * {x}) - sum({x}) * sum({x}) / count({a} + {b}) > 1e-9 * sum({x} * {x})"
    return f"CASE WHEN {n} >= 2 AND {flat(a)} AND {flat(b)} THEN round(corr({a}, {b}), 4) + 0 END"


@query(f"SELECT {_KEYS}, {_corr('cpuRate', 'iowRate')} AS cpu_iow, {_corr('cpuRate', 'mresidentRate')} AS cpu_mres, {_corr('iorRate', 'msizeRate')} AS ior_msize FROM rated GROUP BY {_KEYS} HAVING count(*) >= 6")
def agg5_correlations(spark, d):
    out = summary.summarize(fx.procstat(spark, d), order=ORDER).where("nRecords >= 6")
    return out.select(*PROCESS, *[(F.round(c, 4) + 0).alias(n) for c, n in (("cor_cpuXiow", "cpu_iow"), ("cor_cpuXmresident", "cpu_mres"), ("cor_iorXmsize", "ior_msize"))])


@query(f"SELECT {_KEYS}, round(max(t - startTime), 4) AS max_duration, max((utime + stime) / 100.0) AS max_cpu FROM rated GROUP BY {_KEYS}")
def agg6_maxima(spark, d):
    age = text.seconds(F.col("recTime"), F.col("recTimeUSec")) - F.col("startTime")
    return fx.procstat(spark, d).groupBy(*PROCESS).agg(F.round(F.max(age), 4).alias("max_duration"), F.max((F.col("utime") + F.col("stime")) / 100.0).alias("max_cpu"))


@query(f"SELECT {_KEYS}, round(CASE WHEN count(*) > 0 THEN (count(*) FILTER (state != 'D') - 1) / count(*) ELSE 0 END, 6) AS volatility FROM procstat GROUP BY {_KEYS}")
def agg7_volatility(spark, d):
    return fx.procstat(spark, d).groupBy(*PROCESS).agg(F.round(summary.volatility(F.count_if(F.col("state") != "D"), F.count("*")), 6).alias("volatility"))


@query(f"""SELECT {_KEYS}, label AS filesystem, count(*) FILTER (mode & 256 != 0) AS read, count(*) FILTER (mode & 128 != 0) AS "write" FROM procfd, (VALUES {', '.join(f"('{a}', '{b}')" for a, b in LABELS)}) l(label, re) WHERE regexp_full_match(path, re) GROUP BY ALL""")
def agg8_filesystems(spark, d):
    return summary.filesystem_use(fx.procfd(spark, d), LABELS)


@query(f"SELECT {_KEYS}, " + ", ".join(f"max(CAST(regexp_full_match(path, '{r}') AND mode & {bit} != 0 AS INT)) AS {a}_{n}" for a, r in LABELS for n, bit in (("read", 256), ("write", 128))) + f" FROM procfd GROUP BY {_KEYS}")
def agg9_filesystem_flags(spark, d):
    return summary.filesystem_flags(fx.procfd(spark, d), LABELS)


@query(f"SELECT DISTINCT {_KEYS}, split_part(path, ':', 1) AS protocol, split_part(path, ':', 2) AS localAddress, CAST(split_part(path, ':', 3) AS BIGINT) AS localPort, split_part(path, ':', 4) AS remoteAddress, CAST(split_part(path, ':', 5) AS BIGINT) AS remotePort FROM procfd WHERE regexp_matches(path, '^(tcp|udp):')")
def agg10_connections(spark, d):
    return summary.connections(fx.procfd(spark, d))


_TABLE = f"count(duration) AS duration_count, CAST(sum(duration) AS BIGINT) AS duration_sum, {_hist('duration', 'duration', BINS['duration'])}, count(cpu_net) AS cpu_count, round(sum(cpu_net), 2) AS cpu_sum, {_hist('cpu_net', 'cpu', BINS['cpu'])}"


def _flattened(df: DataFrame) -> DataFrame:
    for m in MEASURES:
        df = _flat(df, f"{m.name}_histogram", len(m.bins) - 1, m.name)
    return df.withColumn("cpu_sum", F.round("cpu_sum", 2))


@query(f"SELECT project, host, {_TABLE} FROM repaired GROUP BY project, host")
def agg11_workload(spark, d):
    return _flattened(workload.table(workload.repair(fx.summary(spark, d)), ("project", "host"), MEASURES))


@query(f"SELECT {_hist('duration', 'duration', BINS['duration'])} FROM repaired")
def agg12_histogram(spark, d):
    return _flat(workload.repair(fx.summary(spark, d)).agg(workload.histogram(F.col("duration"), BINS["duration"]).alias("h")), "h", 3, "duration")


@query(f"SELECT project, {_TABLE} FROM repaired GROUP BY project")
def agg13_merge(spark, d):
    rows = workload.repair(fx.summary(spark, d))
    parts = [workload.table(rows.where(F.col("numThreads") % 2 == i), ("project",), MEASURES) for i in range(2)]
    return _flattened(workload.merge(parts, ("project",), {f"{m.name}_histogram": len(m.bins) - 1 for m in MEASURES}))


@query(f"SELECT project, execCommand, {_TABLE} FROM repaired GROUP BY project, execCommand")
def agg14_merge_by_name(spark, d):
    rows = workload.repair(fx.summary(spark, d))
    parts = [workload.table(rows.where(F.col("isParent") == i), ("project", "execCommand"), MEASURES) for i in range(2)]
    return _flattened(workload.merge(parts, workload.keys_of(parts[0]), {f"{m.name}_histogram": len(m.bins) - 1 for m in MEASURES}))


_AXES = (("host", "command"), ("project", "command"), ("project", "execCommand"), ("host",), ("user", "execCommand"))


@query("SELECT " + ", ".join(f"{k}" for k in ("command", "execCommand", "host", "project", "user")) + ", CASE " + " ".join("WHEN " + " AND ".join(f"grouping({k}) = {0 if k in s else 1}" for k in ("command", "execCommand", "host", "project", "user")) + f" THEN '{'*'.join(s)}'" for s in _AXES) + " END AS axis, CAST(sum(duration) AS BIGINT) AS duration, CAST(sum(nRecords) AS BIGINT) AS nRecords FROM summary GROUP BY GROUPING SETS (" + ", ".join("(" + ", ".join(s) + ")" for s in _AXES) + ")")
def agg15_axes(spark, d):
    return workload.axes(fx.summary(spark, d), _AXES, ("duration", "nRecords"), deal=("host", "user"))


_REPORT = """(SELECT host, user, project, execCommand AS executable, p_script AS script, command, utime_net AS utime, stime_net AS stime, startTime, startTime + duration AS recTime FROM (SELECT *, split_part(command, ' ', 1) AS p_script FROM summary))"""
_RKEYS = ("command", "executable", "host", "project", "script", "user")


def _report_rows(spark, d) -> DataFrame:
    return fx.summary(spark, d).select("host", "user", "project", F.col("execCommand").alias("executable"), F.get(F.split("command", " "), 0).alias("script"), "command", F.col("utime_net").alias("utime"), F.col("stime_net").alias("stime"), "startTime", (F.col("startTime") + F.col("duration")).alias("recTime"))


@query("SELECT " + ", ".join(_RKEYS) + ", CASE " + " ".join("WHEN " + " AND ".join(f"grouping({k}) = {0 if k in s else 1}" for k in _RKEYS) + f" THEN '{'*'.join(s)}'" for s in report.GROUPINGS) + f" END AS type, CAST(sum(utime + stime) AS BIGINT) / 100.0 AS cpu_time, CAST(sum(recTime - startTime) AS BIGINT) AS walltime, count(*) AS nobs FROM {_REPORT} GROUP BY GROUPING SETS (" + ", ".join("(" + ", ".join(s) + ")" for s in report.GROUPINGS) + ")")
def agg16_daily_report(spark, d):
    return report.daily(_report_rows(spark, d))


@query("""SELECT s.identifier, CAST(peak_sum AS BIGINT) AS peak_sum, peak_time, max_value, max_pid FROM (SELECT identifier, max(s) AS peak_sum, arg_max(recTime, (s, -recTime)) AS peak_time FROM (SELECT identifier, recTime, sum(m_resident) AS s FROM procstat GROUP BY ALL) GROUP BY identifier) s
  JOIN (SELECT identifier, max(m_resident) AS max_value, arg_max(pid, (m_resident, pid, startTime)) AS max_pid FROM procstat GROUP BY identifier) m USING (identifier)""")
def agg17_peaks(spark, d):
    return jobs.peaks(fx.procstat(spark, d), "m_resident").select("identifier", "peak_sum", "peak_time", "max_value", "max_pid")


@query("""SELECT c.*, largest_gap, 'procstat' AS kind FROM (SELECT identifier, host, min(recTime) AS first_time, max(recTime) AS last_time, count(DISTINCT recTime) AS n_times, count(DISTINCT (pid, startTime)) AS n_processes FROM procstat GROUP BY ALL) c
  JOIN (SELECT identifier, host, coalesce(max(g), 0) AS largest_gap FROM (SELECT identifier, host, recTime - lag(recTime) OVER (PARTITION BY identifier, host ORDER BY recTime) AS g FROM (SELECT DISTINCT identifier, host, recTime FROM procstat)) GROUP BY ALL) USING (identifier, host)""")
def agg18_coverage(spark, d):
    return jobs.coverage(fx.procstat(spark, d), "procstat")


@query("SELECT host, CAST(sum(k = 1) AS BIGINT) AS procstat, CAST(sum(k = 2) AS BIGINT) AS procfd FROM (SELECT host, 1 AS k FROM procstat UNION ALL SELECT host, 2 FROM procfd) GROUP BY host")
def agg19_inventory(spark, d):
    return report.inventory({"procstat": fx.procstat(spark, d), "procfd": fx.procfd(spark, d)})


@query("SELECT min(recording_start) AS recording_start, max(recording_start + INTERVAL 1 HOUR) AS recording_stop, CAST(sum(n_writes) AS BIGINT) AS n_writes, string_agg(path, ',' ORDER BY path) AS sources FROM hours")
def agg20_merge_files(spark, d):
    return report.merge_files(fx.hours(spark, d).withColumn("recording_stop", F.col("recording_start") + F.expr("INTERVAL 1 HOUR")))


@query("SELECT 'Any' AS name, 0 AS place UNION ALL SELECT DISTINCT project, 1 FROM summary WHERE project != ''")
def agg21_names(spark, d):
    return report.names(fx.summary(spark, d), "project")


@query("SELECT user, count(*) FILTER (execCommand = 'ECONOMY') AS n_exe, count(*) FILTER (execCommand != 'ECONOMY') AS n_script FROM summary GROUP BY user")
def agg22_kinds_by_user(spark, d):
    return report.kinds_by(fx.summary(spark, d), "user", F.col("execCommand") == "ECONOMY")


@query("SELECT execCommand AS type, count(*) AS n FROM summary WHERE project = 'MACHINERY' AND host = 'Supplier#000000001' GROUP BY execCommand")
def agg23_dashboard(spark, d):
    return fx.summary(spark, d).where("project = 'MACHINERY' AND host = 'Supplier#000000001'").groupBy(F.col("execCommand").alias("type")).agg(F.count("*").alias("n"))


@query("SELECT CAST(g AS DATE) AS day, count(*) FILTER (execCommand = 'ECONOMY') AS n_exe, count(*) FILTER (execCommand IS NOT NULL AND execCommand != 'ECONOMY') AS n_script FROM generate_series(TIMESTAMP '1997-01-01', TIMESTAMP '1997-01-12', INTERVAL 1 DAY) t(g) LEFT JOIN summary ON CAST(summary.day AS DATE) = CAST(g AS DATE) GROUP BY g")
def agg24_days_around(spark, d):
    rows = fx.summary(spark, d).withColumnRenamed("day", "at")
    return report.days_around(rows, F.to_date("at"), "1997-01-05", 7, "1997-01-01", "2000-12-31", F.col("execCommand") == "ECONOMY")


@query("SELECT host, count(DISTINCT (pid, startTime)) AS n FROM procstat GROUP BY host")
def agg25_processes_per_host(spark, d):
    return fx.procstat(spark, d).groupBy("host").agg(F.count_distinct("pid", "startTime").alias("n"))


@query("SELECT count(*) AS n_rows, count(*) FILTER (isParent = 0) AS n_selected, CAST(sum(utime_net) AS BIGINT) AS total, CAST(sum(utime_net) FILTER (isParent = 0) AS BIGINT) AS total_selected, count(DISTINCT (project, host)) AS n_groups FROM summary")
def agg26_reconcile(spark, d):
    return workload.reconcile(fx.summary(spark, d), F.col("isParent") == 0, ["project", "host"], "utime_net")


@query("SELECT isParent, bin, count(*) AS count FROM (SELECT isParent, CASE WHEN volatilityScore = 1 THEN 50 ELSE CAST(floor(volatilityScore * 50) AS BIGINT) + 1 END AS bin FROM repaired) WHERE bin BETWEEN 1 AND 50 GROUP BY ALL")
def agg27_volatility_histogram(spark, d):
    return workload.flag_histogram(workload.repair(fx.summary(spark, d)), "isParent", "volatilityScore", 50, 0.0, 1.0)


@query(f"SELECT what, count(*) AS n, {_hist('greatest(duration - 50000, 0)', 'duration', BINS['duration'])} FROM (SELECT CASE WHEN regexp_matches(command, 'ring|gear') THEN 'turning' WHEN regexp_matches(command, 'bolt') THEN 'fixing' ELSE 'Other' END AS what, duration FROM repaired) GROUP BY what")
def agg28_mapped_dimension(spark, d):
    rows = workload.repair(fx.summary(spark, d)).withColumn("what", scripts.map_value(F.col("command"), [("ring|gear", "turning"), ("bolt", "fixing")]))
    out = rows.groupBy("what").agg(F.count("*").alias("n"), workload.histogram(F.greatest(F.col("duration") - 50_000, F.lit(0)), BINS["duration"]).alias("h"))
    return _flat(out, "h", 3, "duration")


@query(f"SELECT {_KEYS}, round(100.0 * (startTime - job_start) / nullif(job_duration, 0), 4) AS start_pct, round(100.0 * (recTime - startTime) / nullif(job_duration, 0), 4) AS duration_pct, max_threads FROM {_PROCESSES} p JOIN (SELECT identifier, min(startTime) AS job_start, max(recTime) - min(startTime) AS job_duration, max(numThreads) AS max_threads FROM procstat GROUP BY identifier) USING (identifier)")
def agg29_job_shares(spark, d):
    return jobs.shares(_processes(spark, d)).select(*PROCESS, F.round("start_pct", 4).alias("start_pct"), F.round("duration_pct", 4).alias("duration_pct"), "max_threads")


# --- 2.5 windows ---


@query("SELECT event_id, round(cpuRate, 6) AS cpu, round(iowRate, 4) AS iow, round(iorRate, 4) AS ior FROM rated")
def win1_rates(spark, d):
    return summary.series(fx.procstat(spark, d), order=ORDER).select("event_id", F.round("cpuRate", 6).alias("cpu"), F.round("iowRate", 4).alias("iow"), F.round("iorRate", 4).alias("ior"))


@query("SELECT event_id, round((utime + stime) / 100.0 / nullif(recTime - startTime + recTimeUSec / 1e6, 0), 8) AS cpu_rate, round((io_rchar + io_wchar) / nullif(recTime - startTime + recTimeUSec / 1e6, 0), 4) AS io_rate FROM procstat")
def win2_overall_rates(spark, d):
    return jobs.overall_rates(fx.procstat(spark, d)).select("event_id", F.round("cpu_rate", 8).alias("cpu_rate"), F.round("io_rate", 4).alias("io_rate"))


@query("SELECT event_id, host, pid, state FROM (SELECT *, (state, numThreads) AS s, lead((state, numThreads)) OVER (PARTITION BY host, pid ORDER BY recTime, recTimeUSec, event_id) AS n, lead(1) OVER (PARTITION BY host, pid ORDER BY recTime, recTimeUSec, event_id) AS has FROM procstat) WHERE has IS NULL OR s IS DISTINCT FROM n")
def win3_collapse(spark, d):
    return clean.collapse(fx.procstat(spark, d), ("host", "pid"), ("state", "numThreads"), ORDER).select("event_id", "host", "pid", "state")


@query("SELECT identifier, max(g) AS gap FROM (SELECT identifier, t - lag(t) OVER (PARTITION BY identifier ORDER BY t) AS g FROM (SELECT DISTINCT identifier, recTime AS t FROM procstat)) GROUP BY identifier")
def win4_gaps(spark, d):
    return jobs.coverage(fx.procstat(spark, d), "procstat", ("identifier",)).select("identifier", F.col("largest_gap").alias("gap"))


@query("SELECT host, pid, startTime, fd, path, mode, recTime FROM (SELECT *, lead((path, mode)) OVER w AS n, lead(1) OVER w AS has FROM (SELECT DISTINCT host, pid, startTime, fd, path, mode, recTime FROM procfd) WINDOW w AS (PARTITION BY host, pid, startTime, fd ORDER BY recTime, path, mode)) WHERE has IS NULL OR (path, mode) IS DISTINCT FROM n")
def win5_collapse_fds(spark, d):
    rows = fx.procfd(spark, d).select("host", "pid", "startTime", "fd", "path", "mode", "recTime").distinct()
    return clean.collapse(rows, ("host", "pid", "startTime", "fd"), ("path", "mode"), ("recTime", "path", "mode"))


@query("SELECT event_id, min(recTime) OVER (PARTITION BY host, pid, run) AS since FROM (SELECT *, sum(c) OVER (PARTITION BY host, pid ORDER BY recTime, recTimeUSec, event_id) AS run FROM (SELECT *, CASE WHEN lag(state) OVER (PARTITION BY host, pid ORDER BY recTime, recTimeUSec, event_id) = state THEN 0 ELSE 1 END AS c FROM procstat))")
def win6_state_since(spark, d):
    return clean.runs(fx.procstat(spark, d), ("host", "pid"), "state", ORDER, "recTime").select("event_id", "since")


@query("SELECT host, pid, event_id, recTime FROM (SELECT *, row_number() OVER (PARTITION BY host, pid ORDER BY recTime DESC, recTimeUSec DESC, event_id DESC) AS k FROM procstat) WHERE k = 1")
def win7_latest(spark, d):
    return fx.procstat(spark, d).groupBy("host", "pid").agg(F.max_by(F.struct("event_id", "recTime"), F.struct(*ORDER)).alias("r")).select("host", "pid", "r.*")


@query("SELECT project, command, CAST(total AS BIGINT) AS total, round(total / sum(total) OVER (PARTITION BY project), 8) AS share, total / sum(total) OVER (PARTITION BY project) < 0.005 AS small FROM (SELECT project, command, sum(duration) AS total FROM summary GROUP BY ALL)")
def win8_shares(spark, d):
    return workload.shares(fx.summary(spark, d), "project", "command", "duration").select("project", "command", "total", F.round("share", 8).alias("share"), (F.col("label") == "").alias("small"))


@query("SELECT event_id, round((utime + stime - coalesce(lag(utime + stime) OVER w, 0)) / 100.0 / nullif(recTime - coalesce(lag(recTime) OVER w, startTime), 0), 8) AS cpu_rate FROM procstat WINDOW w AS (PARTITION BY host, startTime, pid ORDER BY recTime, recTimeUSec, event_id)")
def win9_rate_from_start(spark, d):
    return jobs.rate_from_start(fx.procstat(spark, d), PROCESS, ORDER).select("event_id", F.round("cpu_rate", 8).alias("cpu_rate"))


# --- 2.6 sorts and pages ---


@query("SELECT host, pid, startTime, project, duration FROM summary ORDER BY project DESC, duration, host, startTime, pid LIMIT 25 OFFSET 50")
def srt2_page(spark, d):
    return report.page(fx.summary(spark, d).select("host", "pid", "startTime", "project", "duration"), [("project", True), ("duration", False)], 50, 25, ("host", "startTime", "pid"))


@query("SELECT host, pid, max(m_resident) AS rss, max(numThreads) AS threads FROM procstat GROUP BY host, pid ORDER BY rss DESC, pid LIMIT 20")
def srt3_live_ranking(spark, d):
    return fx.procstat(spark, d).groupBy("host", "pid").agg(F.max("m_resident").alias("rss"), F.max("numThreads").alias("threads")).orderBy(F.desc("rss"), "pid").limit(20)


@query("SELECT project, command, CAST(total AS BIGINT) AS total, place FROM (SELECT project, command, total, CAST(row_number() OVER (PARTITION BY project ORDER BY total DESC, command) AS INT) AS place FROM (SELECT project, command, sum(duration) AS total FROM summary GROUP BY ALL)) WHERE place <= 5")
def srt4_top_categories(spark, d):
    sums = fx.summary(spark, d).groupBy("project", "command").agg(F.sum("duration").alias("total"))
    return report.top_per_key(sums, "project", "total", 5, "command")


@query(f"SELECT {_KEYS}, CAST(row_number() OVER (PARTITION BY identifier ORDER BY startTime, pid, host) AS INT) AS place FROM {_PROCESSES} p")
def srt5_job_listing(spark, d):
    from pyspark.sql import Window

    return _processes(spark, d).select(*PROCESS, F.row_number().over(Window.partitionBy("identifier").orderBy("startTime", "pid", "host")).alias("place"))


# --- 2.7 set operations ---


@query("SELECT host, pid, count(*) AS n FROM (SELECT host, pid FROM procstat UNION ALL SELECT host, pid FROM procfd) GROUP BY ALL")
def set1_concatenate(spark, d):
    return fx.procstat(spark, d).select("host", "pid").unionByName(fx.procfd(spark, d).select("pid", "host")).groupBy("host", "pid").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT host, startTime, pid FROM procstat")
def set2_distinct(spark, d):
    return fx.procstat(spark, d).select(*PROCESS).distinct()


@query("SELECT pid FROM procstat INTERSECT SELECT ppid FROM procstat")
def set3_intersect(spark, d):
    rows = fx.procstat(spark, d)
    return rows.select("pid").intersect(rows.select(F.col("ppid").alias("pid")))


@query("SELECT job, CASE WHEN n.job IS NULL THEN o.project ELSE n.project END AS project FROM (SELECT job, project FROM jobs0 WHERE line_no % 2 = 0) o FULL JOIN (SELECT job, 'NEW_' || project AS project FROM jobs0 WHERE line_no % 3 = 0) n USING (job)")
def set4_replace_or_append(spark, d):
    rows = fx.jobs(spark, d).where("line_no < 100")
    return report.replace_or_append(rows.where("line_no % 2 = 0").select("job", "project"), rows.where("line_no % 3 = 0").select("job", F.concat(F.lit("NEW_"), "project").alias("project")), ["job"])


@query("SELECT host, CAST(coalesce(sum(duration), 0) AS BIGINT) AS duration FROM (SELECT host, duration FROM summary WHERE isParent = 1 UNION ALL SELECT host, nRecords FROM summary WHERE numThreads > 5) GROUP BY host")
def set5_add_fill(spark, d):
    rows = fx.summary(spark, d)
    return report.add_fill(rows.where("isParent = 1").select("host", "duration"), rows.where("numThreads > 5").select("host", F.col("nRecords").alias("duration")), ["host"])


@query("SELECT job_row, greatest(job_row % 3, 1) AS task, start FROM job_intervals WHERE job_row % 4 = 0 UNION ALL SELECT job_row, greatest(job_row % 3, 1), start FROM job_intervals WHERE job_row % 4 != 0 AND start BETWEEN 1705000000 - 86400 AND 1705100000 + 50000")
def set6_all_jobs(spark, d):
    rows = fx.job_intervals(spark, d).select("job_row", (F.col("job_row") % 3).alias("task"), "start")
    return jobs.all_jobs(rows.where("job_row % 4 = 0"), rows.where("job_row % 4 != 0"), 1_705_000_000, 1_705_100_000, 50_000)


@query("SELECT 'h' || (user_id % 5) AS expected, count(*) AS n FROM events WHERE 'h' || ((user_id + event_id % 2) % 5) != 'h' || (user_id % 5) GROUP BY 1")
def set7_wrong_host(spark, d):
    host = lambda x: F.concat(F.lit("h"), (x % 5).cast("string"))
    rows = fx.table(spark, d, "events").select(host(F.col("user_id") + F.col("event_id") % 2).alias("host"), host(F.col("user_id")).alias("expected"))
    return report.wrong_host(rows, "host", "expected")


# --- 2.8 scalar functions ---


@query("SELECT event_id, regexp_extract(exePath, '[^/]*$') AS base FROM procdata")
def sc1_basename(spark, d):
    return fx.procdata(spark, d).select("event_id", scripts.basename(F.col("exePath")).alias("base"))


_SCRIPT = "CASE WHEN exePath = 'Unknown' THEN NULL ELSE CASE pid % 8 WHEN 0 THEN '/home/u/run.py' WHEN 1 THEN 'COMMAND' WHEN 2 THEN '/opt/jobs/sgeJob77.sh' WHEN 3 THEN 'org.tool.Main' WHEN 6 THEN 'tool.rb' WHEN 7 THEN 'start.csh' END END"


@query(f"SELECT event_id, {_SCRIPT} AS script FROM procdata")
def sc2_scripts(spark, d):
    return fx.procdata(spark, d).select("event_id", scripts.script(F.col("exePath"), F.col("cmdArgs")).alias("script"))


@query("SELECT event_id, CASE pid % 8 WHEN 0 THEN 'ignore' WHEN 1 THEN 'print 1' WHEN 2 THEN '/etc/rc' WHEN 3 THEN 'a.jar' WHEN 4 THEN 'blastn' WHEN 5 THEN 'view' WHEN 6 THEN 'lib' ELSE 'start.csh' END AS arg FROM procdata")
def sc3_first_argument(spark, d):
    return fx.procdata(spark, d).select("event_id", scripts.first_plain_argument(F.col("cmdArgs")).alias("arg"))


@query(f"SELECT event_id, CASE WHEN coalesce(script, '') IN ('', 'COMMAND') THEN regexp_extract(exePath, '[^/]*$') ELSE regexp_extract(script, '[^/]*$') END AS command FROM (SELECT *, {_SCRIPT} AS script FROM procdata)")
def sc4_command(spark, d):
    rows = fx.procdata(spark, d).withColumn("script", scripts.script(F.col("exePath"), F.col("cmdArgs")))
    return rows.select("event_id", scripts.command(F.col("exePath"), F.col("script")).alias("command"))


@query("SELECT command, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(c1, '^(?:ruby)') THEN regexp_replace(c1, 'ruby([0-9.]*)', 'RB\\1', 'g') ELSE c1 END AS command FROM (SELECT CASE WHEN regexp_matches(exePath, '^(?:/house/([a-z]+)/)') THEN regexp_replace(exePath, '/house/([a-z]+)/', 'house:\\1:', 'g') ELSE regexp_extract(exePath, '[^/]*$') END AS c1 FROM procdata)) GROUP BY command")
def sc5_rewrite(spark, d):
    rows = fx.procdata(spark, d)
    command = scripts.rewrite(scripts.basename(F.col("exePath")), [("exePath", "/house/([a-z]+)/", "house:$1:"), ("command", "ruby([0-9.]*)", "RB$1")])
    return rows.groupBy(command.alias("command")).agg(F.count("*").alias("n"))


@query(f"SELECT category, count(*) AS n FROM (SELECT {_CATEGORY} AS category FROM summary) GROUP BY category")
def sc6_categories(spark, d):
    rows = workload.classify_distinct(fx.summary(spark, d), "command", scripts.categorize(F.col("command"), _CATEGORIES, "other"), "category")
    return rows.groupBy("category").agg(F.count("*").alias("n"))


@query("SELECT path, count(*) AS n FROM (SELECT regexp_replace(regexp_replace(path, '(?i)^/CHOS', ''), '(?i)^/global/projectb', '/pb') AS path FROM procfd) GROUP BY path")
def sc7_normalize_paths(spark, d):
    return fx.procfd(spark, d).groupBy(scripts.normalize_path(F.col("path"), [("/CHOS", ""), ("/global/projectb", "/pb")]).alias("path")).agg(F.count("*").alias("n"))


@query("SELECT split_part(path, ':', 1) AS protocol, CAST(split_part(path, ':', 3) AS BIGINT) AS localPort, split_part(path, ':', 4) AS remoteAddress, count(*) AS n FROM procfd WHERE regexp_matches(path, '^(tcp|udp):') GROUP BY ALL")
def sc8_connection_text(spark, d):
    rows = fx.procfd(spark, d).where(F.col("path").rlike("^(tcp|udp):")).select(text.connection(F.col("path")).alias("c"))
    return rows.groupBy("c.protocol", "c.localPort", "c.remoteAddress").agg(F.count("*").alias("n"))


@query(f"SELECT inode, {_IP('la')} AS ip FROM netstat")
def sc9_ipv4(spark, d):
    return fx.netstat(spark, d).select("inode", text.ipv4(F.col("local_address")).alias("ip"))


@query("SELECT event_id, round(recTime + recTimeUSec / 1e6, 6) AS t FROM procstat")
def sc10_seconds(spark, d):
    return fx.procstat(spark, d).select("event_id", F.round(text.seconds(F.col("recTime"), F.col("recTimeUSec")), 6).alias("t"))


@query("SELECT mode & 256 != 0 AS r, mode & 128 != 0 AS w, count(*) AS n FROM procfd GROUP BY ALL")
def sc11_mode_bits(spark, d):
    return fx.procfd(spark, d).groupBy(text.readable(F.col("mode")).alias("r"), text.writable(F.col("mode")).alias("w")).agg(F.count("*").alias("n"))


@query("SELECT CASE pid % 3 WHEN 0 THEN host WHEN 1 THEN host || 'b' END AS short, count(*) AS n FROM procstat GROUP BY 1")
def sc12_short_host(spark, d):
    full = F.when(F.col("pid") % 3 == 0, F.concat("host", F.lit(".a.example"))).when(F.col("pid") % 3 == 1, F.concat("host", F.lit("b-ib.b.example"))).otherwise(F.lit("elsewhere"))
    return fx.procstat(spark, d).groupBy(text.short_host(full, r"^([a-z0-9]+)[.]a[.]example$", r"^([a-z0-9]+)-ib[.]b[.]example$").alias("short")).agg(F.count("*").alias("n"))


@query("SELECT rsspeak, CASE WHEN rsspeak < 1e3 THEN printf('%.2f B', rsspeak / 1.0) WHEN rsspeak < 1e6 THEN printf('%.2f KB', rsspeak / 1e3) WHEN rsspeak < 1e9 THEN printf('%.2f MB', rsspeak / 1e6) WHEN rsspeak < 1e12 THEN printf('%.2f GB', rsspeak / 1e9) ELSE printf('%.2f TB', rsspeak / 1e12) END AS size FROM (SELECT rsspeak + 1234 AS rsspeak FROM summary)")
def sc13_sizes(spark, d):
    return fx.summary(spark, d).withColumn("rsspeak", F.col("rsspeak") + 1234).select("rsspeak", text.size_1000(F.col("rsspeak")).alias("size"))


@query("SELECT event_id, printf('%02d:%02d:%02d.%04d', s // 3600, s // 60 % 60, s % 60, recTimeUSec // 100) AS age FROM (SELECT *, recTime - startTime AS s FROM procstat)")
def sc14_elapsed(spark, d):
    # whole parts of microseconds, so that no rounding of doubles can differ
    return fx.procstat(spark, d).select("event_id", text.elapsed((F.col("recTime") - F.col("startTime")).cast("decimal(20,6)") + (F.col("recTimeUSec").cast("decimal(20,6)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(20,6)")).alias("age"))


@query("SELECT event_id, replace(cmdArgs, '|', ' ') AS args FROM procdata")
def sc15_spaced(spark, d):
    return fx.procdata(spark, d).select("event_id", text.spaced(F.col("cmdArgs")).alias("args"))


@query("SELECT event_id, identifier AS job, CASE WHEN pid % 2 = 0 THEN subidentifier ELSE '*' END AS task FROM procstat")
def sc16_job_text(spark, d):
    written = F.when(F.col("pid") % 2 == 0, F.concat_ws(".", "identifier", "subidentifier")).otherwise(F.col("identifier"))
    return fx.procstat(spark, d).select("event_id", text.job_text(written).alias("j")).select("event_id", "j.*")


@query("SELECT event_id, host, identifier, subidentifier, 'procstat' AS type FROM procstat")
def sc17_topic(spark, d):
    return fx.procstat(spark, d).select("event_id", text.topic(F.concat_ws(".", "host", "identifier", "subidentifier", F.lit("procstat"))).alias("t")).select("event_id", "t.*")


@query("SELECT strftime(day, '%Y%m%d') AS day, count(*) AS n FROM summary GROUP BY 1")
def sc18_date_keys(spark, d):
    return fx.summary(spark, d).groupBy(text.date_key(F.col("day")).alias("day")).agg(F.count("*").alias("n"))


# --- 2.9 streaming, batch forms ---


@query("SELECT date_trunc('hour', ts) AS hour, host, event_type AS type, count(*) AS n FROM ctx GROUP BY ALL")
def str9_feed_counts(spark, d):
    rows = fx._events(spark, d).select(F.col("ts").cast("timestamp_ntz").alias("ts"), "host", F.col("event_type").alias("type"))
    return live.feed_counts(rows)


@query(f"SELECT host, identifier, subidentifier, max(recTime) AS recTime, count(*) AS n FROM procstat GROUP BY host, identifier, subidentifier HAVING max(recTime) >= {NOW + 1_000_000}")
def str4_latest(spark, d):
    return live.latest(fx.procstat(spark, d), ("host", "identifier", "subidentifier"), NOW + 1_000_300)


@query("SELECT s.event_id, s.utime, d.exePath FROM procstat s JOIN procdata d ON s.host = d.host AND s.pid = d.pid AND s.startTime = d.startTime AND s.recTime = d.recTime AND s.recTimeUSec = d.recTimeUSec")
def str6_stat_with_data(spark, d):
    data = fx.procdata(spark, d).select(*PROCESS, *TIME, "exePath")
    return fx.procstat(spark, d).join(data, [*PROCESS, *TIME]).select("event_id", "utime", "exePath")


QUERIES |= records.QUERIES | streams.QUERIES
ORACLE_SQL |= records.ORACLE_SQL | streams.ORACLE_SQL
