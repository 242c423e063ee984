"""Queries of sources, sinks, job reports, trees and categories that write what they read back, with DuckDB SQL for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import categories
from ..operators import clean, jobs, report, summary, tree
from ..schemas import PROCESS, PROCSTAT_FIELDS, TIME
from ..sources import shared, sinks, tables
from . import fixtures as fx
from .streams import _COARSE, _FD_ROWS, _KEPT, _coarse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
ORDER = (*TIME, "event_id")
NOW = 1_705_000_000


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = fx.SQL + sql
        return f

    return register


# --- sources ---


@query("SELECT job, task, user, project FROM jobs")
def src4_job_files(spark, d):
    path = shared.new_folder(spark, "jobs")
    fx.jobs(spark, d).select(F.concat(F.lit(" "), "job"), "task", F.concat("user", F.lit("  ")), "project").write.csv(path)
    return tables.jobs(spark, path, 4)


@query("SELECT host, pid, recTime, utime FROM procstat")
def src7_process_log(spark, d):
    path = shared.new_folder(spark, "log")
    at = F.date_format(F.timestamp_seconds("recTime"), "yyyy-MM-dd HH:mm:ss")
    fx.procstat(spark, d).select(at, "host", "pid", "utime").write.csv(path)
    rows = tables.process_log(spark, path, ("time", "host", "pid", "utime"))
    return rows.select("host", F.col("pid").cast("long").alias("pid"), F.unix_timestamp("time").alias("recTime"), F.col("utime").cast("long").alias("utime"))


@query(f"SELECT host, pid, recTime, event_id FROM procstat WHERE recTime BETWEEN {NOW - 864_000} AND {NOW} AND host IN ('h1', 'h3')")
def src1_raw_tables(spark, d):
    path = shared.new_folder(spark, "raw")
    fx.procstat(spark, d).write.parquet(path)
    return tables.raw(spark, path, NOW - 864_000, NOW, ("h1", "h3")).select("host", "pid", "recTime", "event_id")


# --- sinks ---


@query("SELECT strftime(make_timestamp(recTime * 1000000), '%Y%m%d') AS date, CAST(recTime // 3600 % 24 AS INT) AS hour, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM procstat GROUP BY ALL")
def snk1_hourly_tables(spark, d):
    path = shared.new_folder(spark, "hourly")
    sinks.hourly(fx.procstat(spark, d), path, most=1000)
    rows = spark.read.parquet(path)
    return rows.groupBy(F.col("date").cast("string").alias("date"), "hour").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


_CODE = f"CASE WHEN pid < 1 OR pid > 1000000 THEN 1 WHEN ppid > 1000000 THEN 2 WHEN startTime = 0 OR startTime > {NOW} THEN 3 WHEN recTime = 0 OR recTime > {NOW} THEN 4 ELSE 0 END"


@query(f"SELECT {_CODE} AS bad_code, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM procstat GROUP BY 1")
def snk2_two_outputs(spark, d):
    good, bad = shared.new_folder(spark, "good"), shared.new_folder(spark, "bad")
    sinks.good_and_bad(fx.procstat(spark, d), clean.stat_code(NOW), good, bad)
    both = spark.read.parquet(good).select("event_id", F.lit(0).alias("bad_code")).unionByName(spark.read.parquet(bad).select("event_id", "bad_code"))
    return both.groupBy("bad_code").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("""SELECT 'process' AS name, count(*) AS n FROM (SELECT DISTINCT host, startTime, pid FROM procstat) UNION ALL SELECT 'connection', count(*) FROM (SELECT DISTINCT host, startTime, pid, path FROM procfd WHERE path LIKE 'tcp:%' OR path LIKE 'udp:%')
  UNION ALL SELECT 'filesystem', count(*) FROM (SELECT DISTINCT host, startTime, pid FROM procfd WHERE path LIKE '%/global/%')""")
def snk3_summary_tables(spark, d):
    path, fd = shared.new_folder(spark, "summaries"), fx.procfd(spark, d)
    parts = {"process": summary.summarize(fx.procstat(spark, d), order=ORDER), "filesystem": summary.filesystem_use(fd, [("global", ".*/global/.*")]), "connection": summary.connections(fd)}
    sinks.summaries(parts, path)
    counts = [spark.read.parquet(f"{path}/{name}").agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name in parts]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("SELECT count(*) AS n, CAST(sum(duration) AS BIGINT) AS duration, true AS in_parts FROM summary")
def snk4_parts(spark, d):
    path = shared.new_folder(spark, "parts")
    sinks.in_parts(fx.summary(spark, d), path, 5000)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count("*").alias("n"), F.sum("duration").alias("duration"))
    return files.agg(F.sum("n").alias("n"), F.sum("duration").alias("duration"), (F.max("n") <= 5000).alias("in_parts"))


_DAY = "strftime(make_timestamp(recTime * 1000000), '%Y%m%d')"
_AGAIN = "NOT (state = 'R' AND recTime // 86400 % 2 = 0) AND NOT (state = 'D' AND event_id % 3 = 0)"


@query(f"""SELECT date, type, stored, new, CASE WHEN new = 0 THEN 'kept' WHEN stored = new THEN 'equal' ELSE 'written' END AS action, CASE WHEN new = 0 THEN stored ELSE new END AS now, CAST(CASE WHEN new = 0 THEN old_ids ELSE new_ids END AS BIGINT) AS ids FROM (
  SELECT {_DAY} AS date, state AS type, count(*) AS stored, count(*) FILTER ({_AGAIN}) AS new, sum(event_id) AS old_ids, sum(event_id) FILTER ({_AGAIN}) AS new_ids FROM procstat GROUP BY ALL)""")
def snk5_deposit(spark, d):
    """Deposited twice; the second time some parts are missing, some smaller and the rest equal."""
    path = shared.new_folder(spark, "deposit")
    rows = sinks.by_hour(fx.procstat(spark, d)).select("date", F.col("state").alias("type"), "host", "pid", "event_id", "recTime")
    sinks.deposit(rows, path)
    again = rows.where(~((F.col("type") == "R") & (F.floor(F.col("recTime") / 86_400) % 2 == 0)) & ~((F.col("type") == "D") & (F.col("event_id") % 3 == 0)))
    found = sinks.deposit(again, path)
    now = spark.read.schema(rows.schema).parquet(path).groupBy("date", "type").agg(F.count("*").alias("now"), F.sum("event_id").alias("ids"))
    return found.join(now, ["date", "type"])


@query("SELECT 'busy' AS name, host, pid, utime FROM procstat WHERE utime > 20000 UNION ALL SELECT 'late', host, pid, utime FROM procstat WHERE recTime > 1706000000")
def snk6_delimited(spark, d):
    path, rows = shared.new_folder(spark, "delimited"), fx.procstat(spark, d)
    wanted = {"busy": rows.where("utime > 20000"), "late": rows.where("recTime > 1706000000")}
    sinks.delimited({name: rows.select("host", "pid", "utime") for name, rows in wanted.items()}, path, "|")
    back = [spark.read.csv(f"{path}/{name}", header=True, sep="|", schema="host string, pid long, utime long").select(F.lit(name).alias("name"), "*") for name in wanted]
    return back[0].unionByName(back[1])


_ARRAYS = {"ps": ("recTime", "recTimeUSec", "utime", "stime"), "fd": ("recTime", "fd", "path", "mode"), "obs": ("recTime", "recTimeUSec")}


def _joined(name: str, columns) -> str:
    return f"md5(coalesce(string_agg(concat_ws(' ', {', '.join(columns)}), ';' ORDER BY {', '.join(columns)}), '')) AS {name}, count({columns[0]}) AS n_{name}"


@query(f"""SELECT * FROM (SELECT host, startTime, pid, {_joined('ps', ('recTime', 'recTimeUSec', 'utime', 'stime'))}, min(identifier) AS identifier FROM procstat GROUP BY host, startTime, pid)
  FULL JOIN (SELECT host, startTime, pid, {_joined('fd', ('recTime', 'fd', 'path', 'mode'))} FROM procfd GROUP BY host, startTime, pid) USING (host, startTime, pid)
  FULL JOIN (SELECT host, startTime, pid, {_joined('obs', ('recTime', 'recTimeUSec'))} FROM procstat WHERE state != 'D' GROUP BY host, startTime, pid) USING (host, startTime, pid)""".replace("SELECT * FROM", "SELECT host, startTime, pid, identifier, coalesce(ps, md5('')) AS ps, coalesce(n_ps, 0) AS n_ps, coalesce(fd, md5('')) AS fd, coalesce(n_fd, 0) AS n_fd, coalesce(obs, md5('')) AS obs, coalesce(n_obs, 0) AS n_obs FROM"))
def snk7_job_report(spark, d):
    """Written as JSON and read back; the arrays' contents are compared by digest."""
    stat, path = fx.procstat(spark, d), shared.new_folder(spark, "report")
    rows = jobs.nested(stat, fx.procfd(spark, d), clean.observations(stat.where("state != 'D'")))
    sinks.json(rows, path)
    back = spark.read.schema(rows.schema).json(path)

    def text(name):
        chosen = F.array_sort(F.transform(name, lambda x: F.struct(*[x[c].alias(c) for c in _ARRAYS[name]])))
        return F.md5(F.array_join(F.transform(chosen, lambda x: F.concat_ws(" ", *[x[c].cast("string") for c in _ARRAYS[name]])), ";")).alias(name)

    return back.select(*PROCESS, "identifier", *[c for name in _ARRAYS for c in (text(name), F.size(name).cast("long").alias(f"n_{name}"))])


@query("SELECT count(*) AS n, 0::BIGINT AS out_of_order FROM procstat")
def srt1_canonical_order(spark, d):
    path = shared.new_folder(spark, "sorted")
    sinks.sorted_by_process(fx.procstat(spark, d).repartition(4, "host")).withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}).write.parquet(path)
    keys = F.struct("identifier", "subidentifier", "startTime", "pid", *TIME)
    before = F.lag(keys).over(Window.partitionBy("part", F.floor(F.col("at") / 100_000)).orderBy("at"))
    return spark.read.parquet(path).select((before > keys).alias("wrong")).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("wrong").cast("long")), F.lit(0)).alias("out_of_order"))


# --- collapse by the comparisons of each record type ---


@query(_KEPT.format(hour=""))
def win3_collapse_procstat(spark, d):
    return clean.collapse_records(_coarse(spark, d), "procstat").select("event_id", "host", "pid", "recTime", "state", "utime")


@query("SELECT event_id, host, pid, recTime, exePath FROM (SELECT *, lead((ppid, startTime, cmdArgs, exePath)) OVER w AS later, lead(1) OVER w AS has FROM procdata WINDOW w AS (PARTITION BY host, pid ORDER BY recTime, recTimeUSec, event_id)) WHERE has IS NULL OR later IS DISTINCT FROM (ppid, startTime, cmdArgs, exePath)")
def win3_collapse_procdata(spark, d):
    return clean.collapse_records(fx.procdata(spark, d), "procdata").select("event_id", "host", "pid", "recTime", "exePath")


@query(f"SELECT host, pid, fd, recTime, path FROM (SELECT *, lead((startTime, path, mode)) OVER w AS later, lead(1) OVER w AS has FROM ({_FD_ROWS}) WINDOW w AS (PARTITION BY host, pid, fd ORDER BY recTime)) WHERE has IS NULL OR later IS DISTINCT FROM (startTime, path, mode)")
def win3_collapse_procfd(spark, d):
    rows = fx.procfd(spark, d).groupBy("host", "pid", "fd", "recTime").agg(F.min("startTime").alias("startTime"), F.min("mode").alias("mode"), F.min(F.regexp_replace("path", "[0-9]", "")).alias("path"))
    return clean.collapse_records(clean.limit_fds(rows, 5), "procfd").select("host", "pid", "fd", "recTime", "path")


# --- jobs, trees, ranking ---

_HAVE = ("utime", "stime", "io_rchar", "io_wchar", "m_size", "m_resident", "numThreads", "realUid", "state")
_CARRIED_SQL = ", ".join(f"arg_max({n}, (recTime, recTimeUSec, event_id)) FILTER (undamaged) AS {n}" if n in _HAVE else f"CAST({'18446744073709551615' if n == 'rsslim' else 0} AS {'DECIMAL(20,0)' if t.startswith('dec') else 'BIGINT'}) AS {n}" for n, t in PROCSTAT_FIELDS if n in summary.CARRIED)


@query(f"SELECT host, startTime, pid, count(*) AS nRecords, {_CARRIED_SQL} FROM rated GROUP BY host, startTime, pid")
def agg1_carried_columns(spark, d):
    from .catalog import _wide_stat

    rows = _wide_stat(spark, d).join(fx.procstat(spark, d).select(*PROCESS, *TIME, "utime", "event_id"), [*PROCESS, *TIME, "utime"])
    return summary.summarize(rows, order=ORDER).select(*PROCESS, "nRecords", *summary.CARRIED)


def _corr(a: str, b: str) -> str:
    n, varies = f"count({a} + {b})", lambda x: f"sum({x} * {x}) - sum({x}) * sum({x}) / count({a} + {b}) > 1e-9 * sum({x} * {x})"
    return f"CASE WHEN {n} >= 2 AND {varies(a)} AND {varies(b)} THEN round(corr({a}, {b}), 4) + 0 END AS {a[:-4]}_{b[:-4]}"


_PAIRS = [(a, b) for i, a in enumerate(summary.SERIES) for b in summary.SERIES[i + 1 :]]


@query(f"SELECT host, startTime, pid, {', '.join(_corr(a, b) for a, b in _PAIRS)} FROM rated GROUP BY host, startTime, pid")
def agg5_all_correlations(spark, d):
    out = summary.summarize(fx.procstat(spark, d), order=ORDER)
    return out.select(*PROCESS, *[(F.round(f"cor_{a[:-4]}X{b[:-4]}", 4) + 0).alias(f"{a[:-4]}_{b[:-4]}") for a, b in _PAIRS])


@query("""SELECT source, c.identifier, c.host, first_time, last_time, n_times, n_processes, largest_gap, 'procstat' AS kind FROM (SELECT identifier, host, recTime // 86400 AS source, min(recTime) AS first_time, max(recTime) AS last_time, count(DISTINCT recTime) AS n_times, count(DISTINCT (pid, startTime)) AS n_processes FROM procstat GROUP BY ALL) c
  JOIN (SELECT identifier, host, source, coalesce(max(g), 0) AS largest_gap FROM (SELECT identifier, host, recTime // 86400 AS source, recTime - lag(recTime) OVER (PARTITION BY identifier, host, recTime // 86400 ORDER BY recTime) AS g FROM (SELECT DISTINCT identifier, host, recTime FROM procstat)) GROUP BY ALL) USING (identifier, host, source)""")
def agg18_coverage_by_source(spark, d):
    return jobs.coverage(fx.procstat(spark, d).withColumn("source", F.floor(F.col("recTime") / 86_400)), "procstat", per_source="source")


@query("""SELECT p.host, p.startTime, p.pid, CAST(max(CASE WHEN c.pid IS NULL THEN 0 ELSE 1 END) AS INT) AS isParent FROM (SELECT DISTINCT host, startTime, pid FROM procstat) p LEFT JOIN (
  SELECT c.host, c.pid, c.ppid, max(q.startTime) AS parentStart FROM (SELECT DISTINCT host, startTime, pid, ppid FROM procstat) c JOIN (SELECT DISTINCT host, startTime, pid FROM procstat) q ON q.host = c.host AND q.pid = c.ppid AND q.startTime <= c.startTime GROUP BY c.host, c.pid, c.startTime, c.ppid) c
  ON c.host = p.host AND c.ppid = p.pid AND c.parentStart = p.startTime GROUP BY ALL""")
def jn9_parents_in_time(spark, d):
    rows = fx.procstat(spark, d).select(*PROCESS, "ppid").distinct()
    return tree.flag_parents(rows, time_aware=True).select(*PROCESS, "isParent")


@query("""SELECT job_row, count(*) AS n, CAST(max(r.utime) AS BIGINT) AS utime FROM job_intervals j JOIN procstat r ON j.host = r.host AND j.job = r.identifier AND j.task = r.subidentifier AND r.recTime BETWEEN j.start AND j.stop
  WHERE j.start BETWEEN 1705017600 AND 1705190400 GROUP BY job_row""")
def jn12_pruned_records(spark, d):
    """Jobs that began in a span of two days, against records stored by date and hour."""
    path, stat = shared.new_folder(spark, "stored"), fx.procstat(spark, d)
    sinks.hourly(stat, path)
    files = tables.intervals(stat.select(F.date_trunc("hour", F.timestamp_seconds("recTime")).alias("recording_start")).distinct().withColumn("path", F.date_format("recording_start", "yyyyMMddHH")))
    stored = spark.read.schema(stat.schema.add("date", "string").add("hour", "integer")).parquet(path)
    wanted = fx.job_intervals(spark, d).where(F.col("start").between(1_705_017_600, 1_705_190_400))
    return jobs.with_stored_records(wanted, stored, files).groupBy("job_row").agg(F.count("*").alias("n"), F.max("utime").alias("utime"))


_LIVE_SQL = {"duration": "duration", "vmem": "vsize", "rss": "rss", "host": "host", "user": "user", "cpu": "cpu_rate", "mpi_rank": "mpi_rank", "pid": "pid", "ppid": "ppid", "threads": "numThreads", "io_read": "io_rchar", "io_write": "io_wchar", "age": "age"}
_LIVE = """live AS (SELECT host, startTime, pid, arg_max((ppid, realUid, m_size, m_resident, numThreads, io_rchar, io_wchar, recTime, utime + stime), (recTime, recTimeUSec, event_id)) AS r FROM procstat GROUP BY host, startTime, pid), shown AS (
  SELECT host, startTime, pid, r[1] AS ppid, name AS user, r[3] AS vsize, r[4] AS rss, r[5] AS numThreads, r[6] AS io_rchar, r[7] AS io_wchar, r[8] - startTime AS duration, 1710000000 - r[8] AS age, r[9] // 100 AS cpu_rate, pid % 16 AS mpi_rank FROM live LEFT JOIN users ON r[2] = uid)"""
_RANKS = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{key}' AS key, {up} AS ascending, CAST(row_number() OVER (ORDER BY {c} {'ASC' if up == 'true' else 'DESC'} NULLS LAST, host, startTime, pid) AS INT) AS rank, host, startTime, pid FROM shown) WHERE rank <= 10" for key, c in _LIVE_SQL.items() for up in ("true", "false")
)


@query(f", {_LIVE} {_RANKS}")
def srt3_all_rankings(spark, d):
    last = fx.procstat(spark, d).groupBy(*PROCESS).agg(F.max_by(F.struct("ppid", "realUid", "m_size", "m_resident", "numThreads", "io_rchar", "io_wchar", "recTime", (F.col("utime") + F.col("stime")).alias("cpu")), F.struct(*ORDER)).alias("r")).select(*PROCESS, "r.*")
    rows = jobs.attach_user(last, fx.users(spark, d), unknown=None).join(fx.users(spark, d).select(F.col("uid").alias("realUid"), F.lit(True).alias("known")), "realUid", "left").withColumn("user", F.when(F.col("known"), F.col("user")))
    path = shared.new_folder(spark, "live")
    rows.withColumns({"vsize": F.col("m_size"), "rss": F.col("m_resident"), "duration": F.col("recTime") - F.col("startTime"), "age": 1_710_000_000 - F.col("recTime"), "cpu_rate": F.expr("cpu div 100"), "mpi_rank": F.col("pid") % 16}).write.parquet(path)
    shown, out = spark.read.parquet(path), None
    for key in report.LIVE_KEYS:
        for up in (True, False):
            one = report.ranking(shown, key, 10, up).select(F.lit(key).alias("key"), F.lit(up).alias("ascending"), "rank", *PROCESS)
            out = one if out is None else out.unionByName(one)
    return out


@query(""", one AS (SELECT host, pid, min((startTime, ppid)) AS p FROM procstat GROUP BY host, pid), nodes AS (SELECT host, pid, p[1] AS startTime, p[2] AS ppid FROM one),
  lv(host, pid, level, path) AS (SELECT host, pid, 0, [(startTime, pid)] FROM nodes a WHERE NOT EXISTS (SELECT 1 FROM nodes b WHERE b.host = a.host AND b.pid = a.ppid) UNION ALL SELECT n.host, n.pid, l.level + 1, list_append(l.path, (n.startTime, n.pid)) FROM nodes n JOIN lv l ON n.host = l.host AND n.ppid = l.pid WHERE n.pid != n.ppid)
  SELECT host, pid, ppid, startTime, CAST(level AS INT) AS level, row_number() OVER (PARTITION BY host ORDER BY path NULLS LAST, startTime, pid) AS place FROM nodes LEFT JOIN lv USING (host, pid)""")
def srt5_tree_listing(spark, d):
    return tree.listing(fx.procstat(spark, d).select(*PROCESS, "ppid"), ("host",))


@query("""SELECT execCommand, command, CASE WHEN execCommand = 'PROMO BURNISHED COPPER' THEN 'category_PROMO' WHEN execCommand LIKE 'STANDARD %' OR execCommand LIKE 'SMALL %TIN' THEN 'category_plain' WHEN regexp_full_match(execCommand, '[A-Z]+ (POLISHED|PLATED) .*') THEN 'category_shiny' ELSE 'category_rest' END AS category, count(*) AS n FROM summary GROUP BY ALL""")
def sc6_category_files(spark, d):
    """A file of columns, as a spreadsheet has it, with names first."""
    path = shared.new_folder(spark, "categories")
    lines = ["PROMO,plain,shiny,empty", "PROMO BURNISHED COPPER,STANDARD .*,[A-Z]+ (POLISHED|PLATED) .*,", ", SMALL .*TIN,,", ",,,"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    rows = categories.generalize(fx.summary(spark, d), "execCommand", categories.load(spark, path, transposed=True), other="rest", name="category")
    return rows.groupBy("execCommand", "command", "category").agg(F.count("*").alias("n"))
