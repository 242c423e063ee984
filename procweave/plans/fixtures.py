"""Record tables derived from the driver's tables, once in DataFrame operations and once in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUCKET = 432_000
#: Rows of a task that joins, about, where the session's shuffle partitions would be larger by half.
SHARE = 1_000_000


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def micros(ts: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast({ts} as timestamp_ntz))")


def whole(x: Column) -> Column:
    return F.floor(x).cast("long")


def _events(spark: SparkSession, d: str) -> DataFrame:
    us = micros("ts")
    pid = F.col("user_id") + 1
    return table(spark, d, "events").select(
        "event_id", pid.alias("pid"), "value", "event_type", "ts", us.alias("us"),
        F.concat(F.lit("h"), (pid % 5).cast("string")).alias("host"), F.concat(F.lit("j"), (pid % 7).cast("string")).alias("identifier"), F.lit("1").alias("subidentifier"),
        F.when(pid < 5, 0).otherwise(5 * whole(whole(pid / 5.0) / 2.0) + pid % 5).cast("long").alias("ppid"),
        whole(us / 1000000.0).alias("recTime"), (us % 1000000).alias("recTimeUSec"), (whole(us / 432000000000.0) * BUCKET).alias("startTime"),
    )


def procstat(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("pid", "startTime").orderBy("recTime", "recTimeUSec", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    run = lambda x: F.sum(x).over(w)
    kind = F.col("event_type")
    return _events(spark, d).select(
        "event_id", "host", "identifier", "subidentifier", "pid", "ppid", "recTime", "recTimeUSec", "startTime",
        (run(whole(F.col("value") * 10)) - F.when(F.col("event_id") % 97 == 0, 500).otherwise(0)).alias("utime"),
        run(whole(F.col("value"))).alias("stime"),
        run(F.when(kind.isin("view", "click"), whole(F.col("value") * 1000)).otherwise(0)).alias("io_rchar"),
        run(F.when(kind == "purchase", whole(F.col("value") * 1000)).otherwise(0)).alias("io_wchar"),
        whole(F.col("value") * 4096).alias("m_size"), whole(F.col("value") * 1024).alias("m_resident"),
        (1 + F.col("event_id") % 4).alias("numThreads"), (F.col("pid") - 1).alias("realUid"),
        F.when(kind.isin("click", "signup"), "R").when(kind.isin("view", "purchase"), "S").otherwise("D").alias("state"),
    )


EXE = ("/usr/bin/python2.7", "/usr/bin/perl", "/bin/bash", "/usr/bin/java", "/usr/common/tools/blastall", "/house/tools/bin/samtools", "/usr/bin/ruby1.9", "/bin/tcsh")
ARGS = ("python|-u|-W|ignore|/home/u/run.py|x", "perl|-e|print 1", "bash|--rcfile|/etc/rc|/opt/jobs/sgeJob77.sh", "java|-cp|a.jar|-Xmx1g|org.tool.Main", "blastall|-p|blastn", "samtools|view|-b", "ruby|-I|lib|tool.rb", "tcsh|-b|start.csh")


def _pick(values: tuple[str, ...]) -> Column:
    return F.get(F.array(*map(F.lit, values)), (F.col("pid") % 8).cast("int"))


def procdata(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).select("event_id", "host", "identifier", "subidentifier", "pid", "ppid", "recTime", "recTimeUSec", "startTime", _pick(EXE).alias("execName"), _pick(ARGS).alias("cmdArgs"), F.when(F.col("event_type") == "error", "Unknown").otherwise(_pick(EXE)).alias("exePath"), F.lit("/tmp").alias("cwdPath"))


def procfd(spark: SparkSession, d: str) -> DataFrame:
    n_users = table(spark, d, "events").agg(F.count_distinct("user_id").alias("n")).first()["n"]
    rows = table(spark, d, "lineitem")
    part, supp, line = F.col("l_partkey").cast("string"), F.col("l_suppkey"), F.col("l_linenumber")
    pid = 1 + F.col("l_partkey") % n_users
    paths = (F.concat(F.lit("/global/projectb/a/"), part), F.concat(F.lit("/chos/global/project/p/"), part), F.concat(F.lit("/scratch/t/"), part), F.concat(F.lit("tcp:10.0.0.1:"), (1024 + F.col("l_partkey") % 50).cast("string"), F.lit(":10.1.0."), (supp % 200).cast("string"), F.lit(":443")), F.concat(F.lit("udp:10.0.0.1:"), (2000 + F.col("l_partkey") % 50).cast("string"), F.lit(":10.2.0."), (supp % 200).cast("string"), F.lit(":53")), F.concat(F.lit("socket:["), part, F.lit("]")))
    start = ((3944 + supp % 7) * BUCKET).cast("long")
    path = F.lit(None).cast("string")
    for i, p in enumerate(paths):
        path = F.when(line % 6 == i, p).otherwise(path)
    return rows.select(F.concat(F.lit("h"), (pid % 5).cast("string")).alias("host"), pid.alias("pid"), start.alias("startTime"), (start + 1 + F.col("l_orderkey") % 86400).alias("recTime"), F.lit(0).cast("long").alias("recTimeUSec"), (2 + line).cast("long").alias("fd"), F.when(F.col("l_returnflag") == "N", 41408).when(F.col("l_linestatus") == "O", 41280).otherwise(41152).cast("long").alias("mode"), path.alias("path"), F.lit(0).cast("long").alias("ppid"))


def _in_shares(left: DataFrame, right: DataFrame, a: str, b: str, shares: int) -> DataFrame:
    """An inner join, by as many shares of both sides as given (0: Spark's own number)."""
    if shares:
        left, right = left.repartition(shares, a), right.repartition(shares, b)
    return left.join(right, F.col(a) == F.col(b))


def summary(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    n = t("lineitem").count()  # read from the ends of the files
    shares = n // SHARE + 1 if n > 3 * SHARE // 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) else 0
    rows = _in_shares(t("lineitem"), t("orders"), "l_orderkey", "o_orderkey", shares)
    rows = _in_shares(rows, t("customer"), "o_custkey", "c_custkey", shares)
    rows = _in_shares(rows, t("part"), "l_partkey", "p_partkey", shares)
    rows = rows.join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    first = F.col("l_linenumber") == 1
    price = F.col("l_extendedprice")
    return rows.select(
        F.col("s_name").alias("host"), whole(micros("o_orderdate") / 1000000.0).alias("startTime"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pid"), F.col("c_name").alias("user"), F.col("c_mktsegment").alias("project"), F.concat("p_name", F.when(first, " (deleted)").otherwise("")).alias("command"), F.col("p_type").alias("execCommand"), first.cast("int").alias("isParent"),
        whole(F.col("l_quantity")).alias("nRecords"), (50 + F.col("l_linenumber")).cast("long").alias("nObservations"), whole(price * 10).alias("utime_net"), whole(F.col("l_quantity") * 7).alias("stime_net"), whole(F.col("l_quantity") * 2000).alias("duration"), whole(price * 1000).alias("io_rchar_net"), (1 + F.col("l_linenumber")).cast("long").alias("numThreads"), whole(price * 100000).alias("rsspeak"), F.col("o_orderdate").alias("day"),
    )


def jobs(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.concat(F.lit("j"), F.col("n_nationkey").cast("string")).alias("job"), F.lit("1").alias("task"), F.col("n_name").alias("user"), F.col("n_name").alias("project"), F.col("n_nationkey").cast("long").alias("line_no")).where("line_no != 6")
    again = n.where("line_no < 3").withColumns({"project": F.concat(F.lit("LATE_"), "project"), "line_no": F.col("line_no") + 100})
    return n.unionByName(again)


def users(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").where("c_custkey % 3 != 0").select(F.col("c_custkey").alias("uid"), F.col("c_name").alias("name"))


def netstat(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("p_partkey")
    hosts = F.explode(F.array(*[F.lit(f"h{i}") for i in range(5)]))
    return table(spark, d, "part").where("p_partkey % 2 = 0").select(key.alias("inode"), (key % 3).alias("type"), (key * 16777 + 10).alias("local_address"), (1000 + key % 100).alias("local_port"), (key * 65793 + 7).alias("remote_address"), (2000 + key % 100).alias("remote_port"), hosts.alias("host"))


def hours(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.date_trunc("hour", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz").alias("recording_start")).distinct().where("hour(recording_start) % 5 != 3").select(F.date_format("recording_start", "yyyyMMddHH").alias("path"), "recording_start", F.hour("recording_start").cast("long").alias("n_writes"))


def job_intervals(spark: SparkSession, d: str) -> DataFrame:
    start = (whole(F.col("o_orderkey") * 7919 % 2592000) + 1704067200).cast("long")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("job_row"), F.concat(F.lit("h"), (F.col("o_custkey") % 5).cast("string")).alias("host"), F.concat(F.lit("j"), (F.col("o_custkey") % 7).cast("string")).alias("job"), F.lit("1").alias("task"), start.alias("start"), (start + F.col("o_orderkey") % 20 * 3600).alias("end"))


def _case(values: tuple[str, ...]) -> str:
    return "CASE pid % 8 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


SQL = f"""
WITH RECURSIVE ev AS (
  SELECT event_id, user_id + 1 AS pid, value, event_type, ts, epoch_us(ts) AS us FROM events
), ctx AS (
  SELECT *, 'h' || (pid % 5) AS host, 'j' || (pid % 7) AS identifier, '1' AS subidentifier,
    CAST(CASE WHEN pid < 5 THEN 0 ELSE 5 * CAST(floor(floor(pid / 5.0) / 2.0) AS BIGINT) + pid % 5 END AS BIGINT) AS ppid,
    us // 1000000 AS recTime, us % 1000000 AS recTimeUSec, (us // 432000000000) * {BUCKET} AS startTime FROM ev
), procstat AS (
  SELECT event_id, host, identifier, subidentifier, pid, ppid, recTime, recTimeUSec, startTime,
    CAST(sum(CAST(floor(value * 10) AS BIGINT)) OVER w AS BIGINT) - CASE WHEN event_id % 97 = 0 THEN 500 ELSE 0 END AS utime,
    CAST(sum(CAST(floor(value) AS BIGINT)) OVER w AS BIGINT) AS stime,
    CAST(sum(CASE WHEN event_type IN ('view', 'click') THEN CAST(floor(value * 1000) AS BIGINT) ELSE 0 END) OVER w AS BIGINT) AS io_rchar,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(floor(value * 1000) AS BIGINT) ELSE 0 END) OVER w AS BIGINT) AS io_wchar,
    CAST(floor(value * 4096) AS BIGINT) AS m_size, CAST(floor(value * 1024) AS BIGINT) AS m_resident,
    1 + event_id % 4 AS numThreads, pid - 1 AS realUid,
    CASE WHEN event_type IN ('click', 'signup') THEN 'R' WHEN event_type IN ('view', 'purchase') THEN 'S' ELSE 'D' END AS state
  FROM ctx WINDOW w AS (PARTITION BY pid, startTime ORDER BY recTime, recTimeUSec, event_id ROWS UNBOUNDED PRECEDING)
), procdata AS (
  SELECT event_id, host, identifier, subidentifier, pid, ppid, recTime, recTimeUSec, startTime,
    {_case(EXE)} AS execName, {_case(ARGS)} AS cmdArgs, CASE WHEN event_type = 'error' THEN 'Unknown' ELSE {_case(EXE)} END AS exePath FROM ctx
), fd0 AS (
  SELECT l.*, 1 + l_partkey % (SELECT count(DISTINCT user_id) FROM events) AS pid, CAST((3944 + l_suppkey % 7) * {BUCKET} AS BIGINT) AS startTime FROM lineitem l
), procfd AS (
  SELECT 'h' || (pid % 5) AS host, pid, startTime, startTime + 1 + l_orderkey % 86400 AS recTime, 0 AS recTimeUSec, CAST(2 + l_linenumber AS BIGINT) AS fd,
    CAST(CASE WHEN l_returnflag = 'N' THEN 41408 WHEN l_linestatus = 'O' THEN 41280 ELSE 41152 END AS BIGINT) AS mode,
    CASE l_linenumber % 6 WHEN 0 THEN '/global/projectb/a/' || l_partkey WHEN 1 THEN '/chos/global/project/p/' || l_partkey WHEN 2 THEN '/scratch/t/' || l_partkey
      WHEN 3 THEN 'tcp:10.0.0.1:' || (1024 + l_partkey % 50) || ':10.1.0.' || (l_suppkey % 200) || ':443'
      WHEN 4 THEN 'udp:10.0.0.1:' || (2000 + l_partkey % 50) || ':10.2.0.' || (l_suppkey % 200) || ':53' ELSE 'socket:[' || l_partkey || ']' END AS path, 0 AS ppid FROM fd0
), summary AS (
  SELECT s_name AS host, epoch_us(o_orderdate) // 1000000 AS startTime, l_orderkey * 10 + l_linenumber AS pid, c_name AS user, c_mktsegment AS project,
    p_name || CASE WHEN l_linenumber = 1 THEN ' (deleted)' ELSE '' END AS command, p_type AS execCommand, CAST(l_linenumber = 1 AS INT) AS isParent,
    CAST(floor(l_quantity) AS BIGINT) AS nRecords, CAST(50 + l_linenumber AS BIGINT) AS nObservations, CAST(floor(l_extendedprice * 10) AS BIGINT) AS utime_net,
    CAST(floor(l_quantity * 7) AS BIGINT) AS stime_net, CAST(floor(l_quantity * 2000) AS BIGINT) AS duration, CAST(floor(l_extendedprice * 1000) AS BIGINT) AS io_rchar_net,
    CAST(1 + l_linenumber AS BIGINT) AS numThreads, CAST(floor(l_extendedprice * 100000) AS BIGINT) AS rsspeak, o_orderdate AS day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
), repaired AS (
  SELECT * EXCLUDE (duration), greatest(duration, 0) AS duration, (utime_net + stime_net) / 100.0 AS cpu_net, coalesce((nRecords - 1) / nullif(nObservations, 0), 0) AS volatilityScore FROM summary
), jobs0 AS (
  SELECT 'j' || n_nationkey AS job, '1' AS task, n_name AS user, n_name AS project, CAST(n_nationkey AS BIGINT) AS line_no FROM nation WHERE n_nationkey != 6
), jobs AS (
  SELECT * FROM jobs0 UNION ALL SELECT job, task, user, 'LATE_' || project, line_no + 100 FROM jobs0 WHERE line_no < 3
), users AS (
  SELECT c_custkey AS uid, c_name AS name FROM customer WHERE c_custkey % 3 != 0
), netstat AS (
  SELECT p_partkey AS inode, p_partkey % 3 AS type, p_partkey * 16777 + 10 AS la, 1000 + p_partkey % 100 AS lp, p_partkey * 65793 + 7 AS ra, 2000 + p_partkey % 100 AS rp, h.host
  FROM part, (VALUES ('h0'), ('h1'), ('h2'), ('h3'), ('h4')) h(host) WHERE p_partkey % 2 = 0
), hours AS (
  SELECT DISTINCT strftime(date_trunc('hour', ts), '%Y%m%d%H') AS path, date_trunc('hour', ts) AS recording_start, hour(ts) AS n_writes FROM events WHERE hour(ts) % 5 != 3
), job_intervals AS (
  SELECT o_orderkey AS job_row, 'h' || (o_custkey % 5) AS host, 'j' || (o_custkey % 7) AS job, '1' AS task, o_orderkey * 7919 % 2592000 + 1704067200 AS start,
    o_orderkey * 7919 % 2592000 + 1704067200 + o_orderkey % 20 * 3600 AS stop FROM orders
), series AS (
  SELECT *, recTime + recTimeUSec / 1e6 AS t, lag(recTime + recTimeUSec / 1e6) OVER w AS t0, utime + stime - lag(utime + stime) OVER w AS dcpu, io_wchar - lag(io_wchar) OVER w AS dw, io_rchar - lag(io_rchar) OVER w AS dr,
    coalesce(utime >= lag(utime) OVER w, true) AS undamaged FROM procstat WINDOW w AS (PARTITION BY host, startTime, pid ORDER BY recTime, recTimeUSec, event_id)
), rated AS (
  SELECT *, dcpu / nullif(t - t0, 0) / 100.0 AS cpuRate, dw / nullif(t - t0, 0) AS iowRate, dr / nullif(t - t0, 0) AS iorRate,
    CASE WHEN t0 IS NOT NULL THEN CAST(m_size AS DOUBLE) END AS msizeRate, CASE WHEN t0 IS NOT NULL THEN CAST(m_resident AS DOUBLE) END AS mresidentRate FROM series
)
"""
