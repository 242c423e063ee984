"""Small cases for decisions that the driver's tables do not show, sinks, and streams that end."""

import pytest
from pyspark.sql import functions as F

from procweave.functions import scripts, text
from procweave.operators import clean, report, summary, tree, workload
from procweave.sources import messages, sinks, tables
from procweave.streaming import live


def values(spark, expression, **columns):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()]).select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("exe", "args", "want"),
    [
        ("/usr/bin/python3", "python3|-c|print()", "COMMAND"),
        ("/usr/bin/python3", "python3|-Wc|x", "COMMAND"),
        ("/usr/bin/python3", "python3|-m|pkg|run.py", "run.py"),
        ("/usr/bin/perl", "perl|-ne|x", "COMMAND"),
        ("/bin/sh", "sh|-x|/a/b.sh", "/a/b.sh"),
        ("/bin/bash", "bash", None),
        ("/bin/csh", "csh|-fb|--odd|y", "--odd"),
        ("/bin/ls", "ls|a", None),
    ],
)
def test_scripts(spark, exe, args, want):
    assert values(spark, scripts.script(F.col("e"), F.col("a")), e=exe, a=args) == want


def test_first_category_wins_on_the_original_text(spark):
    rules = [("a", ["x.*"]), ("b", ["xy", "category_a"])]
    assert values(spark, scripts.categorize(F.col("v"), rules), v="xy") == "category_a"
    assert values(spark, scripts.categorize(F.col("v"), rules), v="q") == "q"
    assert values(spark, scripts.categorize(F.col("v"), rules, "other"), v="q") == "category_other"


def test_sizes_and_times(spark):
    assert values(spark, text.size_1024(F.col("v")), v=1536) == "1.5K"
    assert values(spark, text.size_1024(F.col("v")), v=2.0**64) == "limit"
    assert values(spark, text.elapsed(F.col("v")), v=3725.25) == "01:02:05.2500"


def test_first_failing_check_wins(spark):
    rows = spark.createDataFrame([(0, 2_000_000, 5, 5), (3, 2_000_000, 0, 5), (3, 1, 0, 5), (3, 1, 5, 99), (3, 1, 5, 5)], "pid long, ppid long, startTime long, recTime long")
    assert [r[0] for r in rows.select(clean.stat_code(10)).collect()] == [1, 2, 3, 4, 0]


def test_collapse_keeps_the_last_of_a_run_and_is_idempotent(spark):
    rows = spark.createDataFrame([(1, t, v) for t, v in enumerate([None, None, 1, 1, 2, 1])], "pid int, t int, v int")
    once = clean.collapse(rows, ["pid"], ["v"], ["t"])
    assert sorted(r.t for r in once.collect()) == [1, 3, 4, 5]
    assert sorted(r.t for r in clean.collapse(once, ["pid"], ["v"], ["t"]).collect()) == [1, 3, 4, 5]
    assert clean.collapse(rows, ["pid"], [], ["t"]).count() == 6


def test_correlation_centred_on_sums(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (4.0, 3.0)], "a double, b double")
    x, y = [1.0, 2.0, 4.0], [2.0, 1.0, 3.0]
    dx, dy = [v - sum(x) for v in x], [v - sum(y) for v in y]
    want = sum(p * q for p, q in zip(dx, dy, strict=True)) / (sum(p * p for p in dx) ** 0.5 * sum(q * q for q in dy) ** 0.5)
    assert rows.agg(summary.correlation("a", "b", "sum").alias("c")).first()["c"] == pytest.approx(want)
    assert rows.limit(1).agg(summary.correlation("a", "b").alias("c")).first()["c"] is None


def test_identity_falls_back_only_on_request(spark):
    rows = spark.createDataFrame([("h", 1, 1, 1, 0, "e", "a", "Unknown", "/")], "host string, startTime long, pid long, recTime long, recTimeUSec long, execName string, cmdArgs string, exePath string, cwdPath string")
    assert summary.identity(rows).first()["exePath"] is None
    assert summary.identity(rows, fallback_last=True).first()["exePath"] == "Unknown"


def test_histogram_edges(spark):
    rows = spark.createDataFrame([(None,), (0.0,), (1.0,), (2.0,), (2.5,), (-1.0,)], "v double")
    assert rows.agg(workload.histogram(F.col("v"), (0.0, 1.0, 2.0))).first()[0] == [2, 2]


def test_gate(spark):
    rows = spark.createDataFrame([("a", ""), ("b", "x")], "user string, host string")
    workload.check_names(rows, ["user"])
    with pytest.raises(ValueError, match="host"):
        workload.check_names(rows, ["user", "host"])


def test_adhoc_wants_a_condition(spark):
    with pytest.raises(ValueError, match="condition"):
        report.adhoc(spark.range(3), [], "id + 1", [("x", "id")])


def test_cycles_end(spark):
    rows = spark.createDataFrame([("h", 1, 2), ("h", 2, 1), ("h", 3, 0), ("h", 4, 3)], "host string, pid long, ppid long")
    assert {(r.pid, r.level) for r in tree.levels(rows, ["host"]).collect()} == {(1, None), (2, None), (3, 0), (4, 1)}
    assert {r.pid for r in tree.subtree(rows, rows.where("pid = 1"), ["host"]).collect()} == {1, 2}


def test_messages_with_commas_pipes_and_broken_ends(spark):
    body = "nRecords=3\n1,0,5,0,4,0,3,a,b,5,x|y,z,0,,4,/tmp\n2,1,5,0,4,0,1,q,0,,0,,0,\n3,1,5,0,4,0,99,short\n"
    rows = messages.texts(spark.createDataFrame([("h.i.s.procdata", body)], "topic string, value string"), "procdata").collect()
    assert [(r.pid, r.execName, r.cmdArgs, r.exePath, r.cwdPath) for r in rows] == [(1, "a,b", "x|y,z", "", "/tmp"), (2, "q", "", "", "")]
    fds = "nRecords=2\n1,0,5,0,4,0,5,/a,\nb,3,256\n2,0,5,0,4,0,0,,4,128"
    rows = messages.texts(spark.createDataFrame([("h.i.s.procfd", fds)], "topic string, value string"), "procfd").collect()
    assert [(r.pid, r.path, r.fd, r.mode) for r in rows] == [(1, "/a,\nb", 3, 256), (2, "", 4, 128)]


def test_job_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1, 2 ,u,p\n")
    (tmp_path / "b.csv").write_text("u:p:1:2:h:1:2:3:4:5:0:0\n")
    assert tuple(tables.jobs(spark, str(tmp_path / "a.csv"), 4).first()) == ("1", "2", "u", "p")
    assert tables.jobs(spark, str(tmp_path / "b.csv"), 12).first()["hostname"] == "h"


def test_trees_deeper_than_64_generations(spark):
    chain = spark.sql("SELECT 'h' AS host, id + 1 AS pid, id AS ppid FROM range(67)")
    assert {r.pid: r.level for r in tree.levels(chain, ["host"]).select("pid", "level").collect()} == {i + 1: i for i in range(67)}
    assert {r.pid for r in tree.subtree(chain, chain.where("pid = 1"), ["host"]).collect()} == set(range(1, 68))


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("h", "i", "s", 1, 7, 3600, 0), ("h", "i", "s", 1, 7, 7200, 0)], "host string, identifier string, subidentifier string, startTime long, pid long, recTime long, recTimeUSec long")
    sinks.hourly(rows, str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).select("hour").distinct().count() == 2
    sinks.good_and_bad(rows, F.when(F.col("recTime") > 4000, 4).otherwise(0), str(tmp_path / "good"), str(tmp_path / "bad"))
    assert (spark.read.parquet(str(tmp_path / "good")).count(), spark.read.parquet(str(tmp_path / "bad")).first()["bad_code"]) == (1, 4)
    day = lambda date, n: spark.createDataFrame([(date, "t", n, "ok"), (date, "t", n, "bad�")], "date string, type string, n int, name string")
    for date, n in (("20240101", 1), ("20240102", 2), ("20240101", 3)):
        sinks.daily(day(date, n), str(tmp_path / "days"))
    assert {(str(r.date), r.n) for r in spark.read.parquet(str(tmp_path / "days")).collect()} == {("20240101", 3), ("20240102", 2)}
    sinks.in_parts(spark.range(10).coalesce(1), str(tmp_path / "parts"), 4)
    assert len(list((tmp_path / "parts").glob("part-*.parquet"))) == 3
    sinks.delimited({"q": rows}, str(tmp_path / "out"), "|")
    assert spark.read.csv(str(tmp_path / "out/q"), header=True, sep="|").count() == 2
    sinks.json(rows, str(tmp_path / "json"))
    sinks.summaries({"s": rows}, str(tmp_path / "sum"))
    assert spark.read.json(str(tmp_path / "json")).count() == spark.read.parquet(str(tmp_path / "sum/s")).count() == 2


def test_stream_to_hourly_tables(spark, tmp_path):
    rows = spark.sql("SELECT 'h' AS host, id AS pid, 0L AS startTime, 86400 + id * 1800 AS recTime, timestamp_seconds(86400 + id * 1800) AS ts FROM range(4)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    live.ingest(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert {(r.pid, r.hour) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(0, 0), (1, 0), (2, 1), (3, 1)}


def test_topics(spark):
    rows = spark.createDataFrame([("h1", "a", "x"), ("h2", "a.b", "x"), ("g1", "a", "y")], "host string, identifier string, subidentifier string")
    assert [live.by_topic(rows, **k).count() for k in ({}, {"host": "h*"}, {"host": "*1"}, {"identifier": "a"}, {"host": "h*", "subidentifier": "y"})] == [3, 2, 2, 2, 0]


def test_processes_without_a_root(spark):
    ring = spark.createDataFrame([("h", 1, 0), ("h", 2, 3), ("h", 3, 2), ("h", 4, 4), ("h", 5, 4)], "host string, pid long, ppid long")
    assert {r.pid: r.level for r in tree.levels(ring, ["host"]).collect()} == {1: 0, 2: None, 3: None, 4: None, 5: None}
