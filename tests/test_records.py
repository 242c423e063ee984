"""Sinks that skip what is equal, job reports, trees by doubling pointers, category files and pruned reads, on small tables."""

import pathlib

import pytest
from pyspark.sql import functions as F

from procweave.functions import categories
from procweave.operators import clean, jobs, report, summary, tree
from procweave.sources import messages, sinks, tables


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in pathlib.Path(path).rglob("*.parquet")}


def test_deposit_writes_only_what_differs(spark, tmp_path):
    path, schema = str(tmp_path / "deposit"), "date string, type string, host string, v int"
    rows = [("20240101", "exe", "a", 1), ("20240101", "exe", "b", 2), ("20240101", "script", "a", 3), ("20240102", "exe", "a", 4), ("20240102", "exe", "�", 5)]
    frame = spark.createDataFrame(rows, schema)
    assert {(r.date, r.type): (r.stored, r.new, r.action) for r in sinks.deposit(frame, path).collect()} == {("20240101", "exe"): (0, 2, "written"), ("20240101", "script"): (0, 1, "written"), ("20240102", "exe"): (0, 1, "written")}
    before = files(path)
    assert {r.action for r in sinks.deposit(frame, path).collect()} == {"equal"} and files(path) == before
    more = spark.createDataFrame([("20240101", "exe", "c", 9), *rows[2:3], ("20240103", None, "n", 7)], schema)
    got = {(r.date, r.type): (r.stored, r.new, r.action) for r in sinks.deposit(more, path).collect()}
    assert got == {("20240101", "exe"): (2, 1, "written"), ("20240101", "script"): (1, 1, "equal"), ("20240102", "exe"): (1, 0, "kept"), ("20240103", None): (0, 1, "written")}
    after = files(path)
    assert {f for f in before if f in after} == {f for f in before if "script" in f or "20240102" in f} and all(after[f] == before[f] for f in before if f in after)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [3, 4, 7, 9]
    assert sinks.deposit(frame.where("v < 0"), str(tmp_path / "none")).count() == 0


def test_hourly_files_turn_over(spark, tmp_path):
    rows = spark.range(100).selectExpr("'h' AS host", "id AS pid", "0L AS startTime", "7200 + id AS recTime", "0L AS recTimeUSec")
    sinks.hourly(rows, str(tmp_path / "t"), hosts=4, most=30)
    assert len(files(tmp_path / "t")) == 4
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 100 and {(str(r.date), r.hour, r.hosts) for r in back.select("date", "hour", "hosts").distinct().collect()} == {("19700101", 2, spark.range(1).select(sinks.host_group(F.lit("h"), 4)).first()[0])}


def test_report_of_all_record_kinds(spark):
    ps = spark.createDataFrame([("h", 5, 1, "j", "1", 20, 0, 7), ("h", 5, 1, "j", "1", 10, 0, 3)], "host string, startTime long, pid long, identifier string, subidentifier string, recTime long, recTimeUSec long, utime long")
    fd = spark.createDataFrame([("h", 5, 1, 20, 4, "/b", 1), ("h", 5, 1, 20, 3, "/a", 1), ("h", 6, 2, 9, 3, "/z", 1)], "host string, startTime long, pid long, recTime long, fd long, path string, mode long")
    obs = spark.createDataFrame([("h", 5, 1, 20, 0), ("h", 5, 1, 10, 0), ("h", 7, 3, 1, 0)], "host string, startTime long, pid long, recTime long, recTimeUSec long")
    got = {r.pid: r for r in jobs.nested(ps, fd, obs).collect()}
    assert [x.utime for x in got[1].ps] == [3, 7] and [x.path for x in got[1].fd] == ["/a", "/b"] and [x.recTime for x in got[1].obs] == [10, 20]
    assert (got[1].identifier, got[2].identifier, got[3].identifier) == ("j", None, None)
    assert [(len(got[p].ps), len(got[p].fd), len(got[p].obs)) for p in (2, 3)] == [(0, 1, 0), (0, 0, 1)]
    exchanges = jobs.nested(ps, fd, obs)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges == 1


def test_a_chain_of_ten_thousand(spark):
    """Rounds double the reach; rings, what hangs on them and processes that are their own parents have no level."""
    n = 10_000
    chain = spark.range(1, n + 1).selectExpr("'h' AS host", "id AS pid", "id - 1 AS ppid")
    others = spark.createDataFrame([("r", 1, 2), ("r", 2, 3), ("r", 3, 1), ("r", 4, 3), ("r", 5, 5), ("r", 6, 0)], "host string, pid long, ppid long")
    jobs_before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    got = {(r.host, r.pid): r.level for r in tree.levels(chain.unionByName(others), ["host"], paths=False).collect()}
    assert all(got["h", p] == p - 1 for p in range(1, n + 1)) and len(got) == n + 6
    assert [got["r", p] for p in range(1, 7)] == [None] * 5 + [0]
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - len(jobs_before) < 150


def test_listing_along_the_tree(spark):
    rows = [("j", "h", 1, 0, 100), ("j", "h", 5, 1, 110), ("j", "h", 2, 1, 120), ("j", "h", 9, 5, 150), ("j", "h", 3, 0, 90), ("j", "g", 2, 0, 130), ("k", "h", 7, 0, 1), ("k", "h", 8, 8, 2)]
    frame = spark.createDataFrame(rows, "identifier string, host string, pid long, ppid long, startTime long")
    got = sorted((r.identifier, r.place, r.host, r.pid, r.level) for r in tree.listing(frame).collect())
    assert got == [("j", 1, "h", 3, 0), ("j", 2, "h", 1, 0), ("j", 3, "h", 5, 1), ("j", 4, "h", 9, 2), ("j", 5, "h", 2, 1), ("j", 6, "g", 2, 0), ("k", 1, "h", 7, 0), ("k", 2, "h", 8, None)]


def test_parents_in_time(spark):
    """Pid 1 is used twice; the child began under the first use."""
    rows = spark.createDataFrame([("h", 1, 10, 0), ("h", 1, 50, 0), ("h", 2, 20, 1)], "host string, pid long, startTime long, ppid long")
    assert {(r.pid, r.startTime): r.isParent for r in tree.flag_parents(rows).collect()} == {(1, 10): 1, (1, 50): 1, (2, 20): 0}
    assert {(r.pid, r.startTime): r.isParent for r in tree.flag_parents(rows, time_aware=True).collect()} == {(1, 10): 1, (1, 50): 0, (2, 20): 0}


def test_numbers_without_gaps(spark):
    rows = spark.range(1000).selectExpr("(id * 7919) % 1000 AS v").repartition(7)
    assert sorted((r.v, r.place) for r in report.numbered(rows, ["v"]).collect()) == [(i, i + 1) for i in range(1000)]
    assert report.numbered(rows.where("v < 0"), ["v"]).count() == 0


def test_rankings(spark):
    rows = spark.createDataFrame([("a", 1, 1, None), ("b", 1, 2, 5), ("c", 1, 3, 9), ("d", 1, 4, 5)], "host string, startTime long, pid long, rss long")
    assert [(r.rank, r.pid) for r in report.ranking(rows, "rss", 3).orderBy("rank").collect()] == [(1, 3), (2, 2), (3, 4)]
    assert [r.pid for r in report.ranking(rows, "rss", 4, ascending=True).orderBy("rank").collect()] == [2, 4, 3, 1]
    with pytest.raises(ValueError, match="keys are duration"):
        report.ranking(rows, "nice", 3)
    assert len(report.LIVE_KEYS) == 13


def write(folder, name, text):
    (folder / name).write_text(text)
    return str(folder / name)


def test_category_files(spark, tmp_path):
    values = spark.createDataFrame([(v,) for v in ["blastn", "blastx", "run(1)", "sam", "samtools", "other", None, "a.b", "axb"]], "command string")
    rows = categories.load(spark, write(tmp_path, "rows.csv", "search,blast.*,sam\n\nsam,sam, samtools \nnone\nodd,a.b,\n"))
    assert sorted((r.rank, r.category, r.pattern, r.literal) for r in rows.collect()) == [(0, "search", "blast.*", False), (0, "search", "sam", True), (2, "sam", "sam", True), (2, "sam", "samtools", True), (4, "odd", "a.b", False)]
    got = {r.command: r.c for r in categories.generalize(values, "command", rows, other="rest", name="c").collect()}
    assert got == {"blastn": "category_search", "blastx": "category_search", "sam": "category_search", "samtools": "category_sam", "run(1)": "category_rest", "other": "category_rest", None: None, "a.b": "category_odd", "axb": "category_odd"}
    columns = categories.load(spark, write(tmp_path, "columns.csv", "calls,odd\r\nrun(1),a.b\r\n,other\r\n"), transposed=True, literal=True)
    got = {r.command for r in categories.generalize(values, "command", columns).collect()}
    assert got == {"blastn", "blastx", "sam", "samtools", "category_calls", "category_odd", None, "axb"}


def test_categories_given_in_place(spark, monkeypatch):
    values = spark.createDataFrame([("x1",), ("x1",), ("y",)], "v string")
    table = categories.rules(spark, [("first", ["x[0-9]"]), ("second", ["x1", "y"])])
    assert sorted(r.v for r in categories.generalize(values, "v", table).collect()) == ["category_first", "category_first", "category_second"]
    monkeypatch.setattr(categories, "MOST_REGEXES", 0)
    with pytest.raises(ValueError, match="more than 0"):
        categories.generalize(values, "v", table)


@pytest.mark.parametrize("hosts", [0, 4])
def test_only_parts_that_can_matter_are_read(spark, tmp_path, capsys, hosts):
    rows = spark.range(4000).selectExpr("concat('h', id % 3) AS host", "'j' AS identifier", "'1' AS subidentifier", "id AS pid", "0L AS startTime", "id * 60 AS recTime", "0L AS recTimeUSec")
    path = str(tmp_path / "stored")
    sinks.hourly(rows, path, hosts=hosts)
    wanted = spark.createDataFrame([(1, "h1", "j", "1", 7000, 7300), (2, "h2", "j", "1", 100_000, 100_700), (3, "h2", "j", "1", 9, 5), (4, "h9", "j", "1", 0, 3000), (5, "h1", "j", "1", 10**9, 10**9 + 5)], "row int, host string, job string, task string, start long, end long")
    catalogue = tables.intervals(rows.select(F.date_trunc("hour", F.timestamp_seconds("recTime")).alias("recording_start")).distinct().withColumn("path", F.lit("f")))
    schema = rows.schema.add("date", "string").add("hour", "integer")
    stored = spark.read.schema(schema.add("hosts", "integer") if hosts else schema).parquet(path)
    got = jobs.with_stored_records(wanted, stored, catalogue, hosts=hosts)
    assert sorted((r.row, r.pid) for r in got.collect()) == sorted((r.row, r.pid) for r in jobs.with_records(wanted, rows).collect())
    assert got.count() > 0 and jobs.wanted_parts(wanted.where("row = 5"), catalogue, hosts).count() == 0
    got.explain("formatted")
    scans = [line for line in capsys.readouterr().out.split("\n") if line.startswith("PartitionFilters")]
    assert any("dynamicpruning" in line for line in scans)


def test_fields_of_each_record_type():
    assert [len(clean.COMPARED[k]) for k in ("procstat", "procdata", "procfd")] == [23, 7, 7]
    assert len(summary.CARRIED) == 41
    assert clean.compared("procstat", ["pid", "utime", "startTime"]) == ("pid", "utime", "startTime")
    assert clean.compared("procstat", ["pid", "utime", "startTime"], strict_reference=True) == ("pid", "utime")


def test_a_pid_that_is_used_again(spark):
    rows = spark.createDataFrame([("h", 1, 10, 100, 5), ("h", 1, 10, 130, 5), ("h", 1, 140, 150, 5)], "host string, pid long, startTime long, recTime long, utime long")
    assert sorted(r.recTime for r in clean.collapse_records(rows, "procstat").collect()) == [130, 150]
    assert [r.recTime for r in clean.collapse_records(rows, "procstat", strict_reference=True).collect()] == [150]
    assert clean.collapse_records(rows, "netstat").count() == 3


def test_times_of_two_files_count_in_both(spark):
    rows = spark.createDataFrame([("j", "h", 1, 0, 10, "a"), ("j", "h", 1, 0, 10, "b"), ("j", "h", 1, 0, 40, "b")], "identifier string, host string, pid long, startTime long, recTime long, file string")
    assert jobs.coverage(rows, "procstat").first()["n_times"] == 2
    assert sorted((r.file, r.n_times, r.largest_gap) for r in jobs.coverage(rows, "procstat", per_source="file").collect()) == [("a", 1, 0), ("b", 2, 30)]


def test_what_messages_lose(spark):
    bodies = [("h.i.s.procfd", "nRecords=3\n1,0,5,0,4,0,2,/a,3,256\n2,1,5,0,4,0,99,short\n3,0,5,0,4,0,2,/b,4,1\n"), ("h.i.s.procfd", "nRecords=1\n1,0,5,0,4,0,2,/a,3,256\n"), ("h.i.s.procfd", None), ("h.i.s.procstat", "nRecords=2\n1,2,3\n")]
    frame = spark.createDataFrame(bodies, "topic string, value string")
    assert sorted((r.said or 0, r.read, r.lost) for r in messages.losses(frame, "procfd").collect()) == [(0, 0, None), (1, 1, 0), (3, 1, 2)]
    assert [(r.said, r.read, r.lost) for r in messages.losses(frame, "procstat").collect()] == [(2, 0, 2)]


def test_process_logs(spark, tmp_path):
    write(tmp_path, "log.csv", "2024-01-02 03:04:05,h,7\nbroken,h,8\n")
    rows = tables.process_log(spark, str(tmp_path / "log.csv"), ("time", "host", "pid"))
    assert [(r.pid, r.time is None) for r in rows.orderBy("pid").collect()] == [("7", False), ("8", True)]


def test_records_in_order_of_their_process(spark):
    rows = spark.range(40).selectExpr("concat('j', id % 3) AS identifier", "'1' AS subidentifier", "id % 2 AS startTime", "id % 5 AS pid", "40 - id AS recTime", "0L AS recTimeUSec")
    got = sinks.sorted_by_process(rows.coalesce(1)).collect()
    key = lambda r: (r.identifier, r.startTime, r.pid, r.recTime)
    assert [key(r) for r in got] == sorted(map(key, got))
