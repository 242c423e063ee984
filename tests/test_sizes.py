"""Queries on tables that are odd or larger in some way, against their SQL."""

import os
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from procweave.operators import jobs, report, workload
from procweave.plans import catalog, streams
from procweave.sources import messages

from .test_oracle import DATA, TABLES, plain


@pytest.fixture
def same_rows(spark, tmp_path):
    def check(name, **changed):
        """The query's rows and its SQL's, on the smallest tables with some replaced by a SELECT from them."""
        c = duckdb.connect()
        for t in TABLES:
            c.sql(f"CREATE TABLE {t} AS {changed.get(t, 'FROM {}').format(repr(f'{DATA}/{t}.parquet'))}")
            c.sql(f"COPY {t} TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        df, want = catalog.QUERIES[name](spark, str(tmp_path)), c.sql(catalog.ORACLE_SQL[name])
        names = sorted(df.columns)
        place = [want.columns.index(n) for n in names]
        got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=str)
        assert got and got == sorted((tuple(plain(r[i]) for i in place) for r in want.fetchall()), key=str)

    return check


def test_ranking_of_counters_below_zero(same_rows):
    same_rows("srt3_all_rankings", events="SELECT * REPLACE (event_id * 97 AS event_id, value / 20 AS value) FROM {}")


@pytest.mark.parametrize("line", [1, 6])
def test_feed_whose_newest_row_is_past_the_limit_of_descriptors(same_rows, line):
    """The newest row of all has a descriptor that the collapse keeps, and one that it leaves out."""
    same_rows("str2_collapse_descriptors", lineitem=f"SELECT * REPLACE (CASE WHEN l_orderkey % 7 = 0 THEN {line} ELSE l_linenumber END AS l_linenumber, CASE WHEN l_orderkey % 7 = 0 THEN 6 ELSE l_suppkey % 6 END AS l_suppkey) FROM {{}}")


def test_totals_of_records_are_those_of_the_pairs(spark):
    """Jobs that begin and end at borders of blocks, of one second, twice, without records, backwards; records of one second, null values."""
    r = random.Random(3)
    spans = [(0, 0), (0, 3), (4, 7), (3, 4), (0, 15), (16, 31), (1, 63), (7, 7), (9, 8), (500, 900)] + [(a, a + r.randrange(300)) for a in (r.randrange(-50, 300) for _ in range(60))]
    job_rows = [(i % 40, "ab"[i % 2], "j", "1", a, b) for i, (a, b) in enumerate(spans + spans[:5])] + [(41, None, "j", "1", 0, 100)]
    rows = [("ab"[r.randrange(2)], "j", "1", r.choice([None, *range(-20, 250)]), r.choice([None, 1, 5, 900])) for _ in range(150)] + [(None, "j", "1", 5, 1), ("a", "j", "2", 5, 10_000)]
    jobs_ = spark.createDataFrame(job_rows, "id long, host string, job string, task string, start long, end long")
    records = spark.createDataFrame(rows, "host string, identifier string, subidentifier string, recTime long, v long")
    got = jobs.totals_of_records(jobs_, records, ["id"], ["v"])
    want = jobs.with_records(jobs_, records).groupBy("id").agg(F.count("*").alias("n"), F.max("v").alias("v"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_totals_of_records_where_pairs_are_too_many(spark):
    """100,000 jobs over 100,000 records of one name: ten thousand million pairs."""
    job_rows = spark.range(100_000).selectExpr("id", "'a' AS host", "'j' AS job", "'1' AS task", "0 - id AS start", "100000 + id AS end")
    records = spark.range(100_000).selectExpr("'a' AS host", "'j' AS identifier", "'1' AS subidentifier", "id AS recTime", "id AS v")
    got = jobs.totals_of_records(job_rows, records, ["id"], ["v"])
    assert got.agg(F.sum("n"), F.min("v")).first()[:] == (10_000_000_000, 99_999)


def test_long_messages_are_read_in_parts():
    """No batch of records is larger than its bound, though a batch of messages has many more."""
    one = "".join(f"{pid},1,2,3,4,5,2,é,{pid},256\n" for pid in range(30_000))
    topics = pa.RecordBatch.from_pydict({"host": ["h"] * 3, "identifier": ["j"] * 3, "subidentifier": ["1", "2", "3"], "value": ["nRecords=30000\n" + one, None, "nRecords=1\n7,1,2,3,4,5,1,/,9,8"]})
    read = list(messages.read_batches(iter([topics]), "procfd"))
    assert max(b.num_rows for b in read) == messages.RECORDS
    rows = [r for b in read for r in b.to_pylist()]
    assert [r["fd"] for r in rows] == [*range(30_000), 9] and {r["path"] for r in rows} == {"é", "/"} and rows[-1]["subidentifier"] == "3"


_SETS = (("host", "command"), ("project", "command"), ("host",), ("user", "project"), ("command",))


@pytest.mark.parametrize("dealt", [50, 1_000_000])
def test_axes_that_are_dealt_by_key(spark, monkeypatch, dealt):
    """Keys that are null, values that hold most rows, null values; ``dealt`` is less than a frequent value has, or more than all rows."""
    r = random.Random(4)
    rows = [(r.choice([*["h1"] * 8, None, *[f"h{i}" for i in range(30)]]), r.choice([None, "a", "b"]), r.choice(["p", None]), r.choice([*[None] * 9, *[f"u{i}" for i in range(40)]]), r.choice([None, 1, 20]), 1) for _ in range(900)]
    table = spark.createDataFrame(rows, "host string, command string, project string, user string, n long, one int")
    monkeypatch.setattr(workload, "DEALT", dealt)
    got, want = (workload.axes(table, _SETS, ("n", "one"), deal=d) for d in (("user", "host"), ()))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("query", ["agg15_axes", "agg16_daily_report"])
def test_tasks_of_axes_grow_with_the_rows(spark, monkeypatch, query):
    """What a task adds up is bounded: ten times smaller shares are many times as many tasks."""
    tasks = []
    for share in (1000, 100):
        monkeypatch.setattr(workload, "DEALT", share)
        tasks.append(catalog.QUERIES[query](spark, DATA).rdd.getNumPartitions())
    assert tasks[1] > 5 * tasks[0]


def test_joins_of_the_summary_in_shares(same_rows, spark, monkeypatch):
    """6,000 rows in shares of 500: thirteen tasks a join, whatever the number of the session."""
    monkeypatch.setattr(catalog.fx, "SHARE", 500)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = catalog.fx.summary(spark, DATA)
        assert "REPARTITION_BY_NUM" in rows._jdf.queryExecution().executedPlan().toString()
        same_rows("agg15_axes")
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_daily_report_of_one_process(spark):
    row = spark.createDataFrame([("h", None, "p", "e", "s", "c", 1, 2, 3, 9)], "host string, user string, project string, executable string, script string, command string, utime long, stime long, startTime long, recTime long")
    got = report.daily(row).collect()
    assert sorted(r["type"] for r in got) == sorted("*".join(g) for g in report.GROUPINGS) and {(r["cpu_time"], r["walltime"], r["nobs"]) for r in got} == {(0.03, 6, 1)}


def test_batches_of_messages_do_not_grow(same_rows, spark, monkeypatch):
    """1,000 records in files of 50, two files a batch: at least ten batches, each of a bounded number of files for an hour."""
    folders, ingest = [], streams.live.ingest
    monkeypatch.setattr(streams, "RECORDS", 50)
    monkeypatch.setattr(streams, "BATCH", 2)
    monkeypatch.setattr(streams.live, "ingest", lambda stream, path, checkpoint: folders.append([f.removeprefix("file:") for f in (path, checkpoint)]) or ingest(stream, path, checkpoint, spread=1))
    same_rows("str1_messages_to_hours", events="SELECT * REPLACE (TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (event_id * 7) SECOND AS ts) FROM {}")
    (path, checkpoint), = folders
    batches = len([f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()])
    assert batches >= 10
    written = [f"{at}/{f}" for at, _, files in os.walk(path) for f in files if f.endswith(".parquet")]
    assert len(written) <= 2 * batches  # the records are of two hours, whatever the tasks of a batch
