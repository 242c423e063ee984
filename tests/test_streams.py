"""Live views on streams whose batches come out of order, each against the table at rest or what it should say."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from procweave.operators import clean
from procweave.plans import streams
from procweave.streaming import hours, live, ordered

SAMPLE = "host string, pid long, recTime long, event_id long, v long"


class Feed:
    """A folder to which batches are added, each a file; ``run`` reads what is new and ends."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.n = spark, str(folder), schema, 0

    def add(self, *batches):
        for rows in batches:
            self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(f"{self.folder}/in/part={self.n:03d}")
            self.n += 1
        return self

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/in/*")

    def run(self, out, name="out"):
        out.writeStream.format("parquet").option("path", f"{self.folder}/{name}").option("checkpointLocation", f"{self.folder}/{name}-progress").trigger(availableNow=True).start().awaitTermination()
        return self.spark.read.schema(out.schema).parquet(f"{self.folder}/{name}")


@pytest.fixture
def feed(spark, tmp_path):
    return lambda schema, name="feed": Feed(spark, tmp_path / name, schema)


def test_rates_of_late_samples(feed):
    """A sample that comes after a newer one stands before it: no rate is taken from it to the next."""
    f = feed(SAMPLE).add([("h", 1, 10_100, 1, 100)], [("h", 1, 10_090, 2, 0)], [("h", 1, 10_110, 3, 110)], [("h", 9, 90_000, 4, 0)])
    got = f.run(live.rates(f.stream(), ["host", "pid"], ["v"])).collect()
    assert sorted((r.recTime, r.v_rate) for r in got) == [(10_100, 10.0), (10_110, 1.0)]


def test_rates_across_a_silence_and_of_nulls(feed):
    f = feed(SAMPLE).add([("h", 1, 100, 1, 1), ("h", 1, 200, 2, None), ("h", 1, 200, 3, 50), ("h", 1, 300, 4, 7), ("h", 1, 5000, 5, 9)], [("h", 9, 90_000, 6, 0)])
    got = f.run(live.rates(f.stream(), ["host", "pid"], ["v"])).collect()
    assert sorted((r.recTime, r.v_rate) for r in got) == [(200, None), (300, None)]


@pytest.mark.parametrize("reset", [3600, None])
def test_batches_in_any_order(feed, spark, reset):
    r = random.Random(5)
    rows = [("h", pid, t, i, r.choice([1, 1, 1, 2, None])) for i, (pid, t) in enumerate((p, t) for p in (1, 2) for t in range(3000, 12_000, 400))]
    r.shuffle(rows)
    f = feed(SAMPLE).add(rows[:15], rows[15:30], rows[30:], [("", 0, 90_000, 1000, 1)])
    got = f.run(live.collapse(f.stream(), ["host", "pid"], ["v"], reset=reset, late="3 hours")).where("host != ''")
    table = spark.createDataFrame(rows, SAMPLE).withColumn("hour", F.expr("recTime div 3600"))
    want = clean.collapse(table, ["host", "pid", "hour"] if reset else ["host", "pid"], ["v"], ["recTime", "event_id"])
    assert sorted(x.event_id for x in got.collect()) == sorted(x.event_id for x in want.collect())


def test_runs_end_with_the_hour_and_with_silence(feed):
    f = feed(SAMPLE).add([("h", 1, 3500, 1, 7), ("h", 1, 3700, 2, 7), ("h", 2, 3500, 3, 7)], [("h", 9, 7300, 4, 1)])
    by_hour = f.run(live.collapse(f.stream(), ["host", "pid"], ["v"], late="1 second"), "hour")
    assert {r.event_id for r in by_hour.collect()} == {1, 2, 3}
    silent = f.run(live.collapse(f.stream(), ["host", "pid"], ["v"], late="1 second", reset=None, silence=3000), "silence")
    assert {r.event_id for r in silent.collect()} == {2, 3}


def test_descriptors_have_states_of_their_own(feed):
    schema = "host string, pid long, ppid long, startTime long, startTimeUSec long, recTime long, path string, fd long, mode long"
    row = lambda t, fd, path: ("h", 1, 0, 5, 0, t, path, fd, 256)
    f = feed(schema).add([row(130, 3, "/a"), row(100, 4, "/b")], [row(100, 3, "/a"), row(130, 4, "/c"), row(100, 2, "/std"), row(100, 13, "/far")], [("h", 9, 0, 5, 0, 90_000, "/z", 3, 256)])
    got = f.run(live.collapse_descriptors(f.stream())).collect()
    assert sorted((r.fd, r.recTime, r.path) for r in got) == [(3, 130, "/a"), (4, 100, "/b"), (4, 130, "/c")]


def test_newest_meets_newest_of_its_time(feed):
    stat = feed("host string, pid long, startTime long, recTime long, recTimeUSec long, utime long", "stat")
    data = feed("host string, pid long, startTime long, recTime long, recTimeUSec long, exePath string, cmdArgs string", "data")
    stat.add([("h", 1, 5, 200, 0, 20)], [("h", 1, 5, 100, 1, 10), ("h", 1, 5, 100, 2, 11), ("h", 2, 5, 100, 0, 1)], [("h", 9, 5, 90_000, 0, 0)])
    data.add([("h", 1, 5, 100, 0, "/a", "a"), ("h", 1, 5, 100, 5, "/b", "b")], [("h", 1, 5, 150, 0, "/c", "c"), ("h", 2, 5, 101, 0, "/x", "x")], [("h", 8, 5, 90_000, 0, "/z", "z")])
    got = stat.run(live.join_identity(stat.stream(), data.stream())).collect()
    assert [(r.pid, r.recTime, r.utime, r.exePath) for r in got] == [(1, 100, 11, "/b")]


def test_silent_keys_leave_the_cache(feed, spark, tmp_path):
    schema = "host string, identifier string, subidentifier string, pid long, startTime long, recTime long, utime long, state string"
    row = lambda job, pid, t, utime, state="R": ("h", job, "1", pid, 0, t, utime, state)
    f = feed(schema).add([row("a", 1, 1000, 5), row("a", 2, 1000, 7), row("b", 3, 1000, 1)], [row("a", 1, 1030, 9), row("a", 1, 900, 0)], [row("c", 4, 1350, 1)], [row("c", 4, 1650, 4, "S")])
    updates = live.cache(f.stream(), counters=["utime"], state="state", timeout=300)
    live.keep_updates(updates, str(tmp_path / "kept"), str(tmp_path / "progress")).awaitTermination()
    kept = spark.read.schema(updates.schema.add("batch", "long")).option("basePath", str(tmp_path / "kept")).parquet(str(tmp_path / "kept"))
    said = {(r.identifier, r.pid, r.recTime, r.gone): (r.utime_delta, r.dt, r.since) for r in kept.collect()}
    assert said["a", 1, 1030, False] == (4, 30, 1000) and said["a", 2, 1000, True] == (None, None, 1000)
    assert said["b", 3, 1000, True] and said["a", 1, 1030, True] and said["c", 4, 1650, False] == (3, 300, 1650)
    assert ("a", 1, 900, False) not in said
    assert [(r.identifier, r.pid, r.recTime) for r in live.view(kept).collect()] == [("c", 4, 1650)]


def test_fresh_records(feed):
    schema = "host string, pid long, startTime long, recTime long, v long"
    f = feed(schema).add([("h", 1, 0, 100, 5), ("h", 1, 0, 130, 6), ("h", 2, 0, 131, 7)], [("h", 1, 0, 20_000, 6), ("h", 3, 0, 120, 9)], [("h", 3, 0, 40_000, 1), ("h", 4, 0, 120, 9)])
    newest = {(r.pid, r.recTime) for r in f.run(live.fresh(f.stream())).collect()}
    assert {(1, 130), (2, 131), (1, 20_000), (3, 40_000)} <= newest and not {(1, 100), (4, 120)} & newest


def test_hours_wait_for_their_writers(feed, spark, tmp_path):
    """A late file of an open hour is in; done again, nothing is added; what comes after the release is set aside."""
    f = feed("host string, pid long, recTime long")
    schema, path, still = "`host` string, `pid` bigint, `recTime` bigint", str(tmp_path / "hours"), [("w1", 3600)]
    log = lambda s: hours.open_hours(s.createDataFrame(still, "writer string, at long").select("writer", F.timestamp_seconds("at").alias("recording_start"), F.lit(False).alias("closed")))
    run = lambda: hours.release_closed(f.stream(), path, str(tmp_path / "progress"), log).awaitTermination()
    out = lambda: sorted((r.hour[-2:], r.pid) for r in hours.released(spark, path, schema).collect())
    f.add([("h", 1, 100), ("h", 2, 4000)])
    run()
    assert out() == [("00", 1)]
    f.add([("h", 3, 5000), ("h", 4, 200)])
    run()
    assert out() == [("00", 1)] and [(r.pid, r.hour[-2:]) for r in hours.stragglers(spark, path, schema).collect()] == [(4, "00")]
    still.clear()
    still.append(("w1", 7200))
    assert hours.release(spark, path, schema, 7, log) == 1 and hours.release(spark, path, schema, 7, log) == 0
    assert out() == [("00", 1), ("01", 2), ("01", 3)]
    # an interrupted release: the hour's rows are there, its mark is not
    spark.createDataFrame([(9, "1970010105")], "upto long, hour string").limit(0).write.mode("append").partitionBy("hour").parquet(f"{path}/marks")
    hours.hour_of(spark.createDataFrame([("h", 5, 18_100)], "host string, pid long, recTime long")).write.mode("append").partitionBy("hour").parquet(f"{path}/collecting/batch=9")
    hours.hour_of(spark.createDataFrame([("h", 5, 18_100), ("h", 5, 18_100)], "host string, pid long, recTime long")).write.mode("append").partitionBy("hour").parquet(f"{path}/released")
    assert len(out()) == 3
    hours.release(spark, path, schema, 9, log)
    assert out()[-1] == ("05", 5) and len(out()) == 4


def test_writer_logs(spark):
    log = spark.createDataFrame([("a", 0, False, 1), ("a", 0, True, 2), ("b", 0, True, 1), ("b", 3600, True, 1), ("b", 3600, False, 2)], "writer string, at long, closed boolean, seq long").withColumn("recording_start", F.timestamp_seconds("at"))
    assert [r.hour.hour for r in hours.open_hours(log).collect()] == [1]
    assert hours.open_hours(log.drop("seq")).count() == 0


def test_feeds_come_out_of_order(spark):
    """The slices of the queries' feeds do mix: a row of a later slice is older than one of an earlier."""
    rows = spark.range(2000).selectExpr("'h' AS host", "id AS pid", "id * 1300 AS recTime")
    stream = streams.feed(spark, rows, "mixed")
    batches = []
    stream.writeStream.foreachBatch(lambda df, i: batches.append(df.where("host != ''").agg(F.min("recTime"), F.max("recTime"), F.count("*")).first())).option("checkpointLocation", streams.shared.new_folder(spark, "p")).trigger(availableNow=True).start().awaitTermination()
    assert sum(b[2] for b in batches) == 2000
    assert any(a[1] > b[0] for a, b in zip(batches, batches[1:], strict=False) if b[2])


def test_feed_counts(spark):
    rows = spark.sql("SELECT timestamp_seconds(id + 10) AS ts, 'h' AS host, 't' AS type FROM range(5)")
    assert live.feed_counts(rows).first()["n"] == 5


@pytest.mark.parametrize("groups", [1, 3])
def test_keys_that_share_a_group_keep_apart(feed, spark, monkeypatch, groups):
    """State is read and written by groups of keys; a key's rows, last row and times are its own."""
    monkeypatch.setattr(ordered, "GROUPS", groups)
    r = random.Random(8)
    rows = [(r.choice(["a", "b", None]), r.randrange(6), t, i, r.choice([1, 2, None])) for i, t in enumerate(r.sample(range(3000, 12_000), 300))]
    r.shuffle(rows)
    f = feed(SAMPLE).add(rows[:100], rows[100:200], rows[200:], [("", 0, 900_000, 1000, 1)])
    got = f.run(live.collapse(f.stream(), ["host", "pid"], ["v"], late="3 hours"), "runs").where("host != '' OR host IS NULL")
    table = spark.createDataFrame(rows, SAMPLE).withColumn("hour", F.expr("recTime div 3600"))
    want = clean.collapse(table, ["host", "pid", "hour"], ["v"], ["recTime", "event_id"])
    assert sorted(x.event_id for x in got.collect()) == sorted(x.event_id for x in want.collect())
    rates = f.run(live.rates(f.stream(), ["host", "pid"], ["v"], late="3 hours", silence=1000), "rates")
    before = lambda c: F.lag(c).over(Window.partitionBy("host", "pid").orderBy("recTime"))
    gap = F.col("recTime") - before("recTime")
    want = table.select("host", "pid", "recTime", ((F.col("v") - before("v")) / gap).alias("v_rate"), gap.alias("gap")).where("gap <= 1000").drop("gap")
    assert sorted(map(str, rates.collect())) == sorted(map(str, want.collect()))


def test_late_rows_of_an_open_hour_count(feed, spark):
    """A row that is later than ``late`` is still one of its hour, which is not over; nulls, and values that are no number, are equal to their like."""
    nan = float("nan")
    schema = SAMPLE.replace("v long", "v double")
    f = feed(schema).add([("h", 1, 3000, 1, 7.0), (None, 2, 100, 2, nan)], [("h", 1, 1000, 3, 8.0), ("h", 1, 500, 4, 7.0), (None, 2, 200, 5, nan)], [("h", 9, 90_000, 6, 0.0)])
    got = f.run(live.collapse(f.stream(), ["host", "pid"], ["v"], late="1 second"))
    assert sorted(r.event_id for r in got.collect()) == [1, 3, 4, 5]


def test_slices_of_many_rows_are_many_files(spark, monkeypatch):
    """A slice is dealt to files of bounded size and is still one batch."""
    monkeypatch.setattr(streams, "ROWS", 100, raising=False)
    rows = spark.range(4000).selectExpr("'h' AS host", "id AS pid", "id * 1300 AS recTime")
    seen = []
    stream = streams.feed(spark, rows, "wide")
    stream.writeStream.foreachBatch(lambda df, i: seen.append((df.select(F.input_file_name()).distinct().count(), df.where("host != ''").count()))).option("checkpointLocation", streams.shared.new_folder(spark, "p")).trigger(availableNow=True).start().awaitTermination()
    assert sum(n for _, n in seen) == 4000 and len(seen) <= streams.SLICES + 1 and all(files >= 10 for files, n in seen if n > 300)
