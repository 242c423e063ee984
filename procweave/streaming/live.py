"""Live views of the record streams: collapse of repeats, rates, latest batches, joins and feed counts.

What needs state of a process over time (``collapse``, ``rates``, ``join_identity``) works in order of record times; see
``ordered``. Streams have the columns of the record tables, ``recTime`` in seconds among them."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clean
from ..sources import messages
from . import ordered

#: Seconds: a silent process is forgotten, a job's last batch leaves the live view, an hour's state is dropped.
SILENCE, FRESH, HOUR = 3600, 300, 3600


def collapse(rows: DataFrame, key: Sequence[str], compare: Sequence[str], *, within: Sequence[str] = (), reset: int | None = HOUR, silence: int = SILENCE, late: str = "1 hour") -> DataFrame:
    """The last row of each run of equal rows, by key and, in it, by ``within``: sent when ``reset`` seconds (an hour) are over, at
    which all keys start anew. Without ``reset`` it is sent when the next row differs, and at the latest when the
    key has been silent. On finished input these are the rows of ``clean.collapse`` by key, ``within`` and hour."""
    if reset:
        own = (*key, *within)
        return ordered.by_span(rows, own, ordered.last_of_runs(own, compare), reset, late)
    made = ordered.Collapse(ordered.ddl(rows), rows.columns, key, within, compare, silence)
    return ordered.run(rows, key, made, ordered.ddl(rows), late)


def collapse_descriptors(procfd: DataFrame, most: int = 10, **options) -> DataFrame:
    """Descriptors of a process, each collapsed on its own in the state of the process; those of standard input and output,
    and beyond the limit of a process, are left out."""
    rows = clean.limit_fds(procfd, most)
    return collapse(rows, ("host", "pid"), clean.compared("procfd", rows.columns), within=("fd",), **options)


def rates(rows: DataFrame, key: Sequence[str], counters: Sequence[str], *, silence: int = SILENCE, late: str = "1 hour") -> DataFrame:
    """Key, time and the change per second of each counter since the sample before, for all samples but the first of a key
    and the first after a silence. Counters that fall have negative rates."""
    kinds = dict(rows.dtypes)
    times = ["recTime long", *(["recTimeUSec long"] if "recTimeUSec" in kinds else [])]
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in key], *times, *[f"`{c}_rate` double" for c in counters]])
    return ordered.run(rows, key, ordered.Rates(ordered.ddl(rows), rows.columns, key, counters, silence), schema, late)


def join_identity(stat: DataFrame, data: DataFrame, key: Sequence[str] = ("host", "pid", "startTime"), bring: Sequence[str] = ("exePath", "cmdArgs"), *, silence: int = SILENCE, late: str = "1 hour") -> DataFrame:
    """The newest sample of a process with its newest identity record, whenever both are of the same second: one row for a
    process and second. The two streams are worked on as one, so its watermark is that of the newest record of either."""
    kinds = dict(data.dtypes)
    times = [c for c in ("recTime", "recTimeUSec", "event_id") if c in stat.columns and c in kinds]
    own = [c for c in stat.columns if c not in bring]
    a = stat.select(*own, *[F.lit(None).cast(kinds[c]).alias(c) for c in bring], F.lit(0).alias("side"))
    b = data.select(*[F.col(c) if c in key or c in times else F.lit(None).cast(t).alias(c) for c, t in stat.dtypes if c in own], *bring, F.lit(1).alias("side"))
    both = a.unionByName(b)
    out = both.drop("side")
    return ordered.run(both, key, ordered.Newest(ordered.ddl(both), both.columns, key, out.columns, own, bring, silence), ordered.ddl(out), late)


def cache(rows: DataFrame, key: Sequence[str] = ("host", "identifier", "subidentifier"), member: Sequence[str] = ("pid", "startTime"), counters: Sequence[str] = (), state: str | None = None, *, timeout: int = FRESH, late: str | None = None, mode: str = "update") -> DataFrame:
    """The live cache as a stream of updates: the newest batch of each key (its rows of the newest second), sent again when a
    newer one comes. Beside the row stand the change of each counter (``_delta``) and of the time (``dt``) since the
    member's row in the batch before, ``since`` when its ``state`` has been the same, and ``gone``: true for members that
    the newer batch lacks, and for all of a key of which nothing has come for ``timeout`` seconds of record time."""
    schema, kinds = ordered.ddl(rows), dict(rows.dtypes)
    out = ", ".join([schema, *[f"`{c}_delta` {kinds[c]}" for c in counters], "dt long, since long, gone boolean"])
    return ordered.run(rows, key, ordered.Cache(schema, rows.columns, key, member, counters, state, timeout), out, late or f"{timeout} seconds", mode)


def view(updates: DataFrame, key: Sequence[str] = ("host", "identifier", "subidentifier"), member: Sequence[str] = ("pid", "startTime")) -> DataFrame:
    """What the cache shows now, from its updates with the ``batch`` that brought them: the last word on each member, if that
    is not that it has gone."""
    last = updates.groupBy(*key, *member).agg(F.max_by(F.struct(*[c for c in updates.columns if c not in (*key, *member)]), F.struct("batch", "gone")).alias("__last"))
    return last.select(*key, *member, "__last.*").where(~F.col("gone")).select(*updates.columns).drop("batch", "gone")


def keep_updates(updates: DataFrame, path: str, checkpoint: str):
    """Write the updates of a cache, each batch to a folder of its own, which a batch that is done again replaces; returns the
    query, which ends when the input does."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return updates.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def feed_counts(rows: DataFrame, late: str = "1 hour") -> DataFrame:
    """Records by hour, host and type."""
    rows = rows.withWatermark("ts", late) if rows.isStreaming else rows
    return rows.groupBy(F.window("ts", "1 hour").alias("w"), "host", "type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("hour"), "host", "type", "n")


def latest(rows: DataFrame, key: Sequence[str], now: int, most_age: int = FRESH) -> DataFrame:
    """The newest record time of each key, without keys older than ``most_age`` seconds: the batch form of the live cache."""
    return rows.groupBy(*key).agg(F.max("recTime").alias("recTime"), F.count("*").alias("n")).where(F.col("recTime") >= now - most_age)


def ingest_messages(topics: DataFrame, kind: str, path: str, checkpoint: str):
    """``ingest`` of the records of one type in a stream of messages (topic, value)."""
    return ingest(messages.procstat(topics) if kind == "procstat" else messages.texts(topics, kind), path, checkpoint)


def ingest(stream: DataFrame, path: str, checkpoint: str, spread: int = 2):
    """Write a stream of records to Parquet by date and hour of their time; returns the query, which ends when the input does.
    The records of a batch are dealt to tasks by their hour, each hour to at most ``spread`` of them, so a batch writes few files
    of an hour, and a task sorts its share of one batch."""
    at = F.timestamp_seconds("recTime")
    rows = stream.withColumns({"date": F.date_format(at, "yyyyMMdd"), "hour": F.hour(at)})
    rows = rows.repartition("date", "hour", F.pmod(F.xxhash64(*stream.columns), F.lit(spread)))
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("date", "hour").trigger(availableNow=True).start()


def fresh(rows: DataFrame, key: Sequence[str] = ("host", "pid", "startTime"), most_age: int = 60) -> DataFrame:
    """The newest record of each key, sent again whenever a newer one comes; records more than ``most_age`` seconds behind
    the newest of the stream are left out, and a key that is silent for that long is forgotten."""
    return cache(rows, key, (), timeout=most_age, mode="append").where(~F.col("gone")).select(*rows.columns)


def by_topic(rows: DataFrame, host: str = "*", identifier: str = "*", subidentifier: str = "*") -> DataFrame:
    """Rows whose topic fits; each part is a word or a pattern in which ``*`` stands for any text."""
    for column, wanted in (("host", host), ("identifier", identifier), ("subidentifier", subidentifier)):
        if wanted.strip("*"):
            rows = rows.where(F.col(column).rlike("^" + ".*".join(re.escape(x) for x in wanted.split("*")) + "$") if "*" in wanted else F.col(column) == wanted)
    return rows
