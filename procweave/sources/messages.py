"""Message batches and tagged text logs as record tables.

A batch is ``nRecords=N`` and then one record a line. procstat lines are plain and are split by built-in functions;
procdata and procfd hold texts with their lengths before them, so lines are read by position, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..schemas import PROCDATA, PROCFD, PROCSTAT_FIELDS

_NUMBERS = ("pid", "ppid", "recTime", "recTimeUSec", "startTime", "startTimeUSec")
_TEXTS = {"procdata": ("execName", "cmdArgs", "exePath", "cwdPath"), "procfd": ("path",)}
_TAIL = {"procdata": (), "procfd": ("fd", "mode")}
_SCHEMAS = {"procdata": PROCDATA, "procfd": PROCFD}
_ARROW = {"string": pa.string(), "long": pa.int64()}
#: Records that a parser holds before it sends them on, however many a batch of messages has.
RECORDS = 5_000


def procstat(messages: DataFrame) -> DataFrame:
    """Rows of procstat batches (topic, value). Lines that are short or not numeric are left out."""
    rows = messages.withColumn("t", text.topic(F.col("topic"))).where(F.col("t.type") == "procstat")
    lines = rows.select("t.host", "t.identifier", "t.subidentifier", F.explode(F.slice(F.split("value", "\n"), F.lit(2), F.size(F.split("value", "\n")))).alias("line"))
    parts = lines.withColumn("p", F.split("line", ",")).where(F.size("p") == len(PROCSTAT_FIELDS))
    fields = [F.get("p", i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(PROCSTAT_FIELDS)]
    return parts.select("host", "identifier", "subidentifier", *fields).where(F.col("pid").isNotNull())


def _records(kind: str, body: str) -> Iterator[dict]:
    """Records of a body; a broken one ends it, since nothing tells where the next begins."""
    raw, at = body.encode(), body.find("\n") + 1

    def upto(end: bytes) -> bytes:
        nonlocal at
        stop = raw.index(end, at)
        out, at = raw[at:stop], stop + len(end)
        return out

    while at < len(raw):
        try:
            row = {n: int(upto(b",")) for n in _NUMBERS}
            for i, name in enumerate(_TEXTS[kind]):
                n = int(upto(b","))
                last = i + 1 == len(_TEXTS[kind]) and not _TAIL[kind]
                if at + n > len(raw):
                    return
                row[name], at = raw[at : at + n].decode(errors="replace"), at + n
                if at < len(raw) and raw[at : at + 1] != (b"\n" if last else b","):
                    return
                at += 1
            for i, name in enumerate(_TAIL[kind]):
                end = b"\n" if i + 1 == len(_TAIL[kind]) else b","
                if raw.find(end, at) < 0:  # the last line may lack its end
                    row[name], at = int(raw[at:]), len(raw)
                else:
                    row[name] = int(upto(end))
        except ValueError:
            return
        yield row


def read_batches(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Batches of messages (host, identifier, subidentifier, value) as batches of at most ``RECORDS`` records."""
    names, kinds = zip(*[c.split() for c in _SCHEMAS[kind].split(", ")], strict=True)

    def read() -> Iterator[tuple]:
        for batch in batches:
            for at in range(batch.num_rows):  # one message at a time leaves Arrow's memory
                *topic, value = (c[at].as_py() for c in batch.columns)
                for r in _records(kind, value or ""):
                    yield (*topic, *[r[n] for n in names[3:]])

    records = read()
    while some := list(islice(records, RECORDS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, t in zip(zip(*some, strict=True), kinds, strict=True)], list(names))


def texts(messages: DataFrame, kind: str) -> DataFrame:
    """Rows of procdata or procfd batches (topic, value)."""
    rows = messages.withColumn("t", text.topic(F.col("topic"))).where(F.col("t.type") == kind).select("t.host", "t.identifier", "t.subidentifier", "value")
    return rows.mapInArrow(lambda batches: read_batches(batches, kind), _SCHEMAS[kind])


def losses(messages: DataFrame, kind: str) -> DataFrame:
    """What the parsers leave out: for each message its topic, how many records it says that it holds (``said``, null without a
    header), how many are ``read``, and ``lost``, those that were broken or stood behind a broken one."""
    rows = messages.withColumn("t", text.topic(F.col("topic"))).where(F.col("t.type") == kind).select("topic", "value")
    said = F.regexp_extract("value", r"^nRecords=([0-9]+)\n", 1).try_cast("bigint")
    if kind == "procstat":
        cells = lambda line: F.split(line, ",")
        good = F.filter(F.slice(F.split("value", "\n"), F.lit(2), F.size(F.split("value", "\n"))), lambda x: (F.size(cells(x)) == len(PROCSTAT_FIELDS)) & F.get(cells(x), 0).try_cast("bigint").isNotNull())
        counted = rows.select("topic", said.alias("said"), F.size(good).cast("long").alias("read"))
    else:

        def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield frame[["topic", "said"]].assign(read=[sum(1 for _ in _records(kind, v or "")) for v in frame["value"]])

        counted = rows.withColumn("said", said).mapInPandas(count, "topic string, said long, read long")
    return counted.withColumn("lost", F.when(F.col("said").isNotNull(), F.greatest(F.col("said") - F.col("read"), F.lit(0))))


def render(records: DataFrame, kind: str) -> DataFrame:
    """Records as one message per host, job and second: topic and value."""
    number = lambda c: F.col(c).cast("string")
    sized = lambda c: F.concat(F.octet_length(c).cast("string"), F.lit(","), F.col(c))
    parts = [number(n) for n, _ in PROCSTAT_FIELDS] if kind == "procstat" else [*map(number, _NUMBERS), *map(sized, _TEXTS[kind]), *map(number, _TAIL[kind])]
    lines = records.withColumn("line", F.concat_ws(",", *parts))
    bodies = lines.groupBy("host", "identifier", "subidentifier", F.col("recTime").alias("second")).agg(F.sort_array(F.collect_list("line")).alias("lines"))
    return bodies.select(F.concat_ws(".", "host", "identifier", "subidentifier", F.lit(kind)).alias("topic"), F.concat(F.lit("nRecords="), F.size("lines").cast("string"), F.lit("\n"), F.array_join("lines", "\n"), F.lit("\n")).alias("value"))


def tagged(lines: DataFrame, kind: str) -> DataFrame:
    """Lines ``type,host,id,subid,fields…`` (column ``value``) as messages of one record, for the parsers above."""
    tag = F.split("value", ",", 5)
    rows = lines.where(F.startswith("value", F.lit(kind + ",")))
    return rows.select(F.concat_ws(".", F.get(tag, 1), F.get(tag, 2), F.get(tag, 3), F.lit(kind)).alias("topic"), F.concat(F.lit("nRecords=1\n"), F.get(tag, 4), F.lit("\n")).alias("value"))
