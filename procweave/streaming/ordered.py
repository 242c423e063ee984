"""Keyed state over record time: rows wait in a buffer until the watermark has passed them, and are then worked
on in the order of their times, whatever the batches that brought them.

Keys are dealt into ``GROUPS`` groups, whose state is read and written as a whole: a call of the state store costs far more than a
row, so a group's calls are shared by its keys.

So a stream gives the rows that a sorted table would give: rows that are at most ``late`` behind the newest record count,
older ones are left out. Time is that of the records; a stream over finished input ends, and gives the same rows again.

Where nothing is remembered beyond a span of time (``by_span``), rows need no state in Python: Spark's own aggregates keep them until
the span is over, and SQL functions do the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Groups into which keys are dealt; a stream that has begun keeps its number.
GROUPS = 2048

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Keyed state with timers needs the RocksDB store; a session that names another one of its own keeps it."""
    if "HDFSBacked" in spark.conf.get(_PROVIDER, "HDFSBacked"):
        spark.conf.set(_PROVIDER, _ROCKSDB)


def ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)


def order_of(columns: Sequence[str]) -> list[int]:
    """Places of the columns that order observations; rows equal in all of them stay as they came."""
    first = [c for c in ("recTime", "recTimeUSec", "event_id") if c in columns]
    return [columns.index(c) for c in first]


def in_order(rows: Iterable[tuple], order: Sequence[int]) -> list[tuple]:
    """Nulls first."""
    return sorted(rows, key=lambda r: [(r[i] is not None, r[i] or 0) for i in order])


class Grouped(StatefulProcessor):
    """State of a group of keys, with one timer at a time."""

    def __init__(self, schema: str, columns: Sequence[str], key: Sequence[str]):
        self.schema, self.columns = schema, list(columns)
        self.order, self.at = order_of(self.columns), self.columns.index("recTime")
        self.key = [self.columns.index(c) for c in key]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.timer = handle.getValueState("timer", "at long", None)
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def look(self, at: int, again: bool = False) -> None:
        """Look at the group at a time (ms), or sooner if it is already to be; ``again``: the timer before has run out."""
        old = None if again else self.timer.get()
        if old is not None and old[0] <= at:
            return
        if old is not None:
            self.handle.deleteTimer(old[0])
        self.timer.update((at,))
        self.handle.registerTimer(at)

    def close(self) -> None:
        pass


class Ordered(Grouped):
    """``work(last, rows in order, watermark)`` yields what is to be sent, changes ``last``, the rows that are remembered by the columns
    of ``slot``, and leaves in ``wake`` the time (ms) at which they want to be looked at again although no row has come, or none."""

    def __init__(self, schema: str, columns: Sequence[str], key: Sequence[str], within: Sequence[str] = ()):
        super().__init__(schema, columns, key)
        self.slot = self.key + [self.columns.index(c) for c in within]
        self.wake: int | None = None

    def work(self, last: dict[tuple, tuple], rows: list[tuple], now: int) -> Iterator[Row]:
        raise NotImplementedError

    def slot_of(self, row: tuple) -> tuple:
        return tuple([row[i] for i in self.slot])

    def soon(self, at: int) -> None:
        self.wake = at if self.wake is None else min(self.wake, at)

    def open(self, handle):
        self.waiting = handle.getListState("waiting", self.schema, None)
        self.last = handle.getListState("last", self.schema, None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = len(self.columns)
        new = [tuple(r)[:n] for r in rows]
        self.waiting.appendList(new)
        self.look(min(r[self.at] for r in new) * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        ready, left = [], []
        for row in self.waiting.get() if self.waiting.exists() else ():
            (ready if row[self.at] * 1000 <= now else left).append(tuple(row))
        known = {self.slot_of(r): tuple(r) for r in self.last.get()} if self.last.exists() else {}
        last = dict(known)
        self.wake = None
        yield from self.work(last, in_order(ready, self.order), now)
        for state, old, rows in ((self.waiting, ready, left), (self.last, known != last, list(last.values()))):
            if old and rows:
                state.put(rows)
            elif old:
                state.clear()
        if self.wake is not None:
            self.wake = max(self.wake, now + 1)
        if left:
            self.soon(min(r[self.at] for r in left) * 1000)
        if self.wake is None:
            self.timer.clear()
        else:
            self.look(self.wake, again=True)


def in_groups(rows: DataFrame, key: Sequence[str], late: str) -> DataFrame:
    """Rows that have a ``recTime`` (seconds), with their time, of which the watermark is made, and the group of their key."""
    timed = rows.where(F.col("recTime").isNotNull()).withColumn("__at", F.timestamp_seconds("recTime")).withWatermark("__at", late)
    return timed.withColumn("__group", F.pmod(F.xxhash64(*key), F.lit(GROUPS)))


def run(rows: DataFrame, key: Sequence[str], processor: StatefulProcessor, schema: str, late: str, mode: str = "append") -> DataFrame:
    """The processor over a stream of rows with ``recTime`` (seconds); rows without one are left out."""
    use_state_store(rows.sparkSession)
    return in_groups(rows, key, late).groupBy("__group").transformWithState(processor, schema, mode, "EventTime")


def by_span(rows: DataFrame, key: Sequence[str], work: Callable[[Column], Column], seconds: int, late: str) -> DataFrame:
    """The rows that ``work`` leaves of each group's array of rows of a span of ``seconds``, in order of key and time. A span is
    worked on when the watermark has passed its end; until then rows count that are later than ``late``, too."""
    use_state_store(rows.sparkSession)
    first = [*key, *(c for c in ("recTime", "recTimeUSec", "event_id") if c in rows.columns and c not in key)]
    own = F.struct(*first, *[c for c in rows.columns if c not in first])
    spans = in_groups(rows, key, late).groupBy(F.window("__at", f"{seconds} seconds"), "__group").agg(F.sort_array(F.collect_list(own)).alias("rows"))
    return spans.select(F.inline(work(F.col("rows")))).select(*rows.columns)


def last_of_runs(key: Sequence[str], compare: Sequence[str]) -> Callable[[Column], Column]:
    """Of rows in order of key and time, the last of each run of equal ``compare`` columns of a key."""

    def work(rows: Column) -> Column:
        own = lambda row: F.struct(*[row[c] for c in (*key, *compare)])
        later = lambda i: F.get(rows, i + 1)
        return F.filter(rows, lambda row, i: later(i).isNull() | ~own(row).eqNullSafe(own(later(i))))

    return work


class Collapse(Ordered):
    """The last row of each run of equal ``compare`` columns, for each ``within`` of the key (descriptors of a process). Runs
    end when a key has been silent for ``silence`` seconds."""

    def __init__(self, schema: str, columns: Sequence[str], key: Sequence[str], within: Sequence[str], compare: Sequence[str], silence: int):
        super().__init__(schema, columns, key, within)
        self.compare = [self.columns.index(c) for c in compare]
        self.silence = silence
        self.row = Row(*self.columns)

    def _ends(self, old: tuple, new: tuple) -> bool:
        return new[self.at] - old[self.at] > self.silence or any(old[i] != new[i] for i in self.compare)

    def work(self, last, rows, now):
        for new in rows:
            slot = self.slot_of(new)
            old = last.get(slot)
            if old is not None and self._ends(old, new):
                yield self.row(*old)
            last[slot] = new
        for slot, row in list(last.items()):
            until = 1000 * (row[self.at] + self.silence)
            if until <= now:
                yield self.row(*last.pop(slot))
            else:
                self.soon(until)


class Rates(Ordered):
    """The change per second of each counter since the sample before; samples of one time have one rate, from the first."""

    def __init__(self, schema: str, columns: Sequence[str], key: Sequence[str], counters: Sequence[str], silence: int):
        super().__init__(schema, columns, key)
        self.counters = [self.columns.index(c) for c in counters]
        self.usec = self.columns.index("recTimeUSec") if "recTimeUSec" in self.columns else None
        self.silence = silence
        self.row = Row(*key, "recTime", *(["recTimeUSec"] if self.usec is not None else []), *[f"{c}_rate" for c in counters])

    def _time(self, row: tuple) -> float:
        return row[self.at] + (row[self.usec] / 1e6 if self.usec is not None else 0)

    def work(self, last, rows, now):
        for new in rows:
            slot = self.slot_of(new)
            old = last.get(slot)
            gap = self._time(new) - self._time(old) if old is not None else 0
            if old is not None and gap <= 0:
                continue
            if old is not None and gap <= self.silence:
                change = [None if new[i] is None or old[i] is None else (new[i] - old[i]) / gap for i in self.counters]
                yield self.row(*slot, new[self.at], *([new[self.usec]] if self.usec is not None else []), *change)
            last[slot] = new
        for slot, row in list(last.items()):
            until = (row[self.at] + self.silence) * 1000
            if until <= now:
                del last[slot]
            else:
                self.soon(until)


class Newest(Ordered):
    """Two inputs of one key in one stream (column ``side`` of 0 or 1): the newest row of each is remembered, and when their
    times are equal the pair is sent, once for a time."""

    def __init__(self, schema: str, columns: Sequence[str], key: Sequence[str], names: Sequence[str], left: Sequence[str], right: Sequence[str], silence: int):
        super().__init__(schema, columns, key, ("side",))
        self.take = [(0, self.columns.index(c)) for c in left] + [(1, self.columns.index(c)) for c in right]
        self.silence = silence
        self.row = Row(*names)

    def work(self, last, rows, now):
        by_key: dict[tuple, list[tuple]] = {}
        for row in rows:
            by_key.setdefault(self.slot_of(row)[:-1], []).append(row)
        for key, own in by_key.items():
            for i, row in enumerate(own):
                last[self.slot_of(row)] = row
                if i + 1 < len(own) and own[i + 1][self.at] == row[self.at]:
                    continue  # more of this time to come
                pair = last.get((*key, 0)), last.get((*key, 1))
                if None not in pair and pair[0][self.at] == pair[1][self.at]:
                    yield self.row(*[pair[side][c] for side, c in self.take])
        for slot, row in list(last.items()):
            until = (row[self.at] + self.silence) * 1000
            if until <= now:
                del last[slot]
            else:
                self.soon(until)


class Cache(Grouped):
    """The newest batch of a key (all its rows of the newest second), sent again whenever it changes, with what became of
    the members of the batch before. Nothing waits here: a live view shows what has come; a batch that is older than the newest
    of its key, or that the watermark has passed, is left out."""

    def __init__(self, schema: str, columns: Sequence[str], key: Sequence[str], member: Sequence[str], counters: Sequence[str], state: str | None, timeout: int):
        super().__init__(schema, columns, key)
        self.member = [self.columns.index(c) for c in member]
        self.counters = [self.columns.index(c) for c in counters]
        self.state = self.columns.index(state) if state else None
        self.timeout = timeout
        self.row = Row(*self.columns, *[f"{c}_delta" for c in counters], "dt", "since", "gone")

    def open(self, handle):
        self.batch = handle.getListState("batch", f"{self.schema}, since long", None)

    def _by_key(self, rows: Iterable[tuple]) -> dict[tuple, list[tuple]]:
        out: dict[tuple, list[tuple]] = {}
        for row in rows:
            out.setdefault(tuple([row[i] for i in self.key]), []).append(tuple(row))
        return out

    def _keep(self, batches: dict[tuple, list[tuple]], again: bool = False) -> None:
        """Of each key the rows of its newest second, and a timer for the key that is to be gone first."""
        if batches:
            self.batch.put([row for rows in batches.values() for row in rows])
            self.look((min(rows[0][self.at] for rows in batches.values()) + self.timeout + 1) * 1000, again)
        else:
            self.batch.clear()
            self.timer.clear()

    def _sent(self, row: tuple, old: tuple | None, since: int | None, gone: bool) -> Row:
        delta = [None if old is None or row[i] is None or old[i] is None else row[i] - old[i] for i in self.counters]
        return self.row(*row, *delta, None if old is None else row[self.at] - old[self.at], since, gone)

    def _changed(self, before: dict[tuple, tuple], rows: list[tuple], now: int, out: dict[tuple, Row]) -> dict[tuple, tuple]:
        """The batch of a key after some rows, in order, and in ``out`` what is to be sent of its members."""
        n, time = len(self.columns), max((r[self.at] for r in before.values()), default=None)
        by_time: dict[int, dict[tuple, tuple]] = {}
        for row in rows:
            if row[self.at] * 1000 > now and (time is None or row[self.at] >= time):
                by_time.setdefault(row[self.at], {})[tuple(row[i] for i in self.member)] = row
        for at in sorted(by_time):
            batch = dict(before) if at == time else {}
            for member, row in by_time[at].items():
                old = before.get(member)
                same = old is not None and self.state is not None and old[self.state] == row[self.state]
                since = old[n] if same else row[self.at]
                batch[member] = (*row, since)
                out[member] = self._sent(row, old[:n] if old else None, since, False)
            for member, old in before.items():
                if member not in batch:
                    out[member] = self._sent(old[:n], None, old[n], True)
            before, time = batch, at
        return before

    def handleInputRows(self, key, rows, timerValues):
        n, now = len(self.columns), timerValues.getCurrentWatermarkInMs()
        batches = self._by_key(self.batch.get()) if self.batch.exists() else {}
        sent = []
        for k, new in self._by_key(in_order((tuple(r)[:n] for r in rows), self.order)).items():
            out: dict[tuple, Row] = {}
            after = self._changed({tuple(r[i] for i in self.member): r for r in batches.get(k, ())}, new, now, out)
            if out:
                batches[k] = list(after.values())
                sent += out.values()
        if sent:
            self._keep(batches)
        return iter(sent)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        batches = self._by_key(self.batch.get()) if self.batch.exists() else {}
        for k, rows in list(batches.items()):
            if (rows[0][self.at] + self.timeout) * 1000 < now:
                del batches[k]
                for row in rows:
                    yield self._sent(row[:-1], None, row[-1], True)
        self._keep(batches, again=True)
