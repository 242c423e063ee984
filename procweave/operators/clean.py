"""Validation of raw records and the collapse of repeated samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_PID, MAX_FD, MAX_PATH = 1_000_000, 500_000, 1024


def _identity_code(now: int) -> Column:
    pid, ppid, start, rec = (F.col(c) for c in ("pid", "ppid", "startTime", "recTime"))
    return F.when((pid < 1) | (pid > MAX_PID), 1).when(ppid > MAX_PID, 2).when((start == 0) | (start > now), 3).when((rec == 0) | (rec > now), 4)


def stat_code(now: int) -> Column:
    """0 for a good sample, else the first check that it fails. ``now``: seconds, later times are in the future."""
    return _identity_code(now).otherwise(0)


def data_code(now: int, path: str = "exePath") -> Column:
    return _identity_code(now).when(F.length(path) > MAX_PATH, 5).when(F.col(path).rlike(r"[^\x00-\x7F]"), 6).otherwise(0)


def fd_code(now: int) -> Column:
    return _identity_code(now).when(F.length("path") > MAX_PATH, 5).when(F.col("path").rlike(r"[^\x00-\x7F]"), 6).when(F.col("fd") > MAX_FD, 7).otherwise(0)


def good_sockets(netstat: DataFrame) -> DataFrame:
    return netstat.where(F.col("type").isin(0, 1) & (F.col("inode") != 0))


def limit_fds(procfd: DataFrame, most: int = 10) -> DataFrame:
    """Without the standard descriptors and those past the limit of a process."""
    return procfd.where(F.col("fd").between(3, 2 + most))


# The columns whose change keeps a record of each type. procdata also compares the length of cmdArgs, which
# cmdArgs itself implies.
COMPARED = {
    "procstat": ("pid", "ppid", "state", "realUid", "effUid", "realGid", "effGid", "utime", "stime", "priority", "vsize", "rss", "rsslim", "delayacctBlkIOTicks", "vmpeak", "rsspeak", "guestTime", "io_rchar", "io_wchar", "io_syscr", "io_syscw", "io_readBytes", "io_writeBytes"),
    "procdata": ("pid", "ppid", "startTime", "startTimeUSec", "cmdArgs", "exePath", "cwdPath"),
    "procfd": ("pid", "ppid", "startTime", "startTimeUSec", "path", "fd", "mode"),
}
COLLAPSE_KEYS = {"procstat": ("host", "pid"), "procdata": ("host", "pid"), "procfd": ("host", "pid", "fd")}


def compared(kind: str, columns: Sequence[str], strict_reference: bool = False) -> tuple[str, ...]:
    """Columns of a table that the collapse of its type compares. procstat's own comparison leaves out startTime, so that a
    pid used again with equal counters would go on a run; it is added unless ``strict_reference``."""
    names = COMPARED[kind] if strict_reference or "startTime" in COMPARED[kind] else (*COMPARED[kind], "startTime")
    return tuple(c for c in names if c in columns)


def collapse_records(rows: DataFrame, kind: str, strict_reference: bool = False) -> DataFrame:
    """``collapse`` by the key, comparison and order of a record type (netstat, and other types: every row stays)."""
    if kind not in COMPARED:
        return rows
    order = [c for c in ("recTime", "recTimeUSec", "event_id") if c in rows.columns]
    return collapse(rows, COLLAPSE_KEYS[kind], compared(kind, rows.columns, strict_reference), order)


def match_any(rows: DataFrame, column: str, patterns: Sequence[str]) -> DataFrame:
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.col(column).rlike(p)
    return rows.where(hit)


def collapse(rows: DataFrame, key: Sequence[str], compare: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Only the last row of each run of equal ``compare`` columns, by key in order. ``order`` must be unique in a key;
    without columns to compare every row stays."""
    if not compare:
        return rows
    own = F.struct(*compare)
    later = F.lead(own).over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("__later", later).where(F.col("__later").isNull() | ~F.struct(*compare).eqNullSafe(F.col("__later"))).drop("__later")


def observations(procstat: DataFrame) -> DataFrame:
    """One marker for each accepted sample."""
    return procstat.select("host", "identifier", "subidentifier", "pid", "recTime", "recTimeUSec", "startTime")


def runs(rows: DataFrame, key: Sequence[str], column: str, order: Sequence[str], time: str) -> DataFrame:
    """``since``: the time at which the current run of equal values of a column began."""
    w = Window.partitionBy(*key).orderBy(*order)
    changed = F.when(F.lag(column).over(w).eqNullSafe(F.col(column)) & F.lag(F.lit(1)).over(w).isNotNull(), 0).otherwise(1)
    numbered = rows.withColumn("__changed", changed).withColumn("__run", F.sum("__changed").over(w))
    return numbered.withColumn("since", F.min(time).over(Window.partitionBy(*key, "__run"))).drop("__changed", "__run")
