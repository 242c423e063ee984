"""Process trees: parents, roots, subtrees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import ensure_checkpoints
from . import report


def flag_parents(processes: DataFrame, scope: Sequence[str] = ("host",), time_aware: bool = False) -> DataFrame:
    """``isParent``: some process of the host has this pid as its parent; a join on distinct (host, ppid). As pids are used
    again, ``time_aware`` asks for a child whose parent at its start is this very process."""
    if time_aware:
        children = parent_at_start(processes).where("parentStart IS NOT NULL")
        parents = children.select("host", F.col("ppid").alias("pid"), F.col("parentStart").alias("startTime")).distinct().withColumn("__p", F.lit(1))
        return processes.join(parents, ["host", "pid", "startTime"], "left").withColumn("isParent", F.coalesce("__p", F.lit(0))).drop("__p")
    parents = processes.select(*scope, F.col("ppid").alias("pid")).distinct().withColumn("__p", F.lit(1))
    return processes.join(parents, [*scope, "pid"], "left").withColumn("isParent", F.coalesce("__p", F.lit(0))).drop("__p")


def daily_parents(files: DataFrame) -> DataFrame:
    """In how many files (column ``file``) a process is a parent."""
    flags = files.select("file", "host", "startTime", "pid", "ppid").distinct()
    flagged = flag_parents(flags, ("file", "host")).select("file", "host", "startTime", "pid", "isParent").distinct()
    return flagged.groupBy("startTime", "pid", "host").agg(F.sum("isParent").alias("n_parent_files")).withColumn("isParent", (F.col("n_parent_files") > 0).cast("int"))


def roots(processes: DataFrame, job: Sequence[str] = ("identifier",)) -> DataFrame:
    """Processes whose parent is not in their job."""
    members = processes.select(*[F.col(c).alias(f"__{c}") for c in job], F.col("pid").alias("__pid")).distinct()
    same = F.col("ppid") == F.col("__pid")
    for c in job:
        same = same & (F.col(c) == F.col(f"__{c}"))
    return processes.join(members, same, "left_anti")


def parent_at_start(processes: DataFrame) -> DataFrame:
    """Each process with ``parentStart``: the latest start, up to its own, of a process of the host with its ppid. Starts
    and queries are merged in one sorted window, so no range join is needed."""
    known = processes.select("host", "pid", "startTime").distinct().select("host", F.col("pid").alias("__id"), F.col("startTime").alias("__at"), F.lit(0).alias("__kind"), F.col("startTime").alias("__start"), F.lit(None).cast("long").alias("pid"))
    asked = processes.select("host", F.col("ppid").alias("__id"), F.col("startTime").alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast("long").alias("__start"), "pid")
    w = Window.partitionBy("host", "__id").orderBy("__at", "__kind", "pid").rowsBetween(Window.unboundedPreceding, 0)
    both = known.unionByName(asked).withColumn("parentStart", F.last("__start", ignorenulls=True).over(w))
    return both.where("__kind = 1").select("host", "pid", F.col("__at").alias("startTime"), F.col("__id").alias("ppid"), "parentStart")


def levels(processes: DataFrame, scope: Sequence[str], paths: bool = True, steps: Sequence[str] = ("pid",)) -> DataFrame:
    """Level and path (from the root) of every process (scope, pid, ppid; one row each, of several parents the least counts).

    Each process points to an ancestor and knows how far it is; a round replaces the pointer by that of the ancestor, so its
    reach doubles, and a chain of n takes log2(n) joins. A process is done when its pointer is a root. A round in which
    none is done leaves only processes that no root leads to (their own parents, in a ring of parents, or below
    one): these have neither level nor path. A path holds ``steps`` of each process on it: the column itself if it is one, else
    a struct. Its size is the level, so ``paths=False`` is there for long chains."""
    ensure_checkpoints(processes.sparkSession)
    step = F.col(steps[0]) if len(steps) == 1 else F.struct(*steps)
    first = F.min(F.struct("ppid", *[c for c in steps if c not in ("pid", *scope)])).alias("__first")
    nodes = processes.groupBy(*scope, "pid").agg(first).select(*scope, "pid", "__first.*").withColumn("path", F.array(step) if paths else F.lit(None).cast("array<long>"))
    known = nodes.select(*scope, F.col("pid").alias("ppid"), F.lit(True).alias("__known"))
    start = nodes.select(*scope, "pid", "ppid", "path").join(known, [*scope, "ppid"], "left")
    at = start.select(*scope, "pid", F.when(F.col("__known"), F.col("ppid")).otherwise(F.col("pid")).alias("up"), F.when(F.col("__known"), 1).otherwise(0).alias("level"), "path", F.col("__known").isNull().alias("done")).checkpoint()
    left = at.where(~F.col("done")).count()
    while left:
        ahead = at.select(*scope, F.col("pid").alias("up"), F.col("up").alias("__up"), F.col("level").alias("__level"), F.col("path").alias("__path"), F.col("done").alias("__done"))
        moved = at.where(~F.col("done")).join(ahead, [*scope, "up"]).select(*scope, "pid", F.col("__up").alias("up"), (F.col("level") + F.col("__level")).alias("level"), F.concat("__path", "path").alias("path"), F.col("__done").alias("done"))
        at = at.where("done").unionByName(moved).checkpoint()
        before, left = left, at.where(~F.col("done")).count()
        if left == before:
            break
    ended = lambda c: F.when(F.col("done"), F.col(c)).alias(c)
    return at.select(*scope, "pid", ended("level"), *([ended("path")] if paths else []))


def listing(processes: DataFrame, job: Sequence[str] = ("identifier",)) -> DataFrame:
    """Processes of each job in the order of its tree: a process stands before its children, which go by (startTime, pid), with
    its level and ``place`` from 1. Rows are sorted by job and the starts and pids on the way from the root, by ranges, so that
    a job of any size is as many tasks as it needs. Of a pid that a job uses again the first start counts; processes without
    a root come last. A process of the same pid on another host is another process."""
    scope = list(dict.fromkeys([*job, "host"]))
    one = processes.groupBy(*scope, "pid").agg(F.min(F.struct("startTime", "ppid")).alias("p")).select(*scope, "pid", "p.*")
    ways = levels(one, scope, steps=("startTime", "pid"))
    rows = one.join(ways, [*scope, "pid"])
    placed = report.numbered(rows, [*job, F.col("path").asc_nulls_last(), "host", "startTime", "pid"], "__place")
    first = placed.groupBy(*job).agg(F.min("__place").alias("__first"))
    return placed.join(first, list(job)).select(*scope, "pid", "ppid", "startTime", "level", (F.col("__place") - F.col("__first") + 1).alias("place"))


def subtree(processes: DataFrame, seeds: DataFrame, scope: Sequence[str]) -> DataFrame:
    """All processes reached from the seeds (scope, pid) by parent links."""
    ensure_checkpoints(processes.sparkSession)
    nodes = processes.select(*scope, "pid", "ppid").distinct().checkpoint()
    found = seeds.select(*scope, "pid").distinct()
    new = found
    while True:
        children = nodes.join(new.select(*scope, F.col("pid").alias("ppid")), [*scope, "ppid"], "left_semi").select(*scope, "pid").distinct()
        new = children.join(found, [*scope, "pid"], "left_anti").checkpoint()
        if new.isEmpty():
            break
        found = found.unionByName(new)
    return found
