"""One row per process from its samples: rates, correlations, net usage, identity, files, connections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scripts, text
from ..schemas import PROCESS, PROCSTAT_FIELDS, TIME

#: What a summary carries over from the latest undamaged sample: all 41 fields but the process, its parent and the times.
CARRIED = tuple(n for n, _ in PROCSTAT_FIELDS if n not in ("pid", "ppid", "recTime", "recTimeUSec", "startTime", "startTimeUSec"))


def series(procstat: DataFrame, key: Sequence[str] = PROCESS, order: Sequence[str] = TIME) -> DataFrame:
    """Samples with the five series: cpu, iow and ior per second since the sample before, msize and mres as they are.
    The first sample of a process has no rates; counters that drop give negative rates."""
    w = Window.partitionBy(*key).orderBy(*order)
    now = text.seconds(F.col("recTime"), F.col("recTimeUSec"))

    def rate(x: Column) -> Column:
        return F.try_divide((x - F.lag(x).over(w)).cast("double"), now - F.lag(now).over(w))

    later = F.lag(F.lit(1)).over(w).isNotNull()
    return procstat.withColumns({
        "cpuRate": rate(F.col("utime") + F.col("stime")) / 100.0,
        "iowRate": rate(F.col("io_wchar")),
        "iorRate": rate(F.col("io_rchar")),
        "msizeRate": F.when(later, F.col("m_size").cast("double")),
        "mresidentRate": F.when(later, F.col("m_resident").cast("double")),
        "undamaged": F.coalesce(F.col("utime") >= F.lag("utime").over(w), F.lit(True)),
    })


SERIES = ("cpuRate", "iowRate", "iorRate", "msizeRate", "mresidentRate")


def correlation(a: str, b: str, centre: str = "mean") -> Column:
    """Pearson correlation of two series; null below two samples or without variance. ``centre="sum"`` centres both on
    their sums instead of their means."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
    n, sx, sy = F.count(x), F.sum(x), F.sum(y)
    if centre == "mean":
        varies = [F.sum(v * v) - s * s / F.nullif(n, F.lit(0)) > 1e-9 * F.sum(v * v) for v, s in ((x, sx), (y, sy))]
        return F.when((n >= 2) & varies[0] & varies[1], F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))
    num = F.sum(x * y) + (n - 2) * sx * sy
    return F.when(n >= 2, F.try_divide(num, F.sqrt(F.sum(x * x) + (n - 2) * sx * sx) * F.sqrt(F.sum(y * y) + (n - 2) * sy * sy)))


def summarize(procstat: DataFrame, carry: Sequence[str] | None = None, key: Sequence[str] = PROCESS, centre: str = "mean", order: Sequence[str] = TIME) -> DataFrame:
    """The latest undamaged sample of each process with its record count, largest rates, cpu time, duration and the ten
    correlations. The window and the aggregate share one shuffle by process. ``carry``: columns of that sample, by default
    those of ``CARRIED`` that the table has; what a query does not use is not read."""
    carry = [c for c in CARRIED if c in procstat.columns] if carry is None else carry
    rows = series(procstat, key, order)
    at = F.struct(*order)
    last = F.max_by(F.struct("recTime", "recTimeUSec", "ppid", "identifier", "subidentifier", *carry), F.when(F.col("undamaged"), at))
    best = [F.max(c).alias(c + "Max") for c in SERIES]
    corr = [correlation(a, b, centre).alias(f"cor_{a[:-4]}X{b[:-4]}") for a, b in combinations(SERIES, 2)]
    out = rows.groupBy(*key).agg(last.alias("last"), F.count("*").alias("nRecords"), F.min(F.struct("identifier", "subidentifier")).alias("named"), *best, *corr)
    out = out.select(*key, "last.*", "named", "nRecords", *[c + "Max" for c in SERIES], *[f"cor_{a[:-4]}X{b[:-4]}" for a, b in combinations(SERIES, 2)])
    return out.withColumns({"identifier": F.col("named.identifier"), "subidentifier": F.col("named.subidentifier"), "cpuTime": (F.col("utime") + F.col("stime")) / 100.0, "duration": text.seconds(F.col("recTime") - F.col("startTime"), F.col("recTimeUSec"))}).drop("named")


def identity(procdata: DataFrame, key: Sequence[str] = PROCESS, fallback_last: bool = False, order: Sequence[str] = TIME) -> DataFrame:
    """The latest usable identity of each process (its path not unknown), with script and command."""
    at, what = F.struct(*order), F.struct("execName", "cmdArgs", "exePath", "cwdPath")
    known = F.max_by(what, F.when(~F.contains("exePath", F.lit("Unknown")), at))
    best = F.coalesce(known, F.max_by(what, at)) if fallback_last else known
    out = procdata.groupBy(*key).agg(best.alias("i")).select(*key, "i.*")
    out = out.withColumn("script", scripts.script(F.col("exePath"), F.col("cmdArgs")))
    return out.withColumns({"execCommand": scripts.basename(F.col("exePath")), "command": scripts.command(F.col("exePath"), F.col("script"))})


def observed(procobs: DataFrame, key: Sequence[str] = PROCESS) -> DataFrame:
    return procobs.groupBy(*key).agg(F.count("*").alias("nObservations"))


def volatility(records: Column, observations: Column) -> Column:
    return F.when(observations > 0, (records - 1) / observations).otherwise(F.lit(0.0))


def filesystem_use(procfd: DataFrame, labels: Sequence[tuple[str, str]], key: Sequence[str] = PROCESS) -> DataFrame:
    """Readable and writable descriptors by process and label; a label's regex matches the whole path, and a path may have
    several labels. Equal descriptors are counted together before any regex is tried."""
    counted = procfd.groupBy(*key, "path", "mode").count()
    hits = F.array_compact(F.array(*[F.when(F.col("path").rlike(f"^(?:{regex})$"), F.lit(label)) for label, regex in labels]))
    rows = counted.withColumn("filesystem", F.explode(hits))
    total = lambda bit: F.sum(F.when(bit, F.col("count")).otherwise(0))
    return rows.groupBy(*key, "filesystem").agg(total(text.readable(F.col("mode"))).alias("read"), total(text.writable(F.col("mode"))).alias("write"))


def filesystem_flags(procfd: DataFrame, labels: Sequence[tuple[str, str]], key: Sequence[str] = PROCESS) -> DataFrame:
    """One row per process with a 0/1 column for reading and for writing each label."""
    hit = lambda regex, bit: F.max((F.col("path").rlike(f"^(?:{regex})$") & bit).cast("int"))
    flags = [hit(regex, bit).alias(f"{label}_{name}") for label, regex in labels for name, bit in (("read", text.readable(F.col("mode"))), ("write", text.writable(F.col("mode"))))]
    return procfd.groupBy(*key).agg(*flags)


def connections(procfd: DataFrame, key: Sequence[str] = PROCESS) -> DataFrame:
    """Distinct tcp and udp connections of each process."""
    paths = procfd.where(F.col("path").rlike("^(tcp|udp):")).select(*key, "path").distinct()
    return paths.withColumn("c", text.connection(F.col("path"))).select(*key, "c.*")


def assemble(parts: Mapping[str, DataFrame], key: Sequence[str] = PROCESS, require: Sequence[str] = ()) -> DataFrame:
    """All parts, each already one row per process, side by side. Processes in any part stay, or with ``require`` those
    that every part named has; ``in_<part>`` says which have a process."""
    out = None
    for name, part in parts.items():
        part = part.withColumn(f"in_{name}", F.lit(True))
        out = part if out is None else out.join(part, list(key), "full_outer")
    out = out.withColumns({f"in_{n}": F.coalesce(f"in_{n}", F.lit(False)) for n in parts})
    for name in require:
        out = out.where(F.col(f"in_{name}"))
    return out


def net_of_baseline(summary: DataFrame, baseline: DataFrame, start: int, counters: Sequence[str], key: Sequence[str] = PROCESS) -> DataFrame:
    """``<counter>_net``: less the baseline's last value for processes that started before the window."""
    before = baseline.select(*key, *[F.col(c).alias(f"{c}_baseline") for c in counters])
    out = summary.join(before, list(key), "left")
    early = F.col("startTime") < start
    net = {f"{c}_net": F.col(c) - F.when(early, F.coalesce(f"{c}_baseline", F.lit(0))).otherwise(0) for c in counters}
    has = early & F.col(f"{counters[0]}_baseline").isNotNull()
    return out.withColumns(net | {"baseline_startTime": F.when(has, F.lit(start)).otherwise(F.col("startTime"))}).drop(*[f"{c}_baseline" for c in counters])


def net_of_first(procstat: DataFrame, start: int, counters: Sequence[str], key: Sequence[str] = PROCESS, order: Sequence[str] = TIME) -> DataFrame:
    """``<counter>_net``: last less first sample of the window for processes that started before it."""
    at = F.struct(*order)
    first, last = [[f(F.col(c), at) for c in counters] for f in (F.min_by, F.max_by)]
    early = F.col("startTime") < start
    return procstat.groupBy(*key).agg(*[b.alias(c) for b, c in zip(last, counters, strict=True)], *[a.alias(f"{c}_first") for a, c in zip(first, counters, strict=True)]).select(*key, *[(F.col(c) - F.when(early, F.col(f"{c}_first")).otherwise(0)).alias(f"{c}_net") for c in counters])
