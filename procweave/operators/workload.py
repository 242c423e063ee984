"""Workload tables: repairs, filters, histograms, merges and axes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import shared

#: Rows that a task of ``axes`` adds up after they are expanded, about, and buckets in which frequent values are looked for.
DEALT, BUCKETS = 1_000_000, 1 << 16


@dataclass(frozen=True)
class Measure:
    """A column with histogram edges: bins are half open, the last one closed; null counts as 0."""

    name: str
    column: str
    bins: tuple[float, ...]


def repair(summary: DataFrame) -> DataFrame:
    """cpu_net, volatility, no negative durations, and a name for projects that have none."""
    return summary.withColumns({
        "cpu_net": (F.col("utime_net") + F.col("stime_net")) / 100.0,
        "volatilityScore": F.coalesce(F.try_divide((F.col("nRecords") - 1).cast("double"), F.col("nObservations")), F.lit(0.0)),
        "duration": F.greatest(F.col("duration"), F.lit(0)),
        "project": F.when(F.lower("project") == "nan", "Unknown").otherwise(F.coalesce("project", F.lit("Unknown"))),
    })


def useful(most_cpu: float = 16 * 86_400, most_duration: float = 86_700) -> Column:
    """Active, not a parent, or busy for half its time; and within plausible cpu and duration."""
    active = (F.col("volatilityScore") >= 0.1) | (F.col("isParent") == 0) | (F.col("cpu_net") >= 0.5 * F.col("duration"))
    return active & (F.col("cpu_net") < most_cpu) & (F.col("duration") < most_duration)


def histogram(x: Column, bins: Sequence[float]) -> Column:
    x = F.coalesce(x, F.lit(0))
    last = len(bins) - 2
    return F.array(*[F.count_if((x >= a) & ((x <= b) if i == last else (x < b))) for i, (a, b) in enumerate(zip(bins, bins[1:], strict=False))])


def table(rows: DataFrame, dims: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Count, sum and histogram of each measure by dimensions, in one pass with partial aggregation."""
    out = []
    for m in measures:
        out += [F.count(m.column).alias(f"{m.name}_count"), F.sum(m.column).alias(f"{m.name}_sum"), histogram(F.col(m.column), m.bins).alias(f"{m.name}_histogram")]
    return rows.groupBy(*dims).agg(*out)


def merge(tables: Sequence[DataFrame], keys: Sequence[str], lengths: Mapping[str, int]) -> DataFrame:
    """Counts, sums and histograms (lengths by column) of several tables added up."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t, allowMissingColumns=True)
    out = []
    for c in (c for c in rows.columns if c not in keys):
        out.append((F.array(*[F.coalesce(F.sum(F.get(c, i)), F.lit(0)) for i in range(lengths[c])]) if c in lengths else F.sum(c)).alias(c))
    return rows.groupBy(*keys).agg(*out)


def keys_of(rows: DataFrame) -> list[str]:
    """Keys of a workload table: columns that hold no measure."""
    return [c for c in rows.columns if not c.endswith(("_sum", "_count", "_histogram"))]


def axes(rows: DataFrame, sets: Sequence[Sequence[str]], sums: Sequence[str], deal: Sequence[str] = ()) -> DataFrame:
    """Sums over each set of keys; ``axis`` names the set, and keys outside it are null.

    Rows are added up by all keys first, so only the small table is expanded. That table is as large as the rows where keys
    have many values; name these in ``deal``. Rows then are kept once in the shared folder, and for each key of ``deal`` dealt by
    its values to tasks of about ``DEALT`` expanded rows, which add up all sets with that key where the rows lie. The rows of
    values that are too frequent for a task, and the sets without such a key, are added up as above."""
    keys = sorted({k for s in sets for k in s})
    if not deal:
        return _expanded(rows, keys, sets, sums)
    path = shared.new_folder(rows.sparkSession, "axes")
    rows.select(*keys, *sums).write.parquet(path)
    kept = rows.sparkSession.read.schema(rows.select(*keys, *sums).schema).parquet(path)
    n, left, parts = kept.count(), list(sets), []
    for home in deal:
        mine, left = [s for s in left if home in s], [s for s in left if home not in s]
        if mine:
            parts += _by_home(kept, n, home, keys, mine, sums)
    if left:
        parts.append(_expanded(kept, keys, left, sums))
    return reduce(DataFrame.unionByName, parts)


def _expanded(rows: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], sums: Sequence[str]) -> DataFrame:
    used = [k for k in keys if any(k in s for s in sets)]
    small = rows.groupBy(*used).agg(*[F.sum(c).alias(c) for c in sums])
    label = F.lit(None).cast("string")
    for s in sets:
        inside = F.lit(True)
        for k in used:
            inside = inside & (F.grouping(k) == (0 if k in s else 1))
        label = F.when(inside, F.lit("*".join(s))).otherwise(label)
    out = small.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in used]).agg(label.alias("axis"), *[F.sum(c).alias(c) for c in sums])
    return _all_keys(rows, out, keys, sums)


def _all_keys(rows: DataFrame, out: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    kinds = dict(rows.dtypes)
    return out.select(*[F.col(k) if k in out.columns else F.lit(None).cast(kinds[k]).alias(k) for k in keys], "axis", *sums)


def _by_home(rows: DataFrame, n: int, home: str, keys: Sequence[str], sets: Sequence[Sequence[str]], sums: Sequence[str]) -> list[DataFrame]:
    """Sums over sets that all hold the key ``home``, without another exchange behind the one by that key."""
    tasks = n * len(sets) // DEALT + 1
    bucket = F.pmod(F.xxhash64(home), F.lit(BUCKETS))
    # at most a thousand buckets, one row each, can hold more than that
    full = [r["bucket"] for r in rows.groupBy(bucket.alias("bucket")).count().where(F.col("count") > max(n // tasks, n // 1000)).collect()] if tasks > 1 else []
    others = [k for k in keys if k != home and any(k in s for s in sets)]
    kinds = dict(rows.dtypes)
    one = [F.struct(F.lit("*".join(s)).alias("axis"), *[(F.col(k) if k in s else F.lit(None).cast(kinds[k])).alias(k) for k in others]) for s in sets]
    dealt = (rows.where(~bucket.isin(full)) if full else rows).select(home, *others, *sums).repartition(tasks, home)
    each = dealt.select(home, *sums, F.explode(F.array(*one)).alias("__one")).select(home, "__one.*", *sums)
    out = [_all_keys(rows, each.groupBy(home, "axis", *others).agg(*[F.sum(c).alias(c) for c in sums]), keys, sums)]
    if full:
        out.append(_expanded(rows.where(bucket.isin(full)), keys, sets, sums))
    return out


def classify_distinct(rows: DataFrame, column: str, category: Column, name: str) -> DataFrame:
    """A category computed once for each distinct value and joined back."""
    values = rows.select(column).distinct().withColumn(name, category)
    return rows.join(values, rows[column].eqNullSafe(values[column]), "left").drop(values[column])


def shares(rows: DataFrame, key: str, category: str, value: str) -> DataFrame:
    """Share of each category in its key's total; small shares have no label, large ones a full one."""
    sums = rows.groupBy(key, category).agg(F.sum(value).alias("total"))
    share = F.try_divide(F.col("total").cast("double"), F.sum("total").over(Window.partitionBy(key)))
    out = sums.withColumn("share", share)
    label = F.when(F.col("share") < 0.005, "").when(F.col("share") > 0.025, F.concat(F.col(category), F.format_string(" %.1f%%", F.col("share") * 100))).otherwise(F.col(category))
    return out.withColumn("label", label)


def empty_names(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows have nothing in each column; a gate fails if any count is not 0."""
    return rows.agg(*[F.count_if(F.coalesce(F.col(c), F.lit("")) == "").alias(f"empty_{c}") for c in columns])


def check_names(rows: DataFrame, columns: Sequence[str]) -> None:
    bad = {c: n for c, n in empty_names(rows, columns).first().asDict().items() if n}
    if bad:
        raise ValueError(f"rows without a name: {bad}")


def reconcile(rows: DataFrame, selected: Column, groups: Sequence[str], value: str) -> DataFrame:
    """Totals before and after a selection, with the number of groups: one row."""
    kept = F.when(selected, F.col(value))
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(selected).alias("n_selected"), F.sum(value).alias("total"), F.sum(kept).alias("total_selected"), F.count_distinct(*groups).alias("n_groups"))


def flag_histogram(rows: DataFrame, flag: str, value: str, bins: int, low: float, high: float) -> DataFrame:
    """Counts of equal bins over [low, high] by a flag; out of range is dropped, the upper edge is in the last bin."""
    at = F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins))
    place = F.when(F.col(value) == high, bins).otherwise(at)
    return rows.withColumn("bin", place).where(F.col("bin").between(1, bins)).groupBy(flag, "bin").count()
