"""Embedding tables: valid vectors, classes of equal vectors, and k-means on a bounded sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v (array of doubles) of the vectors that take part: not null, of the most frequent length (of those, the
    largest), without null or non-finite components, and not zero."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    good = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("v").isNotNull()).where(finite & F.col("id").isNotNull())
    most = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return good.where(F.size("v") == (most["n"] if most else 0))



def matrix(column) -> np.ndarray:
    """A list<double> Arrow column, without nulls, as rows of a matrix."""
    n = len(column)
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return column.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; large and tiny components neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (np.einsum("ij,ij->i", centres, centres) - 2 * x @ centres.T).argmin(axis=1)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """At most k centres of the rows, none of them empty."""
    distinct = np.unique(x, axis=0)
    k = min(k, len(distinct))
    centres = distinct[np.random.default_rng(seed).choice(len(distinct), k, replace=False)]
    for _ in range(rounds):
        of = nearest(x, centres)
        full = np.bincount(of, minlength=k) > 0
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        centres = sums[full] / np.bincount(of, minlength=k)[full][:, None]
        k = len(centres)
    return centres


def sample(classes: DataFrame, rows: int) -> np.ndarray:
    """Unit vectors of about ``rows`` classes, chosen by a hash of their ids; the bound holds whatever the size."""
    total = classes.count()
    share = min(1.0, rows / max(1, total))
    some = classes if share == 1 else classes.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 53)) < int(share * (1 << 53)))
    v = [r["v"] for r in some.select("id", "v").orderBy("id").limit(2 * rows).collect()]
    return unit(np.array(v)) if v else np.zeros((0, 0))
