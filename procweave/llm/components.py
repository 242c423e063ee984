"""Connected components by alternating large and small stars, each round a few written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node is the upper end of one edge at most, and then the lower end of none. Only a count is collected."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    roles = edges.select(ends.alias("e")).groupBy("e.id").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down"))
    return roles.where((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0)).agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame, a: str = "a", b: str = "b") -> tuple[DataFrame, str]:
    """``id`` and ``component`` (least id reachable) of every end of an edge, and the path of the table that this reads;
    nodes without edges are not listed.

    Edges with a null end, from a node to itself, and repeated ones change nothing. Rounds end when only stars are left.
    """
    spark = edges.sparkSession
    ends = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now, path = storage.written(ends.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    while not _are_stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # minima are written, so that both sides of a join are plain shuffles, of which skewed parts can be split
        least, least_path = storage.written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
        large, large_path = storage.written(both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")), "large")
        low, low_path = storage.written(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        new, new_path = storage.written(small, "edges")
        storage.remove(spark, path, least_path, large_path, low_path)
        now, path = new, new_path
    centres = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(centres), path
