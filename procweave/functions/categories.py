"""Category files: each category a list of patterns, loaded as a table of rules and tried on distinct values only.

A file holds a category in each row, or in each column if ``transposed``: its name first, then its patterns; empty cells
count for nothing. A pattern must match all of a value, and the first category of the file that has one wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules that are regular expressions stand in one plan; a file may hold this many of them. Literal ones are joined.
MOST_REGEXES = 5000
_PLAIN = r"^[^\\^$.|?*+()\[\]{}]*$"
_SCHEMA = "rank int, category string, pattern string, literal boolean"


def load(spark: SparkSession, path: str, *, transposed: bool = False, literal: bool = False) -> DataFrame:
    """Rules (rank, category, pattern, literal) of a comma-separated file. A pattern without a special character is literal, and
    with ``literal`` all are; a category without patterns has no rule."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("row", "line"))
    cells = lines.select("row", F.posexplode(F.split("line", ",")).alias("column", "cell")).select("row", "column", F.trim("cell").alias("cell")).where("cell != ''")
    of, place = ("column", "row") if transposed else ("row", "column")
    lists = cells.groupBy(F.col(of).alias("rank")).agg(F.transform(F.sort_array(F.collect_list(F.struct(place, "cell"))), lambda x: x["cell"]).alias("cells"))
    rules = lists.select("rank", F.get("cells", 0).alias("category"), F.explode(F.slice("cells", 2, F.size("cells"))).alias("pattern"))
    return rules.distinct().withColumn("literal", F.lit(True) if literal else F.col("pattern").rlike(_PLAIN))


def rules(spark: SparkSession, categories: Sequence[tuple[str, Sequence[str]]], literal: bool = False) -> DataFrame:
    """The table of rules of categories given in place."""
    rows = [(rank, name, pattern) for rank, (name, patterns) in enumerate(categories) for pattern in patterns]
    return spark.createDataFrame(rows, "rank int, category string, pattern string").withColumn("literal", F.lit(True) if literal else F.col("pattern").rlike(_PLAIN))


def _first_regex(value: Column, regexes: Sequence[tuple[int, str, Sequence[str]]]) -> Column:
    """(rank, category) of the first category with a regex that matches all of the value."""
    out = F.lit(None).cast("struct<rank:int,category:string>")
    for rank, name, patterns in reversed(regexes):
        hit = value.rlike("^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")$")
        out = F.when(hit, F.struct(F.lit(rank).cast("int").alias("rank"), F.lit(name).alias("category"))).otherwise(out)
    return out


def generalize(rows: DataFrame, column: str, table: DataFrame, other: str | None = None, name: str | None = None) -> DataFrame:
    """Rows with ``category_<category>`` of a column's values in its place (or as ``name``): else ``category_<other>``, or the value.

    Each distinct value is tried once: literal rules meet it in a join, the others are one alternation per category. Values
    and their categories are joined back to the rows. Null stays null."""
    found = table.where(~F.col("literal")).groupBy("rank", "category").agg(F.sort_array(F.collect_list("pattern")).alias("patterns"), F.count("*").alias("n")).orderBy("rank").limit(MOST_REGEXES + 1).collect()
    if sum(r["n"] for r in found) > MOST_REGEXES:
        raise ValueError(f"more than {MOST_REGEXES} regular expressions; make those literal that can be")
    values = rows.select(F.col(column).alias("__value")).where("__value IS NOT NULL").distinct()
    exact = table.where("literal").groupBy(F.col("pattern").alias("__value")).agg(F.min(F.struct("rank", "category")).alias("__exact"))
    regex = _first_regex(F.col("__value"), [(r["rank"], r["category"], r["patterns"]) for r in found])
    best = F.least(F.col("__exact"), regex)
    label = F.coalesce(F.concat(F.lit("category_"), best["category"]), F.lit(f"category_{other}") if other else F.col("__value"))
    known = values.join(exact, "__value", "left").select("__value", label.alias("__label"))
    return rows.join(known, F.col(column) == F.col("__value"), "left").drop("__value").withColumn(name or column, F.col("__label")).drop("__label")
