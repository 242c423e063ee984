"""What each filter of a chain removes, in every order, from sorted posting lists.

Each document fails some of the filters. Rows of (part, doc_id, failures) are dealt by ranges of ids; a range is cut into
blocks, and a block keeps, for each part, one sorted list of failing ids per filter and of all ids, good ids and
toxic ids. What a filter removes after a set of others is the difference of its list and the union of theirs, found by
galloping: the shorter list steps through the longer one by binary search. There are 2^k unions and k * 2^(k-1)
differences for k filters, whatever the number of orders. Blocks share no ids, so their sizes are summed, and each order
is a path through the sets.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage

FILTERS = "ABCDE"
#: Rows of a block: it bounds the memory of a task, not the result.
BLOCK = 1 << 16
#: Copies of one text meet in this many pre-aggregated groups for each partition of a shuffle.
SALTS = 4

_CAPITALS, _CONTINUED, _MARKS = bytes(range(65, 91)), bytes(range(128, 192)), re.compile(rb"[#$%&*|]").search
_JUDGED = "part string, doc_id long, digest binary, fails int"


def judge(docs: DataFrame, *, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """part, doc_id, digest of the text and the filters A to D that it fails (bit i for filter i). Null text is empty."""
    rows = docs.select(F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fails, digests = [], []
            for text in batch["text"].to_pylist():
                words = text.split()  # bytes are split at x20 and x09 to x0D
                n = len(words)
                points = len(text) if text.isascii() else len(text.translate(None, _CONTINUED))
                capitals = len(text) - len(text.translate(None, _CAPITALS))
                fails.append((n < 200) | (100 * len(set(words)) < 50 * n) << 1 | (100 * capitals > 3 * points) << 2 | (_MARKS(text) is not None) << 3)
                digests.append(hashlib.sha256(text).digest())
            yield pa.RecordBatch.from_arrays([batch["part"], batch["doc_id"], pa.array(digests, pa.binary()), pa.array(fails, pa.int32())], names=["part", "doc_id", "digest", "fails"])

    return rows.mapInArrow(work, _JUDGED)


def with_copies(judged: DataFrame) -> DataFrame:
    """Filter E too: a smaller doc_id of any part has the same text (SHA-256). A row without an id comes last and fails if any
    row with an id has its text. Copies meet by (digest, salt) first, so that a text of a third of all rows is many groups."""
    salts = SALTS * int(judged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = judged.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    some = salted.groupBy("digest", "salt").agg(F.min("doc_id").alias("least"))
    all_of = some.groupBy("digest").agg(F.min("least").alias("first"))
    first = some.join(all_of, "digest").select("digest", "salt", "first")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.col("first").isNotNull())
    return salted.join(first, ["digest", "salt"]).select("part", "doc_id", F.col("fails").bitwiseOR(F.when(copy, 1 << 4).otherwise(0)).alias("fails"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """good and toxic: some label row of the id says so. Rows without an id have no label."""
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return rows.join(known, "doc_id", "left").select("part", "doc_id", "fails", (F.coalesce("good", F.lit(0)) + 2 * F.coalesce("toxic", F.lit(0))).alias("labels"))


def union(lists: list[np.ndarray]) -> np.ndarray:
    """Ids of any of the sorted lists, longest first: what a shorter one adds is merged in at its places."""
    out, *others = sorted(lists, key=len, reverse=True)
    for one in others:
        new = difference(one, out)
        out = np.insert(out, np.searchsorted(out, new), new)
    return out


def difference(ids: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Ids of the sorted list that none of the others has."""
    for other in others:
        if not len(ids) or not len(other):
            continue
        if len(ids) <= len(other):
            at = np.searchsorted(other, ids)
            ids = ids[other[np.minimum(at, len(other) - 1)] != ids]
        else:
            at = np.searchsorted(ids, other)
            inside = at < len(ids)
            ids = np.delete(ids, at[inside][ids[at[inside]] == other[inside]])
    return ids


def _sizes(fails: np.ndarray, labels: np.ndarray, k: int) -> tuple[int, list[list[int]]]:
    """Rows of a part in a block, and what filter f removes after the set s, at place s * k + f: all, good and toxic ids.
    An id is the row's place in the block's order of doc_id."""
    failing = [np.flatnonzero(fails >> f & 1) for f in range(k)]
    good, toxic = np.flatnonzero(labels & 1), np.flatnonzero(labels & 2)
    unions: list[np.ndarray] = [np.empty(0, np.int64)]
    for s in range(1, 1 << k):
        low = s & -s
        unions.append(union([unions[s ^ low], failing[low.bit_length() - 1]]))
    out = [[0] * (k << k) for _ in range(3)]
    for s in range(1 << k):
        for f in range(k):
            if not s >> f & 1:
                gone = difference(failing[f], unions[s])
                out[0][s * k + f] = len(gone)
                for i, other in ((1, good), (2, toxic)):
                    out[i][s * k + f] = len(gone) - len(difference(gone, other))
    return len(fails), out


_SIZES = "part string, n long, removed array<long>, good array<long>, toxic array<long>"


def block_sizes(rows: DataFrame, filters: str = FILTERS, block: int = BLOCK) -> DataFrame:
    """Sizes by part and block of rows (part, doc_id, fails, labels), dealt by ranges of (part, doc_id)."""
    k = len(filters)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.table(batch)
            for i in range(0, len(table), block):
                some = table.slice(i, block)
                order = np.argsort(some["doc_id"].fill_null(np.iinfo(np.int64).max).to_numpy(), kind="stable")
                fails, labels = some["fails"].to_numpy()[order], some["labels"].to_numpy()[order]
                parts = some["part"].combine_chunks().dictionary_encode()
                codes = parts.indices.to_numpy()[order]
                out = [(part, *_sizes(fails[codes == c], labels[codes == c], k)) for c, part in enumerate(parts.dictionary.to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int64()), *[pa.array([r[2][j] for r in out], pa.list_(pa.int64())) for j in range(3)]], names=["part", "n", "removed", "good", "toxic"])

    dealt = rows.repartitionByRange("part", "doc_id", F.xxhash64("fails", "labels", F.monotonically_increasing_id())).sortWithinPartitions("part", "doc_id")
    return dealt.select("part", "doc_id", "fails", "labels").mapInArrow(work, _SIZES)


_AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def _orders(part: str, n: int, removed: list[int], good: list[int], toxic: list[int], filters: str) -> Iterator[tuple]:
    """All orders and steps of a part, each order a path through the sets of filters."""
    k = len(filters)
    shapley = [0] * k
    for s, f in itertools.product(range(1 << k), range(k)):
        if not s >> f & 1:
            before = s.bit_count()
            shapley[f] += math.factorial(before) * math.factorial(k - 1 - before) * removed[s * k + f]
    for order in itertools.permutations(range(k)):
        s, kept, name = 0, n, "".join(filters[f] for f in order)
        for step, f in enumerate(order, 1):
            at = s * k + f
            kept -= removed[at]
            others = (1 << k) - 1 - (1 << f)
            yield part, name, step, kept, removed[at], removed[f] - removed[at], removed[others * k + f], good[at], toxic[at], shapley[f]
            s |= 1 << f


def audit(rows: DataFrame, filters: str = FILTERS, block: int = BLOCK) -> DataFrame:
    """One row per part, order of the filters and step, from rows (part, doc_id, fails, labels): kept, removed, redundant,
    unique_fails, good_lost, toxic_lost and shapley. Sizes are summed by part with partial sums in each task, so a part
    is one row when its orders are read off. ``filters`` names the bits of ``fails``.
    """
    names = [c.split()[0] for c in _AUDIT.split(", ")]
    schema = pa.schema([(n, pa.string() if n in names[:2] else pa.int32() if n == "step" else pa.int64()) for n in names])
    size = len(filters) << len(filters)
    sums = block_sizes(rows, filters, block).groupBy("part").agg(F.sum("n").alias("n"), *[F.array(*[F.sum(F.get(c, i)) for i in range(size)]).alias(c) for c in ("removed", "good", "toxic")])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                columns = zip(*_orders(**r, filters=filters), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return sums.mapInArrow(expand, _AUDIT)


def audit_documents(docs: DataFrame, labels: DataFrame, *, block: int = BLOCK, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The audit of the five filters on whole texts. Null text is empty, a null part is the empty string; rows that repeat an
    id are documents of their own with that id's labels, and none of them is a copy of another by the same id. A table
    without rows has no part and so no rows here. Other columns are ignored."""
    judged, _ = storage.written(judge(docs, part_col=part_col, id_col=id_col, text_col=text_col), "judged")
    rows, _ = storage.written(with_labels(with_copies(judged), labels), "failures")
    return audit(rows, block=block)


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP13_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS t, row_number() OVER () AS row FROM documents
), judged AS (
  SELECT part, doc_id, t, row, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs
), first AS (SELECT t, min(doc_id) AS first FROM docs GROUP BY t
), marked AS (
  SELECT part, row, j.doc_id, CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT) + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS INT)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(j.doc_id > first, first IS NOT NULL) AS INT) AS fails FROM judged j JOIN first USING (t)
), labelled AS (
  SELECT m.part, m.fails, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad FROM marked m
  LEFT JOIN (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS bad FROM labels GROUP BY doc_id) l ON m.doc_id = l.doc_id
), cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM labelled GROUP BY part, fails
), orders(o, used) AS (
  SELECT '', 0 UNION ALL SELECT o || chr(CAST(65 + f AS INT)), used + CAST(1 << f AS INT) FROM orders, range(5) r(f) WHERE (used >> f) % 2 = 0
), steps AS (
  SELECT o AS filter_order, s AS step, ord(substr(o, s, 1)) - 65 AS f, (SELECT coalesce(sum(1 << (ord(substr(o, k, 1)) - 65)), 0) FROM range(1, s) q(k)) AS before
  FROM orders, range(1, 6) r(s) WHERE length(o) = 5
), facts AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN fails & (before + (1 << f)) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN (fails >> f) % 2 = 1 AND fails & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN (fails >> f) % 2 = 1 AND fails & before != 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = 1 << f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN (fails >> f) % 2 = 1 AND fails & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN (fails >> f) % 2 = 1 AND fails & before = 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM (SELECT part, fails, n, good, bad, filter_order, step, f, CAST(before AS INT) AS before FROM cells, steps) GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM facts
"""
