"""Importance resampling towards a target distribution: array-scored weights, drawn exactly by weighted medians.

Words are hashed into buckets; a bucket's gain says how much more frequent it is in the target than in the documents,
and a document's weight is the sum of its words' gains, looked up in one array (its size is the number of buckets).
Adding Gumbel noise to the weights and taking the highest scores draws without replacement in proportion to exp(weight).

The highest scores are found without a sort of all: each partition tells the median of its keys that are still open and how
many they are; the weighted median of these medians has at least a quarter of the open keys on either side, so whichever
side the cutoff is not on goes at once. The next round counts both sides of the pivot and their medians in one pass,
until the key at the cutoff is known. Only the winners are sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage


@dataclass(frozen=True)
class Spec:
    """``least`` words make a document eligible; ``percent`` of the eligible documents, rounded down, are drawn."""

    buckets: int = 10_000
    least: int = 20
    percent: int = 10
    seed: str = "2024"
    scale: int = 1000


#: ASCII letters in lower case; what is no word becomes a space. Bytes of other characters belong to words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Words whose bucket a worker remembers; others are hashed again.
REMEMBERED = 500_000
#: So many open keys are fetched and sorted at the end of the search, which saves its last rounds.
GATHER = 4096
_KEY = ("score", "doc_id", "n_features", "row")
_ROWS = "doc_id long, n_features long, weight long, score long, row long"
_NO_ID = np.iinfo(np.int64).max


class _Buckets:
    def __init__(self, n: int):
        self.n, self.known = n, {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        """The bucket of each word of a text, in order."""
        known, words = self.known, (text or b"").translate(_FOLD).split()
        try:
            return np.fromiter(map(known.__getitem__, words), np.int32, len(words))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for w in set(words):
                if w not in known:
                    known[w] = zlib.crc32(w) % self.n
            return np.fromiter(map(known.__getitem__, words), np.int32, len(words))


def bucket_counts(docs: DataFrame, spec: Spec = Spec(), text_col: str = "text") -> DataFrame:
    """bucket and n: words of all whole texts by bucket, counted within partitions before they meet."""
    rows = docs.select(F.col(text_col).cast("string").cast("binary").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = _Buckets(spec.buckets), np.zeros(spec.buckets, np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                total += np.bincount(of(text), minlength=spec.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "n": pa.array(total[some], pa.int64())})

    return rows.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, spec: Spec = Spec(), text_col: str = "text") -> np.ndarray:
    """The gain of each bucket, from the counts of all documents and all target texts: one row per bucket comes here."""
    s, t = (_as_array(bucket_counts(x, spec, text_col), spec.buckets) for x in (docs, target))
    all_s, all_t = int(s.sum()), int(t.sum())
    return np.array([math.floor(spec.scale * math.log((b + 1) * (all_s + spec.buckets) / ((a + 1) * (all_t + spec.buckets)))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def _as_array(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():  # at most one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def noise(doc_id: int | None, spec: Spec = Spec()) -> int:
    """A Gumbel draw that depends on the id alone; a row without an id counts as one of empty id."""
    h = int(hashlib.sha256(f"{spec.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-spec.scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, spec: Spec = Spec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and a row number (unique, not gapless) of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"), F.monotonically_increasing_id().alias("row"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _Buckets(spec.buckets)
        for batch in batches:
            n, weight, ids = [], [], batch["doc_id"].to_pylist()
            for text in batch["text"].to_pylist():
                found = of(text)
                n.append(len(found))
                weight.append(int(gain[found].sum()) // len(found) if len(found) else 0)
            drawn = [w + noise(i, spec) for w, i in zip(weight, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(weight, pa.int64()), pa.array(drawn, pa.int64()), batch["row"]], names=["doc_id", "n_features", "weight", "score", "row"])

    return rows.mapInArrow(score, _ROWS)


Key = tuple[int, int, int, int]


def _keys(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    """Keys of a partition, least first: highest score, smallest id (none: last), fewest words, row."""
    tables = [[b["score"].to_numpy(), b["doc_id"].fill_null(_NO_ID).to_numpy(zero_copy_only=False), b["n_features"].to_numpy(), b["row"].to_numpy()] for b in batches]
    if not tables:
        return [np.empty(0, np.int64)] * 4
    score, doc, n, row = (np.concatenate(x) for x in zip(*tables, strict=True))
    return [-score, doc, n, row]


def _before(keys: list[np.ndarray], key: Key) -> np.ndarray:
    """Which keys come before ``key``?"""
    less, same = np.zeros(len(keys[0]), bool), np.ones(len(keys[0]), bool)
    for column, value in zip(keys, key, strict=True):
        less |= same & (column < value)
        same &= column == value
    return less


def _median(keys: list[np.ndarray]) -> Key:
    """The lower median, by sorting what a partition has left."""
    order = np.lexsort(keys[::-1])
    at = order[(len(order) - 1) // 2]
    return tuple(int(k[at]) for k in keys)


_FOUND = "side int, n long, k0 long, k1 long, k2 long, k3 long"


def _round(keys: DataFrame, low: Key | None, pivot: Key | None, high: Key | None) -> list[tuple[int, int, Key]]:
    """(side, number, median) of the open keys of each partition: side 0 up to the pivot, side 1 behind it. Keys are open
    if they lie behind ``low`` and up to ``high``. Two rows per partition at most come here."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_keys = _keys(batches)
        upto = lambda key: ~_before(all_keys, key) & ~_same(all_keys, key)
        open_ = np.ones(len(all_keys[0]), bool)
        if low:
            open_ &= upto(low)
        if high:
            open_ &= ~upto(high)
        behind = upto(pivot) if pivot else np.zeros(len(open_), bool)
        out = []
        for side in (0, 1):
            some = [k[open_ & (behind == bool(side))] for k in all_keys]
            if len(some[0]):
                out.append((side, len(some[0]), *_median(some)))
        names = ["side", "n", "k0", "k1", "k2", "k3"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int32() if not i else pa.int64()) for i in range(6)], names=names)

    if low:  # groups of rows that hold no open key need not be read
        keys = keys.where(F.col("score") <= -low[0])
    if high:
        keys = keys.where(F.col("score") >= -high[0])
    return [(r["side"], r["n"], (r["k0"], r["k1"], r["k2"], r["k3"])) for r in keys.select(*_KEY).mapInArrow(count, _FOUND).collect()]


def _same(keys: list[np.ndarray], key: Key) -> np.ndarray:
    return np.logical_and.reduce([k == v for k, v in zip(keys, key, strict=True)])


def cutoff(keys: DataFrame, wanted: int, gather: int = GATHER) -> Key | None:
    """The key that has exactly ``wanted`` keys up to it, itself included; none if none or all are wanted."""
    low = pivot = high = None
    taken = 0  # keys up to ``low``
    if wanted <= 0:
        return None
    while True:
        found = _round(keys, low, pivot, high)
        sides = [[(n, key) for side, n, key in found if side == s] for s in (0, 1)]
        up_to = sum(n for n, _ in sides[0])
        if pivot:
            if taken + up_to == wanted:
                return pivot
            if taken + up_to < wanted:
                taken, low, left = taken + up_to, pivot, sides[1]
            else:
                high, left = pivot, sides[0]
        else:
            if wanted >= up_to:
                return None
            left = sides[0]
        if sum(n for n, _ in left) <= gather:
            return sorted(_open_keys(keys, low, high))[wanted - taken - 1]
        pivot = _weighted_median(left)


def _open_keys(keys: DataFrame, low: Key | None, high: Key | None) -> list[Key]:
    """The open keys themselves; called for at most ``gather`` of them."""
    if low:
        keys = keys.where(~_upto(low))
    if high:
        keys = keys.where(_upto(high))
    return [(-r["score"], _NO_ID if r["doc_id"] is None else r["doc_id"], r["n_features"], r["row"]) for r in keys.select(*_KEY).collect()]


def _weighted_median(medians: list[tuple[int, Key]]) -> Key:
    half, seen = sum(n for n, _ in medians) / 2, 0
    for n, key in sorted(medians, key=lambda x: x[1]):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys are left")


def _upto(key: Key) -> F.Column:
    """Is a row of the score table at the cutoff or before it?"""
    columns = [-F.col("score"), F.coalesce("doc_id", F.lit(_NO_ID)), F.col("n_features"), F.col("row")]
    out = columns[-1] <= key[-1]
    for column, value in list(zip(columns, key, strict=True))[-2::-1]:
        out = (column < value) | ((column == value) & out)
    return out


def resample(docs: DataFrame, target: DataFrame, spec: Spec = Spec(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank (from 1; null if not drawn) of every row of ``docs``.

    Null text counts as empty: no words, weight 0, never drawn (if ``least`` is over 0). Rows without an id share the noise of
    the empty id and come last among equal scores. Rows that repeat an id are documents of their own: equal scores go
    by smaller id, then fewer words; rows that are equal in all of this are exchangeable. Other columns are ignored. An
    empty target or table has gains of its smoothed counts and no winners beyond its rows.
    """
    spark = docs.sparkSession
    rows, _ = storage.written(scores(docs, gains(docs, target, spec, text_col), spec, id_col, text_col), "scores")
    eligible = rows.where(F.col("n_features") >= spec.least)
    wanted = spec.percent * eligible.count() // 100
    out = ("doc_id", "n_features", "weight", "score")
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return rows.select(*out, none)
    key = cutoff(eligible, wanted)
    drawn = (F.col("n_features") >= spec.least) & (_upto(key) if key else F.lit(True))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("row")]
    winners, _ = storage.written(rows.where(drawn).select(*out, "row").orderBy(*order).select(*out, F.monotonically_increasing_id().alias("place")), "winners")
    part = F.shiftright("place", 33)
    sizes = sorted((r["part"], r["count"]) for r in winners.groupBy(part.alias("part")).count().collect())  # a row per partition
    starts, at = {}, 1
    for p, n in sizes:
        starts[p], at = at, at + n
    first = spark.createDataFrame(list(starts.items()), "part long, start long")
    ranked = winners.withColumn("part", part.cast("long")).join(F.broadcast(first), "part").select(*out, (F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("rank"))
    return ranked.unionByName(rows.where(~drawn).select(*out, none))


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: CRC-32 of a word by its bytes; the table of 256 is made from the polynomial, and only distinct words are hashed.
OP12_SQL = r"""
WITH RECURSIVE step(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM step WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8
), texts AS (
  SELECT false AS target, doc_id, rowid_ AS row, coalesce(text, '') AS text FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents)
  UNION ALL SELECT true, NULL, NULL, coalesce(text, '') FROM benchmark
), folded AS (
  SELECT target, doc_id, row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts
), word AS (SELECT target, doc_id, row, unnest(words) AS w FROM folded
), hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode(w)) + 1), lambda i: ('0x' || substr(hex(encode(w)), 2 * i - 1, 2))::BIGINT)),
    lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295) % 10000 AS bucket FROM (SELECT DISTINCT w FROM word), crc
), counts AS (
  SELECT b AS bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM range(10000) r(b) LEFT JOIN (
    SELECT bucket, count(*) FILTER (NOT target) AS s, count(*) FILTER (target) AS t FROM word JOIN hashed USING (w) GROUP BY bucket) c ON b = bucket
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000))::DOUBLE / ((s + 1) * (sum(t) OVER () + 10000))::DOUBLE)) AS BIGINT) AS g FROM counts
), weighed AS (
  SELECT doc_id, row, count(*) AS n, CAST(floor(sum(g)::DOUBLE / count(*)) AS BIGINT) AS weight FROM word JOIN hashed USING (w) JOIN gain USING (bucket) WHERE NOT target GROUP BY doc_id, row
), noise AS (
  SELECT f.doc_id, f.row, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(f.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS g
  FROM folded f LEFT JOIN weighed USING (row) WHERE NOT target
), placed AS (
  SELECT *, weight + g AS score, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + g DESC, doc_id, n_features, row) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS eligible FROM noise
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank FROM placed
"""
