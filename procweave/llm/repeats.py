"""Super-k-mers that other documents may have too: what the operators on repeated passages start from.

Documents are dealt once into groups (a bucketed table, so later steps read them without another shuffle). A group sends
each distinct anchor of its super-k-mers (see ``winnow``) once to the anchor's bucket, packed; the bucket tells which
anchors come from several groups. Only their super-k-mers, and those whose anchor a group has twice itself, can hold a
window that starts in two documents; the operators compare those on the texts. Anchors travel as 48 bits: equal ones by
chance only let more through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage, worker
from .winnow import BYTES, SuperKmers, words

_MESSAGE = "bucket int, grp int, hashes binary"
ANSWER = "grp int, bucket int, places binary, codes binary"
SHARED, HOT = 1, 2
#: Units that are hashed at once, so that the arrays stay in the processor's cache.
CHUNK = 200_000
#: A null doc_id counts as larger than all others.
NO_ID = np.iinfo(np.int64).max
#: Files of the table of texts; a file holds whole groups.
MOST_FILES = 50_000


@dataclass(frozen=True)
class Spec:
    unit: str  # "word" or "byte"
    size: int = 50
    k: int = 25
    group_bytes: int = 2 << 20  # grows with the table up to the next
    most_group_bytes: int = 32 << 20
    bucket_bytes: int = 2 << 20
    hot: int = 2000  # groups; what stands around an anchor of more is dealt out window by window

    def __post_init__(self):
        if not 0 < self.size - self.k < 32:
            raise ValueError("k must be less than size, by less than 32")


def bytes_of(column: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buffer and offsets of each chunk of a binary column; null counts as empty."""
    out = []
    for chunk in column.chunks:
        chunk = chunk.fill_null(b"").cast(pa.large_binary())
        offsets = np.frombuffer(chunk.buffers()[1], np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        data = np.frombuffer(chunk.buffers()[2] or b"", np.uint8)
        out.append((data[offsets[0] : offsets[-1]], offsets - offsets[0]))
    return out


class Part:
    """Some documents of a group: ``ids``, the ``data`` of all texts with ``offsets``, and their units."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, spec: Spec):
        self.ids, self.data, self.offsets = ids, data, offsets
        if spec.unit == "byte":
            units, self.lengths = BYTES[data], np.diff(offsets)
        else:
            gaps = np.arange(len(ids) + 1)
            apart = np.full(len(data) + len(ids), 32, np.uint8)  # one space after each text
            apart[np.arange(len(data)) + np.repeat(gaps[:-1], np.diff(offsets))] = data
            units, start, stop = words(apart)
            owner = np.searchsorted(offsets[1:] + gaps[1:], start, side="right")
            self.lengths = np.bincount(owner, minlength=len(ids))
            self.word_start, self.word_stop = start - owner, stop - owner
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.paths = SuperKmers(units, self.lengths, spec.size, spec.k)
        self.content = self.paths.content
        self.owner = ids[self.paths.doc]


def parts(table: pa.Table, spec: Spec) -> Iterator[Part]:
    ids, at = table["doc_id"].fill_null(NO_ID).to_numpy(), 0
    for data, offsets in bytes_of(table["text"]):
        n, i = len(offsets) - 1, 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, side="right")) - 1)
            yield Part(ids[at + i : at + j], data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], spec)
            i = j
        at += n


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(n)).astype(np.int32)


def least(*keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, group of each row in that order and least doc of each group, by equal keys (the first is the main one)."""
    order = np.lexsort((docs, *keys[::-1]))
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, np.cumsum(new) - 1, docs[order][new]


def answers_of(table: pa.Table, cuts: np.ndarray, n: int, kind: type) -> np.ndarray:
    """The buckets' answers by row of what was sent, of which each bucket got the rows between two cuts."""
    out = np.zeros(n, kind)
    for row in table.to_pylist():
        out[cuts[row["bucket"]] + np.frombuffer(row["places"], np.uint32)] = np.frombuffer(row["codes"], kind)
    return out


def answer(bucket: int, groups: list[int], sizes: list[int], codes: np.ndarray) -> pa.Table:
    """What a bucket tells each group: the places, among the rows that the group sent, of codes other than 0."""
    out, ends = [], np.cumsum(sizes)
    for grp, n, end in zip(groups, sizes, ends.tolist(), strict=True):
        mine = codes[end - n : end]
        places = np.flatnonzero(mine)
        if len(places):
            out.append({"grp": grp, "bucket": bucket, "places": places.astype(np.uint32).tobytes(), "codes": mine[places].tobytes()})
    return pa.Table.from_pylist(out, schema=pa.schema([("grp", pa.int32()), ("bucket", pa.int32()), ("places", pa.binary()), ("codes", pa.binary())]))


class Group:
    """All documents of one group with their super-k-mers, and its distinct anchors in order of bucket."""

    def __init__(self, table: pa.Table, spec: Spec, buckets: int):
        worker.forget()
        self.spec, self.buckets, self.parts = spec, buckets, list(parts(table, spec))
        self.owner = np.concatenate([np.zeros(0, np.int64), *(p.owner for p in self.parts)])
        self.anchor = np.concatenate([np.zeros(0, np.uint64), *(p.paths.anchor for p in self.parts)])
        self.hashes, self.of_row, count = np.unique(self.anchor, return_inverse=True, return_counts=True)
        bucket = bucket_of(self.hashes, buckets)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.hashes, self.of_row, self.twice = self.hashes[order], place[self.of_row], count[order] > 1
        self.cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))

    def messages(self, grp: int) -> pa.Table:
        low = self.hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        full = np.flatnonzero(np.diff(self.cuts))
        return pa.table({"bucket": pa.array(full, pa.int32()), "grp": pa.array([grp] * len(full), pa.int32()), "hashes": pa.array([low[self.cuts[b] : self.cuts[b + 1]].tobytes() for b in full], pa.binary())})

    def codes(self, answers: pa.Table) -> np.ndarray:
        """SHARED or HOT, or 0, for each super-k-mer of the group."""
        code = answers_of(answers, self.cuts, len(self.hashes), np.uint8)
        return np.maximum(code, self.twice * np.uint8(SHARED))[self.of_row]


def _shared(hot: int):
    def resolve(key, table):
        packed = table["hashes"].to_pylist()
        sizes = [len(x) // 6 for x in packed]
        wide = np.zeros((sum(sizes), 8), np.uint8)
        wide[:, :6] = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 6)
        _, of, count = np.unique(wide.view("<u8").ravel(), return_inverse=True, return_counts=True)
        groups = count[of]  # a group sends an anchor once
        return answer(key[0].as_py(), table["grp"].to_pylist(), sizes, np.where(groups > hot, HOT, np.where(groups > 1, SHARED, 0)).astype(np.uint8))

    return resolve


class Dealt:
    """Texts in groups with the answers about their anchors. ``grouped`` and ``answers`` are grouped by ``grp``; use as a
    context, at whose end both tables go."""

    def __init__(self, docs: DataFrame, spec: Spec, *, id_col: str, text_col: str):
        self.spark, self.spec = docs.sparkSession, spec
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
        total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
        groups = max(1, math.ceil(total / min(spec.most_group_bytes, max(spec.group_bytes, total // 4096))))
        shuffles = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        files = min(MOST_FILES, max(min(groups, shuffles), groups // 8))
        self.buckets = max(min(groups, shuffles), math.ceil(total / spec.bucket_bytes))
        self._path = storage.new_path(self.spark, "texts")
        self._name = self._path.rpartition("/")[2].replace("-", "_")
        # rows that repeat an id, or have none, need not meet
        rows = rows.withColumn("grp", F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(groups)).cast("int"))
        rows.repartition(files, "grp").write.bucketBy(files, "grp").option("path", self._path).option("compression", "zstd").saveAsTable(self._name)
        storage.remove(self.spark)
        self.grouped = self.spark.table(self._name).select("doc_id", "text", "grp").groupBy("grp")
        buckets = self.buckets

        def send(key, table):
            return Group(table, spec, buckets).messages(key[0].as_py())

        self.answers, self._answers = storage.written(self.grouped.applyInArrow(send, _MESSAGE).groupBy("bucket").applyInArrow(_shared(spec.hot), ANSWER), "anchors")
        storage.remove(self.spark)

    def __enter__(self) -> Dealt:
        return self

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name}")
        storage.remove(self.spark, self._path, self._answers)
