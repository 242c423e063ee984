"""Token ids as wavelet matrices: one succinct file row per shard, in ascending doc_id order.

A shard holds one bit-plane per bit of the largest id, highest first; each plane lists one bit of all ids in an order
that puts zeros of the planes above before ones. Behind the planes stands the rank directory: the ones before each block
of 512 bits, for each plane. From these alone come the id at a place, the count of an id up to a place (ranks from the
highest plane down), and the place of its n-th occurrence (selects from the lowest plane up).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import storage, tokens

_HEADER = struct.Struct("<4sBQ")
_MAGIC = b"WVM1"
BLOCK = 512
END = 2
SHARD_TOKENS = 1 << 19


def build(ids: np.ndarray) -> bytes:
    """The file form of a sequence of ids below 2**32."""
    levels = max(1, int(ids.max(initial=0)).bit_length())
    rows, planes, ranks = ids, [], []
    for level in range(levels - 1, -1, -1):
        one = (rows & rows.dtype.type(1 << level)).astype(bool)
        packed = np.packbits(one, bitorder="little")
        planes.append(packed.tobytes())
        words = np.zeros(-(-len(ids) // BLOCK) * (BLOCK // 8), np.uint8)
        words[: len(packed)] = packed
        ones = np.bitwise_count(words.view("<u8")).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        ranks.append(np.concatenate([[0], np.cumsum(ones)]))
        if level:
            zeros = len(rows) - int(ranks[-1][-1])
            below = np.empty_like(rows)
            below[:zeros], below[zeros:] = rows[np.flatnonzero(~one)], rows[np.flatnonzero(one)]  # places are quicker than masks
            rows = below
    return _HEADER.pack(_MAGIC, levels, len(ids)) + b"".join(planes) + np.array(ranks, "<u4").tobytes()


class WaveletMatrix:
    """Reads a shard's file form; nothing is counted when it is opened."""

    def __init__(self, data: bytes):
        magic, self.levels, self.n = _HEADER.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a wavelet matrix")
        step = (self.n + 7) // 8
        self._planes = [np.frombuffer(data, np.uint8, step, _HEADER.size + i * step) for i in range(self.levels)]
        self._ranks = np.frombuffer(data, "<u4", offset=_HEADER.size + self.levels * step).reshape(self.levels, -1)
        self._zeros = [self.n - int(r[-1]) for r in self._ranks]

    def _rank1(self, level: int, place: int) -> int:
        block, bit = divmod(place, BLOCK)
        part = self._planes[level][block * (BLOCK // 8) : block * (BLOCK // 8) + bit // 8 + 1]
        whole = int(np.bitwise_count(part[: bit // 8]).sum(dtype=np.int64))
        rest = int(part[bit // 8]) & ((1 << bit % 8) - 1) if bit % 8 else 0
        return int(self._ranks[level][block]) + whole + rest.bit_count()

    def _select(self, level: int, bit: int, occurrence: int) -> int:
        """The place of a plane's one or zero, counted from 0."""
        before = self._ranks[level] if bit else np.minimum(np.arange(len(self._ranks[level])) * BLOCK, self.n) - self._ranks[level]
        block = int(np.searchsorted(before, occurrence, side="right")) - 1
        part = np.unpackbits(self._planes[level][block * (BLOCK // 8) : (block + 1) * (BLOCK // 8)], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(part == bit)[occurrence - int(before[block])])

    def _bit(self, level: int, place: int) -> int:
        return int(self._planes[level][place >> 3]) >> (place & 7) & 1

    def access(self, place: int) -> int:
        """The id at a place."""
        if not 0 <= place < self.n:
            raise IndexError(place)
        value = 0
        for level in range(self.levels):
            bit, ones = self._bit(level, place), self._rank1(level, place)
            value = value << 1 | bit
            place = self._zeros[level] + ones if bit else place - ones
        return value

    def _range(self, token: int, stop: int) -> tuple[int, int]:
        lo, hi = 0, stop
        for level in range(self.levels):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            lo, hi = (self._zeros[level] + a, self._zeros[level] + b) if token >> (self.levels - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, stop: int | None = None) -> int:
        """How often an id occurs before a place."""
        if token >> self.levels:
            return 0
        lo, hi = self._range(token, self.n if stop is None else min(stop, self.n))
        return hi - lo

    def select(self, token: int, occurrence: int) -> int:
        """The place of an id's occurrence, counted from 0."""
        lo, hi = self._range(token, self.n) if not token >> self.levels else (0, 0)
        if not 0 <= occurrence < hi - lo:
            raise IndexError(occurrence)
        place = lo + occurrence
        for level in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - level) & 1
            place = self._select(level, bit, place - self._zeros[level] if bit else place)
        return place

    def ids(self) -> np.ndarray:
        """All ids in order, from the lowest plane up."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        rows = np.zeros(self.n, kind)
        for level in range(self.levels - 1, -1, -1):
            one = np.unpackbits(self._planes[level], count=self.n, bitorder="little").view(bool)
            above = np.empty(self.n, kind)
            above[np.flatnonzero(~one)], above[np.flatnonzero(one)] = rows[: self._zeros[level]], rows[self._zeros[level] :] | kind(1 << (self.levels - 1 - level))
            rows = above
        return rows


_SHARD = "part int, shard int, n_tokens long, doc_ids array<long>, lengths array<long>, matrix binary"


def write(docs: DataFrame, path: str, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", end: int = END, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode all texts (null: empty), append ``end`` to each, and write shards in ascending order of id at ``path``.

    Shards close at the first document end past ``shard_tokens``. Rows of equal id follow each other in the order of
    their texts; null ids come first. Other columns are ignored.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = tokens.encoder(vocabulary, True), TaskContext.get().partitionId()
        ids, pieces, held, shard = [], [], 0, 0
        tail = np.array([end], encoder.dtype).tobytes()

        def closed() -> pa.RecordBatch:
            data = build(np.frombuffer(b"".join(pieces), encoder.dtype))
            lengths = [len(p) // encoder.dtype.itemsize for p in pieces]
            return pa.RecordBatch.from_pydict({"part": [part], "shard": [shard], "n_tokens": [held], "doc_ids": [ids], "lengths": [lengths], "matrix": [data]}, schema=pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("matrix", pa.binary())]))

        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                some = batch.slice(i, 500)
                for doc, x in zip(some["doc_id"].to_pylist(), encoder.encode(some["text"].to_pylist()), strict=True):
                    ids.append(doc)
                    pieces.append(x + tail)
                    held += len(pieces[-1]) // encoder.dtype.itemsize
                    if held >= shard_tokens:
                        yield closed()
                        ids, pieces, held, shard = [], [], 0, shard + 1
        if ids:
            yield closed()

    rows.repartitionByRange(n, F.col("doc_id"), F.substring("text", 1, 100)).sortWithinPartitions("doc_id", "text").mapInArrow(shards, _SHARD).write.parquet(path)


def read(spark, path: str) -> DataFrame:
    """One row per document from the shards at ``path``: doc_id, start (ids before it in the whole table), n_tokens and
    ids_crc32. Starts are prefix sums of shard totals within a part, and of the totals of all parts (one row each)."""
    table = spark.read.schema(_SHARD).parquet(path)
    totals = table.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("before"))
    bases = totals.withColumn("base", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(parts, "part").select("part", "shard", (F.col("base") + F.col("before")).alias("base"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = WaveletMatrix(batch["matrix"][row].as_py()).ids().astype("<u4")
                lengths = batch["lengths"][row].values.to_numpy()
                stop = np.cumsum(lengths)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((stop - lengths).tolist(), stop.tolist(), strict=True)]
                n = len(lengths)
                yield pa.RecordBatch.from_pydict({"part": pa.array([batch["part"][row].as_py()] * n, pa.int32()), "shard": pa.array([batch["shard"][row].as_py()] * n, pa.int32()), "doc_id": batch["doc_ids"][row].values, "inner": stop - lengths, "n_tokens": lengths, "ids_crc32": pa.array(crc, pa.int64())})

    out = table.mapInArrow(documents, "part int, shard int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return out.join(bases, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def op1_wavelet_tokens(spark, sf_dir: str) -> DataFrame:
    path = storage.new_path(spark, "wavelet")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read(spark, path)
