"""Packing by concatenate and cut: all documents form one stream of tokens, cut into windows of fixed length.

Pass 1 encodes each partition and writes the ids with each document's place in its partition; totals of partitions (one
row each) give prefix sums, so pass 2 knows every document's place in the stream and cuts it where windows end. A piece
is the boundary record: document, its own offset, sequence and place there. The ids themselves are never shuffled: up
to ``MOST_PARTS`` partitions, whose number is counted, their prefix sums go to every task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import storage, tokens

LENGTH = 4096
END = 2
MOST_PARTS = 1_000_000  # rows of 16 bytes; beyond it the bases are joined by a shuffle
_TOKENS = "part int, doc_id long, place long, doc_tokens long, ids binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, vocabulary: str, *, length: int = LENGTH, end: int = END, leading: bool = False, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start (ids of the document before it), length, ids_crc32, doc_tokens, sequence_id,
    offset (place in the sequence) and ids (packed 32-bit little-endian; null unless ``with_ids``). Only the last
    sequence is shorter than ``length``.

    Null and empty texts are packed as the end id alone; null and repeated ids are packed as they come. Other columns
    are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, place = tokens.encoder(vocabulary, leading), TaskContext.get().partitionId(), 0
        tail = np.array([end], encoder.dtype).tobytes()
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                some = batch.slice(i, 500)
                ids = [x + tail for x in encoder.encode(some["text"].to_pylist())]
                n = np.array([len(x) // encoder.dtype.itemsize for x in ids], np.int64)
                ends = place + np.cumsum(n)
                yield pa.RecordBatch.from_pydict({"part": pa.array([part] * len(ids), pa.int32()), "doc_id": some["doc_id"], "place": ends - n, "doc_tokens": n, "ids": pa.array(ids, pa.binary())})
                place = int(ends[-1])

    table, _ = storage.written(rows.mapInArrow(encode, _TOKENS), "tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = table.groupBy("part").agg(F.max(F.col("place") + F.col("doc_tokens")).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    bases = F.broadcast(bases) if bases.count() <= MOST_PARTS else bases
    kind = tokens.encoder(vocabulary, leading).dtype

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")
        for batch in batches:
            out: dict[str, list] = {x: [] for x in names}
            for doc, at, n, raw in zip(*(batch[x].to_pylist() for x in ("doc_id", "at", "doc_tokens", "ids")), strict=True):
                ids, start = np.frombuffer(raw, kind).astype("<u4"), 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    size = min(n - start, length - offset)
                    piece = ids[start : start + size]
                    for name, x in zip(names, (doc, start, size, zlib.crc32(piece), n, sequence, offset, piece.tobytes() if with_ids else None), strict=True):
                        out[name].append(x)
                    start += size
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(x, pa.int64()) for x in names[:-1]] + [("ids", pa.binary())]))

    return table.join(bases, "part").select("doc_id", (F.col("base") + F.col("place")).alias("at"), "doc_tokens", "ids").mapInArrow(cut, _PIECES)


def op3_concat_cut(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False).drop("ids")
