"""Byte-level BPE of long texts by tree concatenation, and its decoding.

A long text is halved until its parts are short enough (``leaf`` characters); Spark encodes the parts in parallel.
Neighbours are then joined pairwise, level by level: a window of a few tokens on both sides of the join is encoded
again and grows until both sides agree with it exactly. They agree

* at a space between two characters that are no white space: the vocabulary's pattern always splits there, so what
  lies beyond cannot depend on what lies within; or
* on one whole token amid letters only: no split can fall there, and a sequence of tokens is the encoding of its text
  if each two neighbours are the encoding of their own text, which windows and sides have shown on their parts.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens

LEAF = 16_384
_FIRST_WINDOW = 8
_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_IDS = "doc_id long, ids binary"


def leaves(text: str, leaf: int = LEAF) -> list[str]:
    """A text's parts in order: halves of halves of at most ``leaf`` characters."""
    if len(text) <= leaf:
        return [text]
    middle = len(text) // 2
    return leaves(text[:middle], leaf) + leaves(text[middle:], leaf)


class Side:
    """Ids of a piece of text with the byte at which each ends."""

    def __init__(self, text: str, ids: np.ndarray, sizes: np.ndarray):
        self.text, self.raw, self.ids = text, text.encode(), ids
        self.ends = np.concatenate([[0], np.cumsum(sizes[ids])])


def _is_start(raw: bytes, at: int) -> bool:
    return at == len(raw) or raw[at] & 0xC0 != 0x80


def _agreement(window: Side, other: Side, shift: int, lo: int, hi: int) -> int | None:
    """A byte of the window in [lo, hi) from which, or up to which, window and side may be exchanged. ``shift``: the
    window's byte 0 in the side."""
    text_at = {int(e) for e in window.ends} & {int(e) - shift for e in other.ends}
    raw = window.raw
    for at in sorted(x for x in text_at if lo < x < hi):
        if raw[at : at + 1] == b" ":
            left, right = raw[:at].decode(errors="replace")[-1:], raw[at + 1 :].decode(errors="replace")[:1]
            if left and right and not left.isspace() and not right.isspace():
                return at
    starts = dict(zip(window.ends[:-1].tolist(), window.ids.tolist(), strict=True))
    theirs = dict(zip((other.ends[:-1] - shift).tolist(), other.ids.tolist(), strict=True))
    if window.text.isalpha():
        for at in sorted(x for x in text_at if lo < x < hi):
            if at in starts and starts[at] == theirs.get(at):
                return at
    return None


def join(left: Side, right: Side, encode, sizes: np.ndarray) -> Side:
    """The encoding of both texts in a row."""
    text, n = left.text + right.text, _FIRST_WINDOW
    while True:
        a, b = max(0, len(left.ids) - n), min(len(right.ids), n)
        while a and not _is_start(left.raw, int(left.ends[a])):
            a -= 1
        while b < len(right.ids) and not _is_start(right.raw, int(right.ends[b])):
            b += 1
        start, stop = int(left.ends[a]), int(right.ends[b])
        middle = (left.raw[start:] + right.raw[:stop]).decode()
        window = Side(middle, encode(middle), sizes)
        seam = len(left.raw) - start
        x = 0 if not a else _agreement(window, left, start, 0, seam)
        y = len(window.raw) if b == len(right.ids) else _agreement(window, right, -seam, seam, len(window.raw))
        if x is not None and y is not None:
            first, last = int(np.searchsorted(window.ends, x)), int(np.searchsorted(window.ends, y))
            head = left.ids[: int(np.searchsorted(left.ends, start + x))]
            tail = right.ids[int(np.searchsorted(right.ends, y - seam)) :]
            return Side(text, np.concatenate([head, window.ids[first:last], tail]), sizes)
        n *= 2


def joined(sides: list[Side], encode, sizes: np.ndarray) -> Side:
    """Neighbours joined pairwise until one is left."""
    while len(sides) > 1:
        pairs = [join(a, b, encode, sizes) for a, b in zip(sides[::2], sides[1::2], strict=False)]
        sides = pairs + sides[2 * len(pairs) :]
    return sides[0]


@functools.cache
def _sizes(vocabulary: str) -> np.ndarray:
    return np.array([len(x) for x in tokens.byte_tokens(vocabulary)])


class _Digests:
    """n_tokens, digest of the decimal ids and digest of the decoded text."""

    def __init__(self, vocabulary: str):
        self.bytes = tokens.byte_tokens(vocabulary)
        self.decimal = np.empty(len(self.bytes), dtype=object)
        self.decimal[:] = [b"%d" % i for i in range(len(self.bytes))]

    def __call__(self, ids: np.ndarray) -> tuple[int, str, str]:
        text = b"".join(self.bytes[ids].tolist()).decode("utf-8", "replace")
        return len(ids), hashlib.sha256(b",".join(self.decimal[ids].tolist())).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


@functools.cache
def _digests(vocabulary: str) -> _Digests:
    return _Digests(vocabulary)


def _encode(docs: DataFrame, vocabulary: str, leaf: int, id_col: str, text_col: str, row, schema: str) -> DataFrame:
    """``row(doc_ids, arrays of ids)`` makes the rows of documents whose ids are whole."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, make = tokens.encoder(vocabulary, True), row()
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                some = batch.slice(i, 500)
                yield make(some["doc_id"].to_pylist(), [np.frombuffer(x, encoder.dtype) for x in encoder.encode(some["text"].to_pylist())])

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                parts = leaves(text, leaf)
                key = hashlib.sha256(text.encode()).digest()[:16]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([doc] * len(parts), pa.int64()), "key": pa.array([key] * len(parts), pa.binary()), "leaf": pa.array(range(len(parts)), pa.int32()), "part": parts})

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary, True)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch[c] for c in ("doc_id", "key", "leaf", "part")] + [pa.array(encoder.encode(batch["part"].to_pylist()), pa.binary())], names=["doc_id", "key", "leaf", "part", "ids"])

    def join_leaves(table):
        encoder, make = tokens.encoder(vocabulary, True), row()
        sizes = _sizes(vocabulary)
        table = table.sort_by("leaf")
        leaf_no = table["leaf"].to_numpy()
        copies = int((leaf_no == 0).sum())  # rows of equal id and text have one result each
        parts, ids = table["part"].to_pylist()[::copies], table["ids"].to_pylist()[::copies]
        whole = joined([Side(p, np.frombuffer(x, encoder.dtype), sizes) for p, x in zip(parts, ids, strict=True)], lambda t: np.frombuffer(encoder.encode([t])[0], encoder.dtype), sizes)
        return pa.Table.from_batches([make([table["doc_id"][0].as_py()] * copies, [whole.ids] * copies)])

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = rows.where(F.char_length("text") > leaf).mapInArrow(halve, "doc_id long, key binary, leaf int, part string")
    encoded = long.repartition(n, "doc_id", "key", "leaf").mapInArrow(encode_leaves, "doc_id long, key binary, leaf int, part string, ids binary")
    return rows.where(F.char_length("text") <= leaf).mapInArrow(short, schema).unionByName(encoded.groupBy("doc_id", "key").applyInArrow(join_leaves, schema))


def encode(docs: DataFrame, vocabulary: str, *, leaf: int = LEAF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (packed 32-bit little-endian) of every row's whole text.

    Null text counts as empty; rows of equal id, or without one, have one result each. Other columns are ignored.
    """

    def row():
        return lambda docs, ids: pa.RecordBatch.from_pydict({"doc_id": pa.array(docs, pa.int64()), "ids": pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())})

    return _encode(docs, vocabulary, leaf, id_col, text_col, row, _IDS)


def digests(docs: DataFrame, vocabulary: str, *, leaf: int = LEAF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, then decoded: doc_id, n_tokens, ids_sha256 and decoded_sha256 without the ids themselves."""

    def row():
        digest = _digests(vocabulary)

        def make(docs, ids):
            n, a, b = zip(*map(digest, ids), strict=True) if ids else ((), (), ())
            return pa.RecordBatch.from_pydict({"doc_id": pa.array(docs, pa.int64()), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(a, pa.string()), "decoded_sha256": pa.array(b, pa.string())})

        return make

    return _encode(docs, vocabulary, leaf, id_col, text_col, row, _DIGESTS)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and text of packed ids, special tokens as their own strings; bytes that are no UTF-8 become U+FFFD."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tokens.byte_tokens(vocabulary)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "text": pa.array([None if x is None else b"".join(table[np.frombuffer(x, "<u4")].tolist()).decode("utf-8", "replace") for x in batch["ids"].to_pylist()], pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, text string")


def op4_tree_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
