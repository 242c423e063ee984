"""Substring dedup over bytes by longest-previous-factor arrays.

A byte goes if a suffix that starts at most ``size - 1`` bytes before it, and in the same document, has a previous factor
(a match in a document of smaller id) of at least ``size`` bytes. Only that bound matters, so suffixes are ordered, and their
common prefixes counted, to a depth of ``size`` bytes:

1. Suffixes whose anchor (see ``winnow``) no other document has cannot have a previous factor; ``repeats`` finds the others.
2. Runs of the others under one anchor travel as the bytes they stand on, each distinct one once for a group, to the
   anchor's bucket. So equal suffixes meet, and a bucket sees every suffix that could lie next to another in the order.
3. A bucket keeps one of equal runs, that of the least document; its later copies have previous factors throughout. The
   suffixes of all runs are ordered by their bytes alone, and beside the suffix array stands the common prefix of each
   with the one before it. The nearest suffixes of a smaller document on either side are found by jumping pointers; the
   longest previous factor is the larger of the two least common prefixes on the way there.
4. The group gets one bit for each suffix and removes later copies.

All comparisons are of bytes; hashes only choose buckets and, within one group, tell equal runs (128 bits).
"""

from __future__ import annotations

import hashlib

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import repeats, storage
from .winnow import covered, grow, mix, runs

_RUNS = "bucket int, grp int, n int, tags binary, lengths binary, docs binary, bytes binary"

_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,stop:int>>"


class Runs:
    """Runs of suffixes of a group that other documents may have too: each distinct one once, with the least doc_id of the
    group that has it, in order of bucket. A run of a hot anchor is dealt out suffix by suffix."""

    def __init__(self, group: repeats.Group, answers: pa.Table):
        self.group, size, at = group, group.spec.size, 0
        code, base, keys, prints, owners, starts, lengths, rows = group.codes(answers), 0, [], [], [], [], [], []
        for p in group.parts:
            mine = code[at : at + len(p.paths.lo)]
            shared, hot = np.flatnonzero(mine == repeats.SHARED), np.flatnonzero(mine == repeats.HOT)
            n = p.paths.hi - p.paths.lo + 1
            one = grow(p.paths.lo[hot], n[hot]) if len(hot) else hot
            alone = mix(p.paths.sequence.spans(one, one + size)) if len(hot) else p.paths.anchor[:0]
            keys += [p.paths.anchor[shared], alone]
            prints += [p.content[shared], alone]
            owners += [p.owner[shared], np.repeat(p.owner[hot], n[hot])]
            starts += [p.paths.lo[shared] + base, one + base]
            lengths += [n[shared], np.ones(len(one), np.int64)]
            rows.append(len(shared) + len(one))
            base, at = base + len(p.data), at + len(mine)
        whole = lambda x, kind: np.concatenate([np.zeros(0, kind), *x])
        self.rows, self.start, self.n = np.array(rows), whole(starts, np.int64), whole(lengths, np.int64)
        self.owner, keys, prints = whole(owners, np.int64), whole(keys, np.uint64), whole(prints, np.uint64)
        bucket = repeats.bucket_of(keys, group.buckets)
        order, of, self.least = repeats.least(bucket, keys, prints, docs=self.owner)
        self.of_row = np.empty(len(order), np.int64)
        self.of_row[order] = of
        first = np.ones(len(order), bool)
        first[1:] = of[1:] != of[:-1]
        self.sent = order[first]
        self.tags = keys[self.sent].astype(np.uint32)
        self.cuts = np.searchsorted(bucket[self.sent], np.arange(group.buckets + 1))

    def messages(self, grp: int) -> pa.Table:
        data = np.concatenate([np.zeros(0, np.uint8), *(p.data for p in self.group.parts)])
        full, out = np.flatnonzero(np.diff(self.cuts)), []
        for b in full:
            s = slice(self.cuts[b], self.cuts[b + 1])
            rows = self.sent[s]
            raw = data[grow(self.start[rows], self.n[rows] + self.group.spec.size - 1)].tobytes()
            pack = lambda x: pa.compress(x.tobytes(), codec="zstd", asbytes=True)
            out.append((len(rows), self.tags[s].tobytes(), pack(self.n[rows].astype(np.uint8)), pack(self.least[s]), pa.compress(raw, codec="zstd", asbytes=True)))
        n, *packed = zip(*out, strict=True) if out else ([], [], [], [], [])
        return pa.table({"bucket": pa.array(full, pa.int32()), "grp": pa.array([grp] * len(full), pa.int32()), "n": pa.array(n, pa.int32())} | {k: pa.array(x, pa.binary()) for k, x in zip(("tags", "lengths", "docs", "bytes"), packed, strict=True)})

    def repeated(self, masks: np.ndarray) -> Iterator[tuple[repeats.Part, np.ndarray]]:
        """Each part with the places of its suffixes that have a previous factor of ``size`` bytes, from a bit for each
        suffix of what was sent."""
        every = (np.uint64(1) << self.n.astype(np.uint64)) - np.uint64(1)
        mask = np.where(self.owner > self.least[self.of_row], every, masks[self.of_row].astype(np.uint64))
        at = base = 0
        for p, rows in zip(self.group.parts, self.rows.tolist(), strict=True):
            some = np.arange(at, at + rows)[mask[at : at + rows] > 0]
            n = self.n[some]
            place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            bit = np.repeat(mask[some], n) >> place.astype(np.uint64) & np.uint64(1)
            yield p, (np.repeat(self.start[some] - base, n) + place)[bit > 0]
            at, base = at + rows, base + len(p.data)


_UPTO = np.array([(1 << 64) - (1 << 64 - 8 * n) for n in range(9)], np.uint64)


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one big-endian integer (zeros behind the end): its order is that of the bytes."""
    out, wide = np.zeros(len(data) + 1, np.uint64), np.concatenate([data, np.zeros(9, np.uint8)])
    for i in range(8):
        out |= wide[i : i + len(out)].astype(np.uint64) << np.uint64(56 - 8 * i)
    return out


def _bytes(words: np.ndarray, start: np.ndarray, length: np.ndarray) -> Iterator[np.ndarray]:
    """Sort keys of the byte strings (start, length), the main one first."""
    for i in range(0, int(length.max(initial=0)), 8):
        yield words[np.minimum(start + i, len(words) - 1)] & _UPTO[np.clip(length - i, 0, 8)]


def common_prefixes(keys: Iterable[np.ndarray], n: int, size: int) -> np.ndarray:
    """Bytes, up to ``size``, that each of ``n`` sorted strings has in common with the one before it."""
    out, equal = np.zeros(n, np.int64), np.ones(n, bool)
    equal[:1] = False
    for i, word in enumerate(keys):
        here = np.flatnonzero(equal)
        differ = word[here] ^ word[here - 1]
        # bytes from the left up to the highest bit that differs; a double tells that bit but for rounding, so it is shifted down
        top = np.where(differ >> np.uint64(32) > 0, differ >> np.uint64(32), differ).astype(np.float64)
        bits = np.frexp(top)[1] + np.where(differ >> np.uint64(32) > 0, 32, 0)
        out[here] = np.minimum(8 * i + (64 - bits) // 8, size)
        equal[here] = differ == 0
    return out


def _from_the_left(doc: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """The least common prefix on the way to the nearest entry to the left of a smaller document; 0 if there is none, and not
    followed below ``least``. An entry's pointer has only documents not smaller than its own on its right, so it may jump
    to where that entry points."""
    back, low = np.arange(-1, len(doc) - 1), lcp.copy()
    low[:1] = 0
    going = np.flatnonzero((low >= least) & (back >= 0))
    while len(going):
        going = going[doc[back[going]] >= doc[going]]
        at = back[going]
        low[going], back[going] = np.minimum(low[going], low[at]), back[at]
        end = back[going] < 0
        low[going[end]] = 0
        going = going[~end & (low[going] >= least)]
    return low


def longest_previous_factors(words: np.ndarray, suffix: np.ndarray, doc: np.ndarray, size: int, least: int = 1) -> np.ndarray:
    """For suffixes (places of ``size`` bytes each) the longest match with one of a smaller document, up to ``size``; matches
    shorter than ``least`` count as some number below it."""
    if not len(suffix):
        return np.zeros(0, np.int64)
    array = np.lexsort(list(_bytes(words, suffix, np.full(len(suffix), size)))[::-1])
    # the keys are made again in their order, one at a time: all of them twice would be the most that a bucket holds
    sorted_ = suffix[array]
    lcp, doc = common_prefixes(_bytes(words, sorted_, np.full(len(suffix), size)), len(suffix), size), doc[array]
    after = np.concatenate([[0], lcp[:0:-1]]).astype(np.int64)
    out = np.empty(len(array), np.int64)
    out[array] = np.maximum(_from_the_left(doc, lcp, least), _from_the_left(doc[::-1], after, least)[::-1])
    return out


def previous_factors(data: np.ndarray, n: np.ndarray, docs: np.ndarray, tags: np.ndarray, size: int) -> np.ndarray:
    """For runs of suffixes of a bucket (their bytes one after the other, ``n`` suffixes each): a bit for each suffix
    whose longest previous factor has at least ``size`` bytes."""
    masks = np.zeros(len(n), np.uint64)
    if not len(n):
        return masks.astype(np.uint32)
    length, words = n + size - 1, _words(data)
    start = np.cumsum(length) - length
    order, of, first = repeats.least(tags, n, *_bytes(words, start, length), docs=docs)
    run = order[np.flatnonzero(np.diff(of, prepend=-1))]  # distinct runs in order, each with its first document
    begin = np.cumsum(n[run]) - n[run]
    suffix, doc = grow(start[run], n[run]), np.repeat(docs[run], n[run])
    factor = longest_previous_factors(words, suffix, doc, size, size) >= size
    bit = (suffix - np.repeat(start[run], n[run])).astype(np.uint64)
    of_run = np.bitwise_or.reduceat(factor.astype(np.uint64) << bit, begin)
    every = (np.uint64(1) << n[order].astype(np.uint64)) - np.uint64(1)
    masks[order] = np.where(docs[order] > first[of], every, of_run[of])
    return masks.astype(np.uint32)


def _resolver(size: int):
    def resolve(key, table):
        sizes = table["n"].to_pylist()
        unpack = lambda name, width: np.concatenate([np.zeros(0, width), *(np.frombuffer(pa.decompress(x, decompressed_size=n * np.dtype(width).itemsize, codec="zstd", asbytes=True), width) for x, n in zip(table[name].to_pylist(), sizes, strict=True))])
        n = unpack("lengths", np.uint8).astype(np.int64)
        ends = np.cumsum(sizes)
        raw = [pa.decompress(x, decompressed_size=int((n[b - k : b] + size - 1).sum()), codec="zstd", asbytes=True) for x, k, b in zip(table["bytes"].to_pylist(), sizes, ends.tolist(), strict=True)]
        tags = np.frombuffer(b"".join(table["tags"].to_pylist()), np.uint32)
        masks = previous_factors(np.frombuffer(b"".join(raw), np.uint8), n, unpack("docs", np.int64), tags, size)
        return repeats.answer(key[0].as_py(), table["grp"].to_pylist(), sizes, masks)

    return resolve


def find(docs: DataFrame, spec: repeats.Spec, finish: Callable[[repeats.Part, np.ndarray], pa.RecordBatch], schema: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``schema`` that ``finish(part, suffixes)`` makes for each document from the places of its suffixes with a
    previous factor of ``size`` bytes."""
    with repeats.Dealt(docs, spec, id_col=id_col, text_col=text_col) as dealt:
        buckets = dealt.buckets

        def send(key, table, answers):
            return Runs(repeats.Group(table, spec, buckets), answers).messages(key[0].as_py())

        def last(key, table, both):
            kind = both["kind"].to_numpy()
            of = lambda k: both.filter(pa.array(kind == k))
            found = Runs(repeats.Group(table, spec, buckets), of(0))
            masks = repeats.answers_of(of(1), found.cuts, len(found.sent), np.uint32)
            return pa.Table.from_batches([finish(p, s) for p, s in found.repeated(masks)])

        sent = dealt.grouped.cogroup(dealt.answers.groupBy("grp")).applyInArrow(send, _RUNS)
        factors, path = storage.written(sent.groupBy("bucket").applyInArrow(_resolver(spec.size), repeats.ANSWER), "factors")
        storage.remove(dealt.spark)
        both = dealt.answers.selectExpr("*", "0 AS kind").unionByName(factors.selectExpr("*", "1 AS kind"))
        out, _ = storage.written(dealt.grouped.cogroup(both.groupBy("grp")).applyInArrow(last, schema), "repeats")
        storage.remove(dealt.spark, path)
    return out


def _digest(size: int):
    def finish(part: repeats.Part, windows: np.ndarray) -> pa.RecordBatch:
        gone = covered(len(part.data), windows, size)
        removed = np.concatenate([[0], np.cumsum(gone)])[part.starts]
        kept = part.starts - removed
        raw = part.data[~gone].tobytes()
        digests = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(kept[:-1].tolist(), kept[1:].tolist(), strict=True)]
        spans: list[list[dict]] = [[] for _ in part.ids]
        for d in np.flatnonzero(np.diff(removed)):
            a, b = runs(gone[part.starts[d] : part.starts[d + 1]])
            spans[d] = [{"start": x, "stop": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        return pa.RecordBatch.from_pydict({"doc_id": [None if i == repeats.NO_ID else i for i in part.ids.tolist()], "n_bytes": part.lengths, "n_removed": np.diff(removed), "n_spans": [len(s) for s in spans], "kept_sha256": digests, "spans": spans}, schema=pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))]))

    return finish


def removed_spans(docs: DataFrame, *, size: int = 50, k: int = 25, hot: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Byte spans of UTF-8 text that documents of smaller id have too, one row per document: doc_id, n_bytes,
    n_removed, n_spans, kept_sha256 and spans (start, stop in bytes).

    Null text counts as empty; however long, a text is one document. Rows that repeat a doc_id are judged alike and do not remove each other; a null
    doc_id counts as larger than all. Other columns are ignored.
    """
    return find(docs, repeats.Spec("byte", size, k, hot=hot), _digest(size), _SCHEMA, id_col=id_col, text_col=text_col)


def _cleaned(size: int):
    def finish(part: repeats.Part, windows: np.ndarray) -> pa.RecordBatch:
        gone = covered(len(part.data), windows, size)
        texts, digests = [], []
        for a, b in zip(part.starts[:-1].tolist(), part.starts[1:].tolist(), strict=True):
            raw, cut = part.data[a:b], gone[a:b]
            digests.append(hashlib.sha256(raw.tobytes()).hexdigest())
            if cut.any():
                # a character goes only if all its bytes do
                char = np.cumsum(raw & 0xC0 != 0x80) - 1
                whole = np.bincount(char, weights=~cut) == 0
                raw = raw[~whole[char]]
            texts.append(raw.tobytes().decode("utf-8", "replace"))
        return pa.RecordBatch.from_pydict({"doc_id": pa.array(part.ids, pa.int64(), mask=part.ids == repeats.NO_ID), "text": pa.array(texts, pa.string()), "text_sha256": pa.array(digests, pa.string())})

    return finish


def without_repeats(docs: DataFrame, *, size: int = 50, k: int = 25, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text of every row, without the characters that lie wholly in removed spans (see ``removed_spans``), and
    text_sha256 (hex) of the text before that, which tells rows of one doc_id apart."""
    return find(docs, repeats.Spec("byte", size, k), _cleaned(size), "doc_id long, text string, text_sha256 string", id_col=id_col, text_col=text_col)


#: The same rows from all windows of all documents; bytes are written as pairs of hexadecimal digits.
OP9_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM d, unnest(range(length(h) // 2 - 49)) AS t(i)),
firsts AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
marked AS (SELECT doc_id, i FROM windows JOIN firsts USING (s) WHERE least < doc_id),
units AS (SELECT doc_id, j, substr(h, 2 * j + 1, 2) AS x FROM d, unnest(range(length(h) // 2)) AS t(j)),
covered AS (
  SELECT u.doc_id, j, x, coalesce(count(m.i) OVER (PARTITION BY u.doc_id ORDER BY j ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0, false) AS gone
  FROM units u LEFT JOIN marked m ON m.doc_id = u.doc_id AND m.i = u.j),
runs AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY j) AS first FROM covered)
SELECT d.doc_id, length(any_value(h)) // 2 AS n_bytes, count_if(gone)::BIGINT AS n_removed, count_if(first)::BIGINT AS n_spans,
  sha256(unhex(coalesce(string_agg(x, '' ORDER BY j) FILTER (WHERE NOT gone), ''))) AS kept_sha256
FROM d LEFT JOIN runs USING (doc_id) GROUP BY d.doc_id
"""


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return removed_spans(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
