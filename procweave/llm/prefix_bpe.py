"""Merge-type BPE (SentencePiece) by a table of last tokens, and its decoding.

A text's encoding is a chain of tokens of which each two neighbours are the encoding of their own text; so each prefix of
a text ends in exactly one token. The table holds it: an automaton over all pieces reports those that end at a place, and
the one is taken that is compatible with the last token of the prefix before it. The ids then follow backwards from the end.
This is linear in the text, whatever its words, and needs no queue of merges.

Text is cut first where no merge can cross, and what is cut is encoded once: a line end is in no piece, no piece holds a
space mark behind another character, nor anything but a letter behind a Latin letter. Each of these cuts is made only if
it is true of all pieces of the model.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Cut texts and pairs remembered by a worker; further ones are worked out again.
REMEMBERED = 400_000
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: Cuts from fine to coarse: what they cut, and what no piece may hold.
_CUTS = (
    (f"\n|{MARK}*[^{MARK}{_LETTERS}\n]*[{_LETTERS}]+|{MARK}*[^{MARK}{_LETTERS}\n]+|{MARK}+", f"\n|[^{MARK}]{MARK}|[{_LETTERS}][^{_LETTERS}]"),
    (f"\n|{MARK}*[^{MARK}\n]+|{MARK}+", f"\n|[^{MARK}]{MARK}"),
    (r"(?s:.+)", r"(?!)"),
)
_NEVER = float("-inf")
_AT_ONCE = 500
_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_IDS = "doc_id long, ids binary"


class Model:
    """A SentencePiece model file of type BPE with identity normalization."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        piece = sentencepiece_model_pb2.ModelProto.SentencePiece
        if proto.trainer_spec.model_type != proto.trainer_spec.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or kinds & {piece.USER_DEFINED, piece.UNUSED}:
            raise ValueError("a BPE model without a character map, user-defined or unused pieces is needed")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.pieces = [p.piece for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == piece.NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == piece.NORMAL}
        self.byte_ids = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if proto.trainer_spec.byte_fallback else [self.library.unk_id()] * 256
        self.fallback = proto.trainer_spec.byte_fallback
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.automaton.add_word(text, (len(text), i))
        self.automaton.make_automaton()
        self.cut = next(re.compile(cut).findall for cut, held in _CUTS if not any(map(re.compile(held).search, self.ids)))
        self._alone: dict[int, bool] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._known: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The merges themselves, for the short texts of one or two pieces: best score first, then the leftmost."""
        parts, score = list(text), self.scores.get
        made = [score(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while made and (best := max(made)) != _NEVER:
            k = made.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del made[k]
            for i in (k - 1, k):
                if 0 <= i < len(made):
                    made[i] = score(parts[i] + parts[i + 1], _NEVER)
        return parts

    def stands_alone(self, token: int) -> bool:
        if token not in self._alone:
            self._alone[token] = self.merged(self.pieces[token]) == [self.pieces[token]]
        return self._alone[token]

    def compatible(self, before: int, token: int) -> bool:
        """Do the two pieces in a row encode to just these two?"""
        key = before, token
        found = self._pairs.get(key)
        if found is None:
            if len(self._pairs) >= REMEMBERED:
                self._pairs.clear()
            a, b = self.pieces[before], self.pieces[token]
            found = self._pairs[key] = self.merged(a + b) == [a, b]
        return found

    def last_tokens(self, text: str) -> list[int]:
        """For each prefix but the empty one its last token; -1 where the last character is in no piece."""
        last, found, pairs = [-1] * len(text), -1, self._pairs.get
        for end, (length, token) in self.automaton.iter(text):
            if end == found:
                continue
            start = end - length
            before = last[start] if start >= 0 else -1
            if before < 0:
                fits = self.stands_alone(token)
            elif (fits := pairs((before, token))) is None:
                fits = self.compatible(before, token)
            if fits:
                last[end], found = token, end
        return last

    def _encode_part(self, text: str) -> bytes:
        last, out, end = self.last_tokens(text), [], len(text) - 1
        while end >= 0:
            token = last[end]
            if token >= 0:
                out.append(token)
                end -= len(self.pieces[token])
            elif self.fallback:
                out += [self.byte_ids[b] for b in reversed(text[end].encode())]
                end -= 1
            else:
                out.append(self.library.unk_id())
                while end >= 0 and last[end] < 0:  # unknown characters in a row are one id
                    end -= 1
        return np.array(out[::-1], "<u4").tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; null counts as empty."""
        if not text:
            return np.empty(0, "<u4")
        parts, known = self.cut(self.prefix + text.replace(" ", MARK)), self._known
        new = set(parts).difference(known)
        out = known if not new or len(known) + len(new) <= REMEMBERED else {}
        for part in new:
            out[part] = self._encode_part(part)
        if out is not known:  # full: this text's own parts stand beside what is remembered
            return np.frombuffer(b"".join([known[p] if p in known else out[p] for p in parts]), "<u4")
        return np.frombuffer(b"".join(map(known.__getitem__, parts)), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """As the library's decode: the first mark was added; ids that are no text, or bytes that are no UTF-8, go to it."""
        raw = b"".join(self.texts[ids].tolist())
        if len(ids) and ids.min() > 2:
            try:
                text = raw.decode()
                return text[1:] if self.prefix and text[:1] == " " and ids[0] != self.byte_ids[0x20] else text
            except UnicodeDecodeError:
                pass
        return self.library.decode(ids.tolist()) if len(ids) else ""

    @functools.cached_property
    def texts(self) -> np.ndarray:
        """The bytes of each id."""
        out = np.empty(len(self.pieces), dtype=object)
        out[:] = [p.replace(MARK, " ").encode() for p in self.pieces]
        if self.fallback:
            for b, i in enumerate(self.byte_ids):
                out[i] = bytes([b])
        return out

    @functools.cached_property
    def decimals(self) -> np.ndarray:
        out = np.empty(len(self.pieces), dtype=object)
        out[:] = [b"%d" % i for i in range(len(self.pieces))]
        return out


@functools.cache
def model(path: str) -> Model:
    """The worker's model of a file; what it has met stays known between batches and tasks."""
    return Model(path)


def _map(docs: DataFrame, path: str, id_col: str, text_col: str, row: Callable[[Model, Sequence, list[np.ndarray]], pa.RecordBatch], schema: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for i in range(0, batch.num_rows, _AT_ONCE):
                some = batch.slice(i, _AT_ONCE)
                yield row(m, some["doc_id"], [m.encode(t) for t in some["text"].to_pylist()])

    return rows.mapInArrow(work, schema)


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (packed 32-bit little-endian) of every row's whole text, without begin or end ids.

    Null text counts as empty and has no ids; rows of equal id, or without one, have one result each. Other columns are
    ignored, whatever their names. A row is encoded by one task in time and memory linear in its text.
    """
    return _map(docs, path, id_col, text_col, lambda m, docs, ids: pa.RecordBatch.from_arrays([docs, pa.array([x.tobytes() for x in ids], pa.binary())], names=["doc_id", "ids"]), _IDS)


def digests(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, then decoded: doc_id, n_tokens, ids_sha256 (decimal ids with commas between) and decoded_sha256,
    without the ids themselves."""

    def row(m, docs, ids):
        digest = lambda raw: hashlib.sha256(raw).hexdigest()
        columns = [
            docs,
            pa.array([len(x) for x in ids], pa.int64()),
            pa.array([digest(b",".join(m.decimals[x].tolist())) for x in ids], pa.string()),
            pa.array([digest(m.decode(x).encode()) for x in ids], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _map(docs, path, id_col, text_col, row, _DIGESTS)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of packed ids; null ids have null text."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([None if x is None else m.decode(np.frombuffer(x, "<u4")) for x in batch["ids"].to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, text string")


def op11_prefix_table(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
