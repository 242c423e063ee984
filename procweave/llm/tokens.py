"""Whole texts through the tokenizers library, each distinct piece once.

Both public vocabularies split a text before BPE, and a space between two characters that are no white space always
is such a split: nothing in their patterns spans it or looks across it. So a text is encoded piece by piece, and the
ids of frequent pieces are remembered. What is no such space (runs of white space, line ends, special tokens) stays
inside a piece. ``tests/llm`` holds the ids against whole texts encoded by the library.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
from array import array
from collections.abc import Sequence

import numpy as np

from . import worker

_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: White space other than space and line feed; a text that holds any is split with care.
_ODD_ASCII = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
_ODD = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Pieces remembered by a worker; further ones are encoded again for each batch.
REMEMBERED = 500_000
_LETTERS, _MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"!-&(-/:-@\[-`{-~"
#: A word of Latin letters and marks behind it: two pre-tokens of either vocabulary, whatever stands around them. All
#: these letters are their own NFC form.
_WORD_AND_MARKS = re.compile(f"([{_LETTERS}]+)([{_MARKS}]*)").fullmatch
#: The word vocabulary's split into letters, single digits and runs of others.
_BY_KIND = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_AT_ONCE = 8192
_IN_A_ROW = 512


class Encoder:
    """``leading``: pieces after the first keep their space (byte-level vocabularies); else white space is dropped."""

    def __init__(self, path: str, leading: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already run side by side
        from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.leading = leading
        self._code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self._sizes = np.array([len(x) for x in byte_tokens(path)]) if leading else None
        steps = self.tokenizer.normalizer
        self._lowers = not leading and isinstance(steps, normalizers.Sequence) and [type(x).__name__ for x in steps] == ["NFC", "Replace", "Lowercase"]
        self._added = [a.content.lower() for a in self.tokenizer.get_added_tokens_decoder().values()]
        before = self.tokenizer.pre_tokenizer
        plain = isinstance(before, pre_tokenizers.ByteLevel) and before.use_regex and not before.add_prefix_space and steps is None if leading else self._lowers and _BY_KIND in str(before) and "use_regex=False" in str(before)
        # words go to the model itself if the vocabulary's steps before it are those that _WORD_AND_MARKS allows for
        self._words = plain and isinstance(self.tokenizer.model, models.BPE) and not any(re.fullmatch(f"[{_LETTERS}]*[{_MARKS}]*", a) for a in self._added)
        self._model, self._marks = self.tokenizer.model, {}
        self._first: dict[str, bytes] = {}
        self._rest: dict[str, bytes] = {} if leading else self._first

    def _lower(self, text: str) -> str:
        """The text in lower case if the vocabulary's own steps (NFC, then each character's lower case) lead to the same;
        so pieces that differ in case only are encoded once. A final sigma depends on its place, so it is left alone."""
        if self._lowers and (text.isascii() or "\u03a3" not in text and unicodedata.is_normalized("NFC", text)):
            low = text.lower()
            if (low.isascii() or unicodedata.is_normalized("NFC", low)) and not any(a in low for a in self._added):
                return low
        return text

    def _split(self, text: str) -> list[str]:
        """Pieces in order. Only the first may start, and only the last may end, with white space, so pieces that are
        remembered mean the same in every text."""
        if not self.leading:
            return self._lower(text).split(" ")
        pieces = text.split(" ")
        if ("" in pieces or "\n " in text or " \n" in text or any(c in text for c in _ODD_ASCII) or not text.isascii() and any(c in text for c in _ODD)):
            return _SAFE_SPACE.split(text)
        return pieces

    def _ask(self, pieces: list[str], prefix: str, known: dict[str, bytes]) -> None:
        """Add the library's ids of pieces to ``known``."""
        if self._words:
            pieces = self._ask_words(pieces, prefix, known)
        if self.leading and prefix:
            pieces = self._ask_in_a_row(pieces, known)
        for i in range(0, len(pieces), _AT_ONCE):
            some = pieces[i : i + _AT_ONCE]
            for piece, e in zip(some, self.tokenizer.encode_batch_fast([prefix + p for p in some], add_special_tokens=False), strict=True):
                known[piece] = array(self._code, e.ids).tobytes()

    def _ask_words(self, pieces: list[str], prefix: str, known: dict[str, bytes]) -> list[str]:
        """Pieces of words, with marks behind them and single line ends between: each word is one text for the model, and
        so are marks and a line end (which the word vocabulary drops). Returns the other pieces."""
        others, between = [], self._text("\u010a") if self.leading else b""
        for piece in pieces:
            whole = _WORD_AND_MARKS(piece)
            if whole and not (self._lowers and piece != piece.lower()):
                known[piece] = self._word(whole, prefix, known)
                continue
            lines = piece.split("\n")
            parts = [_WORD_AND_MARKS(x) for x in lines]
            if None in parts or self._lowers and piece != piece.lower():
                others.append(piece)
                continue
            ids = self._word(parts[0], prefix, known)
            for one in parts[1:]:
                ids += between + self._word(one, "", self._first)
            known[piece] = ids
        return others

    def _word(self, part: re.Match[str], prefix: str, known: dict[str, bytes]) -> bytes:
        word, marks = part.groups()
        ids = known.get(word)
        if ids is None:
            text = word if word.isascii() else word.encode().decode("latin-1").translate(_PRINTED)
            ids = known[word] = self._text("\u0120" + text if prefix else text)
        if not marks:
            return ids
        if marks not in self._marks:
            if len(self._marks) > _AT_ONCE:
                self._marks.clear()
            self._marks[marks] = self._text(marks)
        return ids + self._marks[marks]

    def _text(self, text: str) -> bytes:
        """The model's ids of one pre-token."""
        return array(self._code, [t.id for t in self._model.tokenize(text)]).tobytes()

    def _ask_in_a_row(self, pieces: list[str], known: dict[str, bytes]) -> list[str]:
        """Pieces as one text with spaces between, whose ids are cut where the bytes of each piece end. Returns pieces that
        must be asked for alone: they end in white space, or an id runs across an end."""
        alone = [p for p in pieces if p[-1].isspace()]
        if alone:
            pieces = [p for p in pieces if not p[-1].isspace()]
        for i in range(0, len(pieces), _IN_A_ROW):
            some = pieces[i : i + _IN_A_ROW]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.cumsum([1 + (len(p) if p.isascii() else len(p.encode())) for p in some])
            covered = np.cumsum(self._sizes[ids])
            cut = np.minimum(np.searchsorted(covered, ends), len(covered) - 1)
            if not (covered[cut] == ends).all():
                alone += some
                continue
            raw, start = ids.tobytes(), 0
            for piece, stop in zip(some, ((cut + 1) * self.dtype.itemsize).tolist(), strict=True):
                known[piece] = raw[start:stop]
                start = stop
        return alone

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text as packed integers of ``dtype``; null counts as empty."""
        split = [self._split(t) if t else [] for t in texts]
        sizes = len(self._first), len(self._rest)
        # each piece is looked up once; only those that are not remembered are gone through again
        found = [list(map(self._rest.get, p)) for p in split]
        for p, ids in zip(split, found, strict=True):
            if p:
                ids[0] = self._first.get(p[0])
        gaps = [[i for i, x in enumerate(ids) if x is None] for ids in found]
        heads = {p[0] for p, gap in zip(split, gaps, strict=True) if gap and gap[0] == 0}
        seen = {p[i] for p, gap in zip(split, gaps, strict=True) for i in gap if i}
        self._ask([p for p in heads if p not in self._first], "", self._first)
        self._ask([p for p in seen if p not in self._rest], " " if self.leading else "", self._rest)
        out = []
        for p, ids, gap in zip(split, found, gaps, strict=True):
            for i in gap:
                ids[i] = self._rest[p[i]] if i else self._first[p[0]]
            out.append(b"".join(ids))
        for known, size in zip((self._first, self._rest), sizes, strict=True):
            # dictionaries keep their order: what this batch added is at the end
            while len(known) > max(size, REMEMBERED):
                known.popitem()
        return out


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, leading: bool) -> Encoder:
    """The worker's encoder for a vocabulary file; its pieces stay known between batches and tasks."""
    if (path, leading) not in _encoders:
        worker.forget()
        _encoders[path, leading] = Encoder(path, leading)
    return _encoders[path, leading]


def _printed() -> dict[int, str]:
    """The printable character of each byte in a byte-level vocabulary: printable Latin-1 is itself, the others follow
    from U+0100 on in the order of their values."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_PRINTED = _printed()


@functools.cache
def byte_tokens(path: str) -> np.ndarray:
    """Bytes of each id of a byte-level vocabulary, whose strings write each byte as one printable character."""
    from tokenizers import Tokenizer

    value = {c: b for b, c in _PRINTED.items()}
    t = Tokenizer.from_file(path)
    out = np.empty(t.get_vocab_size(), dtype=object)
    for token, i in t.get_vocab().items():
        out[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
    return out
