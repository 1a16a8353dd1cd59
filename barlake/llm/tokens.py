"""Exact token ids with the tokenizers library, with repeated words encoded once.

Encoding costs about ten microseconds a word, looking a word up a tenth of that.
A text is cut where the tokenizer's own pre-tokenizer always cuts: at single
spaces and line ends.  Each piece is encoded by the library once and kept in a
cache of bounded size.  A text in which such cuts might not be the tokenizer's
own (unusual white space, special token strings) is encoded as a whole, so ids
are always those of encoding the whole text.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable

import numpy as np

#: Pieces kept by one worker, in two generations of this size.
CACHE = 500_000
#: White space other than space and line end.
_ODD = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 ᠎    ⁠　﻿" + "".join(map(chr, range(0x2000, 0x200E)))
_ODD_ASCII = "".join(c for c in _ODD if c < "\x80")
#: Two spaces or line ends in a row.
_GAPS = ("  ", "\n\n", "\n ", " \n")
#: Latin letters (composed forms) other than ASCII ones, and the marks after a word.
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_MARKS = ".,;:!?"
#: How byte-level vocabularies show bytes that are no printable Latin-1 character: by code points from 256 on, in order.
_SHOWN = {b: 256 + k for k, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}
_PACK = [struct.Struct(f"<{n}I").pack for n in range(33)]


def _packed(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)


def _odd(text: str) -> bool:
    """Whether cuts at single spaces and line ends might not be the tokenizer's; looking for one character at a time is a scan of memory."""
    return any(c in text for c in (_ODD_ASCII if text.isascii() else _ODD)) or "<|" in text


def _gaps(text: str) -> bool:
    """Whether there is a run of white space, or white space at either end; ``text`` is not empty."""
    return text[0] in " \n" or text[-1] in " \n" or any(g in text for g in _GAPS)


class Cache(dict):
    """piece -> little-endian unsigned 32-bit ids; a missing piece is encoded."""

    def __init__(self, encode: Callable[[str], bytes], limit: int = CACHE):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Ids of whole texts as bytes of little-endian unsigned 32-bit integers.

    ``spaces``: whether the vocabulary keeps white space (then a piece carries
    the space before it) or drops it.
    """

    def __init__(self, file: str, spaces: bool, limit: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.spaces = spaces
        self.end_of_line = self.whole("\n") if spaces else b""
        self.inner = Cache(self._inner, limit)
        self.marks = Cache(self.whole, limit // 4)
        self.first = Cache(self.whole, limit // 4)

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _inner(self, piece: str) -> bytes:
        """A piece with the space before it; letters and the marks after them are separate to the pre-tokenizer."""
        word = piece.rstrip(_MARKS)
        plain = word.isalpha() if word.isascii() else _LATIN.fullmatch(word)
        if not plain:
            return self.whole(" " + piece if self.spaces else piece)
        bare = word if self.spaces else word.lower()
        if bare == piece:
            return self._word(piece)
        ids = self.inner[bare]
        return ids + self.marks[piece[len(word) :]] if len(word) < len(piece) else ids

    def _word(self, word: str) -> bytes:
        """Latin letters only: one pre-token, which goes to the model as it is."""
        if not word.isalpha():
            return self.whole(" " + word if self.spaces else word)
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(_SHOWN)
        return _packed([x.id for x in self.model.tokenize("\u0120" + shown if self.spaces else shown)])

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _odd(text):
            return self.whole(text)
        if not self.spaces:
            return b"".join(map(self.inner.__getitem__, text.split()))
        if _gaps(text):
            return self._runs(text)
        lines = []
        for line in text.split("\n"):
            pieces = line.split(" ")
            head = self.first[pieces[0]]
            pieces[0] = ""
            lines.append(head + b"".join(map(self.inner.__getitem__, pieces[1:])))
        return self.end_of_line.join(lines)

    _RUN = re.compile(" ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]+")

    def _runs(self, text: str) -> bytes:
        """The same for texts with runs of white space: all but the last of a run stand alone, a last space joins the word."""
        get, first = self.inner.__getitem__, self.first.__getitem__
        return b"".join(
            get(x[1:]) if x[0] == " " and len(x) > 1 and x[1] not in " \n" else first(x) for x in self._RUN.findall(text)
        )


class OffsetEncoder:
    """Character spans of the tokens of whole texts, for vocabularies that keep white space.

    A piece's spans are those of encoding it alone, moved to where it stands.
    """

    def __init__(self, file: str, limit: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.pieces = Cache(self._piece, limit)

    def _piece(self, piece: str) -> bytes:
        offsets = self.tokenizer.encode(piece, add_special_tokens=False).offsets
        flat = [x for pair in offsets for x in pair]
        return struct.pack(f"<{len(flat)}i", *flat)

    def spans(self, text: str | None) -> np.ndarray:
        """(tokens, 2) starts and ends in code points, ends exclusive."""
        if not text:
            return np.empty((0, 2), np.int64)
        if _odd(text):
            return np.frombuffer(self._piece(text), "<i4").reshape(-1, 2).astype(np.int64)
        cut = Encoder._RUN.findall(text)
        parts = list(map(self.pieces.__getitem__, cut))
        each = np.fromiter(map(len, parts), np.int64, len(parts)) // 8
        ends = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
        starts = np.concatenate(([0], ends[:-1]))
        spans = np.frombuffer(b"".join(parts), "<i4").reshape(-1, 2)
        return spans + np.repeat(starts, each)[:, None]


_ENCODERS: dict[tuple[type, str, bool], Encoder | OffsetEncoder] = {}


def encoder(file: str, spaces: bool) -> Encoder:
    """One encoder for each worker process and file, so that its cache outlives a task."""
    key = (Encoder, file, spaces)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(file, spaces)
    return _ENCODERS[key]


def offset_encoder(file: str) -> OffsetEncoder:
    key = (OffsetEncoder, file, True)
    if key not in _ENCODERS:
        _ENCODERS[key] = OffsetEncoder(file)
    return _ENCODERS[key]
