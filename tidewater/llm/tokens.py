"""Token ids from a public tokenizer file, piece by piece with a bounded cache.

Both tokenizers used here first split a text into pieces (a word with the blank
before it, a run of marks, ...) and merge within each piece.  Texts of Latin-1
letters, ASCII and line breaks are split here by the same rule, and the ids of
a piece are looked up; an unseen piece goes to the tokenizer's merging step alone.
Any other text is encoded whole, also one that holds the string of an added
token, which is that token's one id, as with the library's defaults.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable

import numpy as np

#: Pieces whose ids one Python worker keeps in each of two generations (about 250 bytes a piece).
CACHE_PIECES = 500_000

# The two files' splitting rules, for the characters below.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!-/:-@\[-`{-~"
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
_WITH_BLANK = re.compile(rf"{_SHORT}| ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\s+(?!\S)|\s+")
_NO_BLANK = re.compile(rf"{_SHORT}|[{_LETTERS}]+|[0-9]|[{_MARKS}]+")
_OTHER = re.compile(rf"[^\n -~{_LETTERS}]")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as one letter: printable bytes as themselves, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Pieces(dict):
    """Packed ids by piece; two generations of at most ``limit`` pieces, the older one without those seen since."""

    def __init__(self, merge, limit: int):
        super().__init__()
        self._merge, self._limit, self._old, self._letters = merge, limit, {}, _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        ids = self._old.get(piece)
        if ids is None:
            found = self._merge(piece.encode("utf-8").decode("latin-1").translate(self._letters))
            ids = struct.pack(f"<{len(found)}I", *[t.id for t in found])
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class PieceTokenizer:
    """Ids of texts as packed little-endian unsigned 32-bit integers.

    ``blank_is_text``: whether a word's leading blank belongs to its tokens
    (byte-level vocabularies), or blanks and case are dropped (vocabularies of
    word ends).
    """

    def __init__(self, path: str, blank_is_text: bool, cache_pieces: int = CACHE_PIECES):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = [t for t in self._tokenizer.get_added_tokens_decoder().values() if t.content]
        self._exact = [t.content for t in added if not t.normalized]
        other = "|".join(re.escape(t.content) for t in added if t.normalized)  # found in the normalised text
        self._other = re.compile(other, re.IGNORECASE) if other else None
        self._blank = blank_is_text
        self._pieces = _Pieces(self._tokenizer.model.tokenize, cache_pieces)

    def _holds_added(self, text: str) -> bool:
        return any(t in text for t in self._exact) or bool(self._other and self._other.search(text))

    def _ask(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        out, whole = [], {}
        pieces_of = _WITH_BLANK.findall if self._blank else _NO_BLANK.findall
        ids_of = self._pieces.__getitem__
        for i, text in enumerate(texts):
            ids = b""
            if text and (_OTHER.search(text) or self._holds_added(text)):
                whole[i] = text
            elif text:
                ids = b"".join(map(ids_of, pieces_of(text if self._blank else text.lower())))
            out.append(ids)
        if whole:
            for i, found in zip(whole, self._ask(list(whole.values()))):
                out[i] = found
        return out


_LOADED: dict[tuple, PieceTokenizer] = {}


def tokenizer(path: str, blank_is_text: bool) -> PieceTokenizer:
    """The worker's tokenizer for a file; its cache lives as long as the worker."""
    key = (path, blank_is_text)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = PieceTokenizer(path, blank_is_text)
    return _LOADED[key]


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
