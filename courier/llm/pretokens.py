"""Cutting texts into pre-tokens, and a worker's cache of encoded pieces.

A byte-level tokenizer cuts a text by a pattern over letters, digits and white space and
encodes each cut by itself.  The pattern is run here by the ``regex`` module; where its
tables of letters might be newer or older than the tokenizer's own, the tokenizer is asked
for a character's class, and the cuts are found on a copy of the text in which such
characters stand replaced by settled ones of that class.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Sequence
from itertools import chain
from struct import pack

import numpy as np

from courier.llm.tokens import CACHED, LONGEST_CACHED, SETTLED

#: A settled character of each class: letter, digit, other, white space.
_STANDS_FOR = {"a": "a", "1": "1", "!": "!", "": "　"}


def tokenizer_path(name: str) -> str:
    """The file on this machine: a public tokenizer's name, or a path as it is."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Cutter:
    """Cuts texts by ``pattern``.  ``one_cut`` tells whether the tokenizer keeps a text whole."""

    def __init__(self, pattern: str, one_cut: Callable[[str], bool]) -> None:
        import regex

        compiled = regex.compile(pattern)
        self._all, self._each = compiled.findall, compiled.finditer
        self._settled = regex.compile(SETTLED).fullmatch
        self._unsettled = regex.compile("[^" + SETTLED[1:-2] + "]").sub
        self._one_cut = one_cut
        self._stand_ins: dict[str, str] = {}

    def _stand_in(self, match) -> str:
        char = match[0]
        if char not in self._stand_ins:
            kind = next((k for k in "a1!" if self._one_cut(k + char)), "")
            self._stand_ins[char] = _STANDS_FOR[kind]
        return self._stand_ins[char]

    def __call__(self, text: str) -> list[str]:
        if self._settled(text):
            return self._all(text)
        shadow = self._unsettled(self._stand_in, text)
        return [text[m.start() : m.end()] for m in self._each(shadow)]


def _packed(ids: Sequence[int]) -> bytes:
    """Little-endian unsigned 32-bit integers; short lists are dear to make arrays of."""
    return np.asarray(ids, "<u4").tobytes() if isinstance(ids, np.ndarray) else pack(f"<{len(ids)}I", *ids)


class PieceCache:
    """Ids of pieces of text as little-endian unsigned 32-bit integers, each encoded once.

    Holds at most ``kept`` pieces, and none of more than ``longest`` characters.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], Iterable[Sequence[int]]],
        kept: int = CACHED,
        longest: int = LONGEST_CACHED,
    ) -> None:
        self._encode, self._kept, self._longest = encode, kept, longest
        self._ids: dict[str, bytes] = {}

    def ids(self, cuts: list[list[str]]) -> list[bytes]:
        """The ids of each text, given as its pieces."""
        if len(self._ids) > self._kept:
            self._ids = {}
        known = self._ids
        missing = list(set(chain.from_iterable(cuts)).difference(known))
        known.update(
            (piece, _packed(ids))
            for piece, ids in zip(missing, self._encode(missing) if missing else ())
        )
        get = known.__getitem__
        out = [b"".join(map(get, pieces)) for pieces in cuts]
        for piece in missing:
            if len(piece) > self._longest:
                del known[piece]
        return out
