"""Cutting texts into pieces that can be tokenised one by one, with a bounded memo.

The pre-tokeniser of byte-level BPE never joins what stands before a space to what
follows it when a non-space comes next, so a text falls apart there and every piece
can be looked up. Pieces repeat as words do; each distinct one is tokenised once per
worker and memo.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: entries of a generation of a memo
MEMO = 300_000
#: longer pieces are not remembered
MEMO_LENGTH = 64

#: a space after which no new piece begins; control characters are treated as white space
_JOINED = re.compile(r" (?=[\s\x1c-\x1f\x85]|\Z)")


def pieces(text: str) -> list[str]:
    """``text`` in pieces; all but the first lack their leading space."""
    parts = text.split(" ")
    if not _JOINED.search(text):
        return parts
    found = [parts[0]]
    for part in parts[1:]:
        if not part or part[0].isspace() or part[0] in "\x1c\x1d\x1e\x1f\x85":
            found[-1] += " " + part
        else:
            found.append(part)
    return found


class Memo(dict):
    """Results by piece, the leading space being understood.

    There are two generations of at most ``limit`` entries each: when the young one is
    full it becomes the old one, whose entries move on as they are met again.
    """

    def __init__(self, fn: Callable[[str], object], limit: int = MEMO):
        super().__init__()
        self._fn, self._limit, self._old = fn, limit, {}

    def __missing__(self, piece: str):
        result = self._old.get(piece)
        if result is None:
            result = self._fn(" " + piece)
        self.add(piece, result)
        return result

    def add(self, piece: str, result) -> None:
        if len(piece) <= MEMO_LENGTH:
            self.make_room(1)
            self[piece] = result

    def make_room(self, n: int) -> None:
        if len(self) + n > self._limit:
            self._old = dict(self)
            self.clear()

    def unknown(self, wanted: set[str]) -> list[str]:
        """Those of ``wanted`` that are worth remembering and not known."""
        old = self._old
        return [p for p in wanted if p not in self and p not in old and len(p) <= MEMO_LENGTH]

    def all(self, parts: list[str]) -> list:
        """Results of the :func:`pieces` of a text in order."""
        found = list(map(self.__getitem__, parts[1:]))
        return [self._fn(parts[0]), *found] if parts[0] else found


# --- many texts at once -------------------------------------------------------------

#: what makes a plain split at spaces wrong: a space at an end, or before white space
_ODD = r"^ | $| [\s\v\x1c-\x1f\x{85}\p{Z}]"
_CUT = re.compile(r"(?<=[^ ]) (?=[^\s\x1c-\x1f\x85])")


@dataclass(frozen=True)
class Words:
    """The words of some texts: ``texts[i]`` is ``words[codes[ends[i - 1]:ends[i]]]`` joined by
    spaces. It is cut at every single space before a character that is not white space."""

    words: list[str]
    codes: np.ndarray
    ends: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.append(0, self.ends[:-1]).astype(np.int64)


def cut_words(texts: list[str]) -> Words:
    """Cut ``texts`` column-wise; only those with odd white space are looked at one by one.
    A text without characters has one empty word."""
    column = pa.array(texts, pa.large_string())
    odd = pc.match_substring_regex(column, _ODD).to_numpy(zero_copy_only=False).astype(bool)
    lists = [pc.split_pattern(column.filter(pa.array(~odd)), " ")]
    if odd.any():
        lists.append(pa.array([_CUT.split(texts[i]) for i in np.flatnonzero(odd)], lists[0].type))
    sizes = np.concatenate([pc.list_value_length(a).to_numpy(zero_copy_only=False) for a in lists]).astype(np.int64)
    flat = pa.concat_arrays([a.flatten() for a in lists]).dictionary_encode()
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if odd.any():  # back into the order of the texts
        came = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
        place = np.argsort(came)
        starts = (np.cumsum(sizes) - sizes)[place]
        sizes = sizes[place]
        shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        codes = codes[np.arange(len(codes)) + shift]
    return Words(flat.dictionary.to_numpy(zero_copy_only=False).tolist(), codes, np.cumsum(sizes))


def gather(values: np.ndarray, ends: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """The ranges of ``values`` that ``ends`` divides it into, those ``picked``, side by side."""
    offsets = pa.array(np.append(0, ends), pa.int64())
    return pa.LargeListArray.from_arrays(offsets, pa.array(values)).take(pa.array(picked)).flatten().to_numpy(zero_copy_only=False)
