"""Token ids of whole texts by the tokenizers library, as packed integers.

The texts of a batch are cut into words column-wise, and every different word into runs
of letters and of marks, where the pre-tokenizer cuts too. Every run is looked up, new ones
are encoded by the library, and the ids of all words are gathered by one look-up of ranges,
so no Python code runs per word of a text. Runs repeat where words are new. Words with
other characters than plain letters and marks stay whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import claim
from .tokens import MEMO_LENGTH, cut_words, gather

END_ID = 2
#: remembered runs and words, and their ids
WORDS, IDS = 600_000, 1 << 23
#: fixed by byte-level vocabularies: the letter that stands for a space
SPACE = "\u0120"
#: letters, and marks that are no part of a contraction
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481"
MARKS = r"!-&(-/:-@\[-`{-~"
_RUN = re.compile(f" ?[{LETTERS}]+| ?[{MARKS}]+|\n")
#: a word that is not runs and single line feeds between them
_WHOLE = f"[^{LETTERS}{MARKS}\n]|^$|^\n|\n\n|\n$"
#: a word that is empty or begins with white space, among words joined by spaces
_SPACE_BEFORE = re.compile(r"(?:\A| )(?:\s|\Z)")


class Encoder:
    """Ids by a tokenizer file; ``wide`` tells whether they need 32 bits."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_padding()
        self._tokenizer.no_truncation()
        self.wide = max(self._tokenizer.get_vocab_size(with_added_tokens=True), END_ID + 1) > 1 << 16
        self.dtype = np.dtype("<u4" if self.wide else "<u2")
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self._spaced[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._runs = self._cuts_at_runs()

        self._forget()

    def _cuts_at_runs(self) -> bool:
        """Whether the pre-tokenizer cuts at runs, asked with all letters and marks."""
        own = self._tokenizer.pre_tokenizer
        if self._tokenizer.normalizer is not None or own is None:
            return False
        every = [chr(c) for c in range(0x500)]
        letters, marks = ("".join(c for c in every if re.match(f"[{x}]", c)) for x in (LETTERS, MARKS))
        text = f" {letters}{marks}{letters}\n{marks}\n{letters} {marks}{letters}"
        return [text[a:b] for _, (a, b) in own.pre_tokenize_str(text)] == _RUN.findall(text)

    def _forget(self) -> None:
        """Begin with the end id alone; a run is known by its place among the ranges of ids,
        and so is a word at the beginning of a text, as a tuple."""
        self._place: dict[str | tuple[str], int] = {}
        self._ids, self._ends = np.array([END_ID], self.dtype), np.array([1])

    def _ids_of(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype) for e in encoded]

    def _learn(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Words with a space before, their ids side by side and the ends of those.

        Words that cannot run into each other are encoded as one text. Each begins with the
        only space it has, so its first token is the only one that begins with a space,
        which tells the words apart in the result.
        """
        together = " ".join(words)
        added = [a for a in self._added if a in together]
        rest: list[str] = []
        if added or together.count(" ") >= len(words) or _SPACE_BEFORE.search(together):
            rest = [w for w in words if not w or " " in w or w[0].isspace() or added and any(a in w for a in added)]
        apart = set(rest)
        plain = [w for w in words if w not in apart] if rest else words
        (ids,) = self._ids_of([" " + (" ".join(plain) if rest else together)]) if plain else (np.zeros(0, self.dtype),)
        starts = np.flatnonzero(self._spaced[ids])
        if len(starts) != len(plain) or len(plain) and starts[0] != 0:
            plain, rest, starts, ids = [], words, starts[:0], ids[:0]
        own = self._ids_of([" " + w for w in rest])
        ends = np.append(starts[1:], len(ids)) if len(plain) else starts
        return [*plain, *rest], np.concatenate([ids, *own]), np.append(ends, len(ids) + np.cumsum([len(x) for x in own], dtype=np.int64))

    def _add(self, keys: list, ids: np.ndarray, ends: np.ndarray) -> None:
        at = len(self._ends)
        self._ends = np.append(self._ends, len(self._ids) + ends)
        self._ids = np.append(self._ids, ids)
        self._place.update(zip(keys, range(at, at + len(keys))))

    def _parts(self, words: list[str]) -> tuple[np.ndarray, list[str]]:
        """The order in which ``words`` are taken, and their runs in it; the first run of a
        word, and no other, begins with the space before the word."""
        column = pa.array(words, pa.large_string())
        whole = pc.match_substring_regex(column, _WHOLE).to_numpy(zero_copy_only=False).astype(bool) | (not self._runs)
        together = "\n".join(words)
        for added in self._added:
            if added in together:
                whole |= pc.match_substring(column, added).to_numpy(zero_copy_only=False).astype(bool)
        order = np.argsort(whole, kind="stable")
        cut = len(words) - int(whole.sum())
        taken = [words[i] for i in order.tolist()] if cut < len(words) else words
        parts = _RUN.findall(" " + " ".join(taken[:cut])) if cut else []
        return order, [*parts, *(" " + w for w in taken[cut:])]

    def _places(self, parts: list[str], firsts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of runs, and of words at the beginning of a text."""
        place = self._place
        found = np.fromiter(map(place.get, parts, repeat(-1)), np.int64, len(parts))
        unknown = [parts[i] for i in np.flatnonzero(found < 0).tolist()]
        new = dict.fromkeys(unknown)
        spaced = [p[1:] for p in new if p[0] == " "]
        if spaced:
            learned, ids, ends = self._learn(spaced)
            self._add([" " + w for w in learned], ids, ends)
        for keys in ([p for p in new if p[0] != " "], list({(w,) for w in firsts} - place.keys())):
            if keys:
                own = self._ids_of([k if isinstance(k, str) else k[0] for k in keys])
                self._add(keys, np.concatenate(own), np.cumsum([len(x) for x in own]))
        if unknown:
            found[found < 0] = np.fromiter(map(place.__getitem__, unknown), np.int64, len(unknown))
        at_start = np.fromiter((place[(w,)] for w in firsts), np.int64, len(firsts))
        for long in [p for p in new if len(p) > MEMO_LENGTH]:  # not remembered
            del place[long]
        for long in {w for w in firsts if len(w) > MEMO_LENGTH}:
            del place[(long,)]
        return found, at_start

    def documents(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text and the end id."""
        if not texts:
            return []
        if len(self._place) > WORDS or len(self._ids) > IDS:
            self._forget()
        cut = cut_words([t or "" for t in texts])
        order, parts = self._parts(cut.words)
        runs, firsts = self._places(parts, [cut.words[c] for c in cut.codes[cut.starts]])
        # the ids of the end, of the words in that order, and of the first words
        of_runs = np.cumsum(np.diff(self._ends, prepend=0)[runs])
        last = np.append(np.flatnonzero(np.fromiter(map(str.startswith, parts, repeat(" ")), bool, len(parts)))[1:], len(parts)) - 1
        of_firsts = np.cumsum(np.diff(self._ends, prepend=0)[firsts])
        ids = gather(self._ids, self._ends, np.concatenate([[0], runs, firsts]))
        ends = np.concatenate([[1], 1 + of_runs[last], 1 + of_runs[-1] + of_firsts])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(1, len(order) + 1)
        picked = place[cut.codes]
        picked[cut.starts] = len(order) + 1 + np.arange(len(texts))
        picked = np.insert(picked, cut.ends, 0)  # the end id
        size = np.diff(ends, prepend=0)[picked]
        cuts = np.cumsum(size)[cut.ends + np.arange(len(texts))]
        return np.split(gather(ids, ends, picked), cuts[:-1])

    def document(self, text: str | None) -> np.ndarray:
        return self.documents([text])[0]


_encoder = lru_cache(maxsize=1)(Encoder)


def encoder(path: str) -> Encoder:
    claim("encoder", _encoder.cache_clear)
    return _encoder(path)
