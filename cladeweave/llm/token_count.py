"""Token counts by byte-pair merging with a heap and a linked list.

The symbols of a word are a linked list; a heap holds its adjacent pairs by rank and
place. The pair of lowest rank is popped again and again and merged, pairs that no
longer stand are skipped, and each merge adds the two new pairs. The count is the
number of first symbols less the number of merges; no identifiers are made.

Ranks and special tokens come from a tokenizer file in the JSON format, whose path is
a parameter. A special token in a text counts as one token.

Nulls and odd cases: a null text counts as empty and has no tokens; repeated rows each
give a row; a text of any length is counted whole; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, map_batches, utf8
from .tokens import Memo, pieces

SCHEMA = "doc_id long, n_bytes long, n_tokens long"

#: fixed by the byte-level pre-tokeniser
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in the file: printable ones for themselves, the
    others for code points from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def count_symbols(word: bytes, ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Number of symbols left of ``word`` after all merges."""
    n = len(word)
    if n < 2:
        return n
    symbol: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbol[i], symbol[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if symbol[i] is None or j < 0 or ranks.get((symbol[i], symbol[j])) != rank:
            continue
        symbol[i], symbol[j] = symbol[i] + symbol[j], None
        merges += 1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            if (r := ranks.get((symbol[i], symbol[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get((symbol[h], symbol[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return n - merges


class Counter:
    """Counts the tokens of texts as the tokenizer file has them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        raw = lambda s: bytes(letters[c] for c in s)
        self.ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.memo = Memo(self._piece)

    def _plain(self, text: str) -> int:
        return sum(count_symbols(utf8(w), self.ranks) for w in PATTERN.findall(text))

    def _piece(self, text: str) -> int:
        if self._special is None or not self._special.search(text):
            return self._plain(text)
        return sum(map(self._plain, self._special.split(text))) + len(self._special.findall(text))

    def count(self, text: str | None) -> int:
        return sum(self.memo.all(pieces(text or "")))


_counter = lru_cache(maxsize=1)(Counter)


def counter(path: str) -> Counter:
    claim("counter", _counter.cache_clear)
    return _counter(path)


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every document."""

    def batch(rows: dict[str, list]) -> dict[str, list]:
        c = counter(path)
        return {
            "doc_id": rows["doc_id"],
            "n_bytes": [len(utf8(t)) for t in rows["text"]],
            "n_tokens": [c.count(t) for t in rows["text"]],
        }

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), batch, SCHEMA)
