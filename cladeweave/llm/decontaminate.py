"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

A text becomes its words in lower case, each followed by one space. Every window of
``window`` consecutive item words is one pattern of the automaton (an item of fewer
words is one pattern). A text is scanned once; a match gives word positions, and
those are mapped to character offsets of the original text.

The patterns are a stated query set. They go to the tasks in blocks of at most
``BLOCK_BYTES`` of pattern text, each an automaton of its own, so that no task holds
more than one automaton of that size however large the benchmark is.

Nulls and odd cases: a null or wordless text has no words and no hits; items without
words or without id are ignored; items that share an id count as one item; repeated
rows of the documents each give a row; empty tables give empty or unhit results; other
columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import claim, keep_texts, map_batches, utf8

WINDOW = 10
BLOCK_BYTES = 2 << 20

#: fixed by the definition of a word
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_PLAIN = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c > 0x7F else 0x20
    for c in range(256)
)

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ]
)


def words(text: str | None) -> list[bytes]:
    return utf8(text).translate(_PLAIN).split()


def windows(text: str | None, size: int) -> set[tuple[bytes, int]]:
    """Patterns of an item with their numbers of words."""
    w = words(text)
    n = min(size, len(w))
    return {(b" " + b" ".join(w[i : i + n]) + b" ", n) for i in range(len(w) - n + 1)} if n else set()


def _automaton(key: str, block):
    claim("decontaminate", _built.cache_clear)
    return _built(key, block)


@lru_cache(maxsize=1)
def _built(key: str, block):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for pattern, (n, items) in block.value.items():
        text = pattern.decode("latin-1")
        automaton.add_word(text, (len(text), n, items))
    automaton.make_automaton()
    return automaton


def _blocks(benchmark: DataFrame, window: int) -> list:
    """Broadcasts of pattern -> (number of words, item ids)."""
    sc = benchmark.sparkSession.sparkContext
    found, block, size = [], {}, 0
    items = benchmark.select(F.col("item_id").cast("string"), "text").na.drop()
    for item, text in items.toLocalIterator():
        for pattern, n in windows(text, window):
            if pattern not in block:
                size += len(pattern)
                block[pattern] = (n, ())
            if item not in block[pattern][1]:
                block[pattern] = (n, (*block[pattern][1], item))
        if size >= BLOCK_BYTES:
            found.append((uuid.uuid4().hex, sc.broadcast(block)))
            block, size = {}, 0
    return found + ([(uuid.uuid4().hex, sc.broadcast(block))] if block else [])


def _scan(text: bytes, automaton) -> tuple[list[tuple[int, int]], set[str]]:
    """Word ranges and items of all matches in a normalised text."""
    matches = list(automaton.iter(text.decode("latin-1")))
    if not matches:
        return [], set()
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    starts = np.searchsorted(spaces, [end - value[0] + 1 for end, value in matches])
    ranges = [(int(s), int(s) + value[1]) for s, (_, value) in zip(starts, matches)]
    return ranges, {item for _, value in matches for item in value[2]}


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, words hit, ids of the items found, and spans of the
    original text as [start, end) in characters."""
    blocks = _blocks(benchmark, window)

    def batch(rows: dict[str, list]) -> dict[str, list]:
        norm = [words(t) for t in rows["text"]]
        out = {"doc_id": rows["doc_id"], "n_words": [len(w) for w in norm]}
        norm = [b" " + b" ".join(w) + b" " if w else b"" for w in norm]
        ranges: dict[int, list] = {}
        items: dict[int, set] = {}
        for key, block in blocks:
            automaton = _automaton(key, block)
            for i, text in enumerate(norm):
                r, found = _scan(text, automaton)
                if r:
                    ranges.setdefault(i, []).extend(r)
                    items.setdefault(i, set()).update(found)
        n_hit, spans = [], []
        for i, text in enumerate(rows["text"]):
            if i not in ranges:
                n_hit.append(0)
                spans.append([])
                continue
            merged: list[list[int]] = []
            for a, b in sorted(ranges[i]):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            at = [m.span() for m in WORD.finditer(text)]
            n_hit.append(sum(b - a for a, b in merged))
            spans.append([[at[a][0], at[b - 1][1]] for a, b in merged])
        return out | {
            "n_hit": n_hit,
            "items": [sorted(items.get(i, ())) for i in range(len(norm))],
            "spans": spans,
        }

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(picked, batch, SCHEMA)


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any hit, with all their columns."""
    blocks = _blocks(benchmark, window)

    def decide(texts: list[str | None]) -> list[bool]:
        norm = [(b" " + b" ".join(words(t)) + b" ").decode("latin-1") for t in texts]
        clean = [True] * len(texts)
        for block in blocks:  # each automaton is made once a step
            automaton = _automaton(*block)
            clean = [c and next(automaton.iter(t), None) is None for c, t in zip(clean, norm)]
        return clean

    return keep_texts(docs, decide)
