"""Alignment of two tokenizers' tokens by galloping intersection of their ends.

Both tokenizers read a space and the text: a byte-level BPE file of the tokenizers library
(A) and a sentencepiece model (B), which adds the space itself. Special tokens in a text are
plain text. Both give the same bytes, so the ends of their tokens are two rising lists; where
they meet, a group of A tokens covers the same bytes as a group of B tokens.

:func:`gallop` intersects two such lists: the shorter one drives, each of its ends is looked
for in the longer one from where the last was found, in steps of 1, 2, 4, ... and then by
binary search in the last step. The indices of common ends slice the tokens into groups;
differences of the indices (ranks) are the sizes of the ranges that overlap.

Neither tokenizer joins anything across a single space between two other characters (A: its
pre-tokeniser; B: no piece has a space after another character, which is checked), so texts
are aligned word by word, every different word once per batch and worker; a text whose words
do not give back its bytes is aligned as a whole.

The corpus-wide counts of linked pairs are summed in each task first, then by Spark. Every
document keeps its pairs with their number; the counts come back to it by a join that is a
broadcast only below ``BROADCAST_ROWS`` different pairs, and spread over salts for frequent
pairs beyond.

Nulls and odd cases: null and empty texts, and texts whose bytes B does not give back (it has
its own sign for a space, U+2581), have no tokens and no links; repeated rows each give a row
and count each; rows without doc_id stay; a pair whose count equals the highest of its B id is
best, ties included; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.skew import dimension_join
from ..runtime import materialize
from .common import claim, steps, utf8
from .tokens import cut_words, gather
from .transducer import byte_letters, token_bytes

#: remembered words, and the longest of them
MEMO, MEMO_LENGTH = 120_000, 64
#: bytes of text that are aligned together
STEP = 1 << 19
#: different pairs that a task holds before it hands on their counts, and pairs in one such row
HELD, CHUNK = 1 << 20, 1 << 16
#: largest table of counts that is broadcast: 17 bytes a row
BROADCAST_ROWS = 1_000_000
#: fixed by sentencepiece: its sign for a space
SPACE = "▁"

_LINKED = T.StructType(
    [
        T.StructField("row", T.LongType()),  # null: counts of pairs in the task's documents
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_a", T.LongType()),
        T.StructField("n_b", T.LongType()),
        T.StructField("n_groups", T.LongType()),
        T.StructField("n_links", T.LongType()),
        T.StructField("groups", T.StringType()),
        T.StructField("pairs", T.ArrayType(T.LongType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
    ]
)


def gallop(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Indices in two strictly rising lists of the values that they share."""
    if len(a) > len(b):
        return gallop(b, a)[::-1]
    in_a, in_b, low, n = [], [], 0, len(b)
    for i, end in enumerate(a):
        if low == n:
            break
        if b[low] < end:
            step, high = 1, low + 1
            while high < n and b[high] < end:
                low, high = high, high + step
                step *= 2
            low = bisect_left(b, end, low + 1, min(high, n))
            if low == n:
                break
        if b[low] == end:
            in_a.append(i)
            in_b.append(low)
            low += 1
    return in_a, in_b


class Aligned(NamedTuple):
    """Tokens of a stretch of text by both tokenizers, and how they meet."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    pairs: bytes  # a << 32 | b in 64 bits each


_NONE = Aligned(0, 0, 0, "", b"")
#: not a result: words without alignments have None
_UNKNOWN = object()


class Pair:
    """The two tokenizers."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(a_path)
        self._a.no_padding()
        self._a.no_truncation()
        self._a.encode_special_tokens = True
        letters = byte_letters()
        self._a_bytes = {i: token_bytes(t, letters) for t, i in self._a.get_vocab(with_added_tokens=True).items()}
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self._b_bytes = [
            bytes((int(p[1:-1], 16),)) if self._b.is_byte(i) else utf8(p.replace(SPACE, " ")) for i, p in enumerate(pieces)
        ]
        #: whether words can be tokenised one by one
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self._memo: dict[str, Aligned | None] = {}
        self._old: dict[str, Aligned | None] = {}
        self._a_sizes = np.zeros(max(self._a_bytes) + 1, np.int64)
        self._a_sizes[list(self._a_bytes)] = [len(b) for b in self._a_bytes.values()]
        self._b_sizes = np.array([len(b) for b in self._b_bytes], np.int64)
        known = range(max(len(self._a_sizes), len(self._b_sizes)))
        self._names = np.array([[f"{i},", f"{i}|", f"{i};"] for i in known], object)

    def _align(self, texts: list[str]) -> list[Aligned | None]:
        """Alignments of texts with a space before each; None where the bytes differ."""
        found = []
        for text, b in zip(texts, self._b.encode(texts, num_threads=1)):
            a = self._a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
            found += self._stretches(a, b, utf8(" " + text), [len(utf8(" " + text))]) or [None]
        return found

    def _stretches(self, a: list[int], b: list[int], raw: bytes, ends: list[int]) -> list[Aligned] | None:
        """Alignments of stretches of ``raw`` with the given ends, at which tokens of both
        end, from the tokens of the whole; None where the bytes differ."""
        if b"".join(map(self._a_bytes.__getitem__, a)) != raw or b"".join(map(self._b_bytes.__getitem__, b)) != raw:
            return None
        by_a, by_b = np.array(a, np.int64), np.array(b, np.int64)
        a_ends, b_ends = np.cumsum(self._a_sizes[by_a]), np.cumsum(self._b_sizes[by_b])
        # ranks of the common ends among the tokens of both, and of the stretches among them
        last_a, last_b = (np.array(x, np.int64) for x in gallop(a_ends.tolist(), b_ends.tolist()))
        stretch = np.searchsorted(a_ends[last_a], ends, "right")
        # tokens in the order of groups, those of A first, each with the sign that follows it
        group = np.concatenate([np.searchsorted(last_a, np.arange(len(a))), np.searchsorted(last_b, np.arange(len(b)))])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((side, group))
        sign = np.zeros(len(order), np.int64)
        sign[last_a], sign[len(a) + last_b] = 1, 2
        names = self._names[np.concatenate([by_a, by_b])[order], sign[order]].tolist()
        tokens = np.cumsum(np.diff(last_a, prepend=-1) + np.diff(last_b, prepend=-1))
        at = [0, *np.append(0, tokens)[stretch].tolist()]
        pairs = (by_a[last_a] << 32 | by_b[last_b]).tobytes()
        met = [0, *stretch.tolist()]
        n_a = np.diff(np.append(-1, last_a)[np.array(met)]).tolist()
        n_b = np.diff(np.append(-1, last_b)[np.array(met)]).tolist()
        return [
            Aligned(n_a[k], n_b[k], j - i, "".join(names[at[k] : at[k + 1]])[:-1], pairs[8 * i : 8 * j])
            for k, (i, j) in enumerate(zip(met, met[1:]))
        ]

    def whole(self, text: str) -> Aligned:
        return self._align([text])[0] or _NONE if text else _NONE

    def _made(self, words: list[str]) -> dict[str, Aligned | None]:
        """Alignments of new words: those that cannot run into each other in one stroke."""
        plain = [w for w in words if w and " " not in w and not w[0].isspace() and SPACE not in w]
        made: dict[str, Aligned | None] = {}
        if plain:
            text = " ".join(plain)
            raw = utf8(" " + text)
            ends = np.cumsum([1 + len(utf8(w)) for w in plain]).tolist()
            a = self._a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
            found = self._stretches(a, self._b.encode(text, num_threads=1), raw, ends)
            if found:
                made = dict(zip(plain, found))
        rest = [w for w in words if w not in made]
        made.update(zip(rest, self._align(rest)))
        return made

    def words(self, words: list[str]) -> list[Aligned | None]:
        """Alignments of words, each looked up or made once."""
        memo, old = self._memo, self._old
        found = list(map(memo.get, words, repeat(_UNKNOWN)))
        missed = [i for i, m in enumerate(found) if m is _UNKNOWN]
        made = self._made([words[i] for i in missed if words[i] not in old])
        if len(memo) > MEMO:
            self._old, self._memo = memo, {}
        for i in missed:
            word = words[i]
            found[i] = old[word] if word in old else made[word]
            if len(word) <= MEMO_LENGTH:
                self._memo[word] = found[i]
        return found


@lru_cache(maxsize=1)
def _pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def pair(a_path: str, b_path: str) -> Pair:
    claim("align", _pair.cache_clear)
    return _pair(a_path, b_path)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values))
    return total[ends] - total[np.append(0, ends[:-1]).astype(np.int64)]


def _counted(cells: np.ndarray, n_cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Different ones of some numbers below ``n_cells`` in order, and how often they occur."""
    if n_cells > 4 * len(cells):
        return np.unique(cells, return_counts=True)
    counts = np.bincount(cells, minlength=n_cells)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(keys) else counts


class _Batch:
    """The documents of one step: columns, and the pairs of each document."""

    def __init__(self, tokenizers: Pair, texts: list[str], hashed: bool):
        self.texts, self._hashed = texts, hashed
        cut = cut_words(texts)
        found = tokenizers.words(cut.words) if tokenizers.by_word else [None] * len(cut.words)
        whole = np.array([m is None for m in found], bool)[cut.codes]
        empty = np.array([not t for t in texts], bool)
        apart = np.flatnonzero((_sums(whole, cut.ends) > 0) & ~empty)
        known = [m or _NONE for m in found]
        *sizes, groups, pairs = zip(*known) if known else ((),) * 5
        self.n_a, self.n_b, self.n_groups = (_sums(np.array(x, np.int64)[cut.codes], cut.ends) for x in sizes)
        codes = cut.codes.tolist()
        self.groups = [
            self._digest(";".join(map(groups.__getitem__, codes[a:b]))) for a, b in zip(cut.starts.tolist(), cut.ends.tolist())
        ]
        rows = np.repeat(np.arange(len(texts)), np.diff(np.append(0, cut.ends)))
        skipped = empty.copy()
        skipped[apart] = True
        live = ~skipped[rows]
        # the pairs of every different word, as numbers of different pairs
        n_pairs = np.array(sizes[2], np.int64)  # no two tokens of one side end together
        keys, number = np.unique(np.frombuffer(b"".join(pairs), np.int64), return_inverse=True)
        codes = cut.codes[live]
        met = gather(number.astype(np.int32), np.cumsum(n_pairs), codes)
        cells = np.repeat(rows[live], n_pairs[codes]) * len(keys) + met
        found, self.counts = _counted(cells, len(texts) * len(keys))
        of_row, pair = np.divmod(found, max(len(keys), 1))
        self.pairs = keys[pair]
        self.ends = np.cumsum(np.bincount(of_row, minlength=len(texts)))
        for i in np.flatnonzero(skipped):
            self._put(int(i), tokenizers.whole(texts[i]))

    def _digest(self, groups: str) -> str:
        return hashlib.sha256(groups.encode()).hexdigest() if groups and self._hashed else groups

    def _put(self, i: int, found: Aligned) -> None:
        self.n_a[i], self.n_b[i], self.n_groups[i] = found[:3]
        self.groups[i] = self._digest(found.groups)
        at = int(self.ends[i])
        own, times = np.unique(np.frombuffer(found.pairs, np.int64), return_counts=True)
        self.pairs, self.counts = np.insert(self.pairs, at, own), np.insert(self.counts, at, times)
        self.ends[i:] += len(own)

    def record(self, first_row: int, doc_ids: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
        offsets = pa.array(np.append(0, self.ends), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (self.pairs, self.counts)]
        links = _sums(self.counts, self.ends)
        plain = [first_row + np.arange(len(self.texts)), doc_ids, self.n_a, self.n_b, self.n_groups, links, self.groups]
        arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(plain, schema)]
        return pa.RecordBatch.from_arrays([*arrays, *(a.cast(f.type) for a, f in zip(lists, list(schema)[7:]))], schema=schema)


def _count_rows(keys: np.ndarray, counts: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(keys), CHUNK):
        lists = [keys[at : at + CHUNK].tolist(), counts[at : at + CHUNK].tolist()]
        yield pa.RecordBatch.from_arrays(
            [*(pa.nulls(1, f.type) for f in list(schema)[:7]), *(pa.array([x], f.type) for x, f in zip(lists, list(schema)[7:]))],
            schema=schema,
        )


def link(docs: DataFrame, a_path: str, b_path: str, hashed: bool = False) -> DataFrame:
    """Tokens of ``docs`` aligned: one row per document with its groups as text
    ``a1,a2|b1;a3|b2,b3`` (or, ``hashed``, the SHA-256 of that), and its linked pairs
    ``a << 32 | b`` with their number. Rows without ``row`` hold counts of pairs over the
    documents of a task."""
    arrow = to_arrow_schema(_LINKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, row = pair(a_path, b_path), TaskContext.get().partitionId() << 40
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in steps(batches, STEP):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            if not texts:
                continue
            found = _Batch(tokenizers, texts, hashed)
            yield found.record(row, batch.column(0), arrow)
            row += len(texts)
            keys, counts = _summed(np.concatenate([keys, found.pairs]), np.concatenate([counts, found.counts]))
            if len(keys) > HELD:
                yield from _count_rows(keys, counts, arrow)
                keys, counts = keys[:0], counts[:0]
        yield from _count_rows(keys, counts, arrow)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _LINKED)


def _entries(linked: DataFrame, *columns: str) -> DataFrame:
    zipped = F.explode(F.arrays_zip("pairs", "counts")).alias("e")
    return linked.select(*columns, zipped).select(*columns, F.col("e.pairs").alias("pair"), F.col("e.counts").alias("n"))


def pair_counts(linked: DataFrame) -> DataFrame:
    """``pair``, ``total`` (links of the pair over all documents) and ``best`` (whether no
    other pair of its B id has more)."""
    total = (
        _entries(linked.filter(F.col("row").isNull()))
        .groupBy("pair")
        .agg(F.sum("n").alias("total"))
    )
    total = materialize(total.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))), "pairs")
    most = total.groupBy("b").agg(F.max("total").alias("most"))
    return total.join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, hashed: bool = False, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups, and of its links n_best
    (those that are the most frequent of their B id) and count_sum (sum of the counts)."""
    linked = materialize(link(docs, a_path, b_path, hashed), "linked")
    counts = materialize(pair_counts(linked), "counts")
    docs_of = linked.filter(F.col("row").isNotNull())
    met = dimension_join(_entries(docs_of, "row"), counts, ["pair"], "inner", ["row"], broadcast_rows)
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum")
    )
    return (
        docs_of.drop("pairs", "counts")
        .join(sums, "row", "left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_best", "count_sum")})
        .drop("row")
    )
