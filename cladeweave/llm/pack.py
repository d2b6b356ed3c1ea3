"""Best-fit packing of token pieces under several capacities.

A document's ids are cut into pieces of at most ``tokens`` ids, the first one taking
what is over. Sequences (bins) have three capacities: tokens, pieces, and attention
cost, the sum of squared piece lengths. A piece needs the vector (length, 1,
length squared), which depends on its length only. So it suffices to pack the counts of
lengths, at most ``tokens`` of them however many documents there are: lengths go from
long to short, and each piece goes to the open sequence that fits best under every
capacity, by the smallest weighted norm of what remains or by the largest weighted dot
product with what it has left. Sequences with equal residuals are handled together.

The plan is a list of ranges: pieces of a length, by rank, to sequences and an offset.
The ranks are made on Spark: pieces are numbered within (length, bucket of the
document), which spreads a length that many pieces share, and the buckets' counts are
summed up. Every task then places its pieces by binary search in the plan.

Nulls and odd cases: a null text is empty and has the end id only; rows without doc_id
and repeated rows are packed like any other; an empty table gives no pieces; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..runtime import materialize
from .common import map_batches
from .encoder import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


@dataclass(frozen=True)
class Capacity:
    tokens: int = 1024
    pieces: int = 1024
    cost: int = 1024 * 1024
    #: of tokens, pieces and cost in the choice of a sequence
    weights: tuple[float, float, float] = (1.0, 1e-4, 1e-4)
    #: residual (smallest norm left) or dot (largest product)
    rule: str = "residual"


@dataclass(frozen=True)
class Plan:
    """Range i takes pieces of ``length[i]`` with ranks from ``rank[i]`` on."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.rank, self.length))
        key = np.stack([self.length[order], self.rank[order]], 1)
        packed = np.ascontiguousarray(key.astype(">u8")).view("S16").ravel()
        wanted = np.ascontiguousarray(np.stack([length, rank], 1).astype(">u8")).view("S16").ravel()
        at = order[_at_or_before(packed, wanted)]
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


def _at_or_before(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return np.searchsorted(known, wanted, side="right") - 1


class _Open:
    """Open sequences grouped by what they have left."""

    def __init__(self, capacity: Capacity):
        self._scale = np.array([capacity.tokens, capacity.pieces, capacity.cost], float)
        self._weights, self._rule = np.array(capacity.weights), capacity.rule
        self._left = np.zeros((1024, 3))
        self._free = list(range(1023, -1, -1))
        self._at: dict[tuple, int] = {}
        self.members: dict[int, list[list[int]]] = {}

    def add(self, left: tuple[int, int, int], first: int, count: int) -> None:
        if left[0] <= 0 or left[1] <= 0 or left[2] <= 0:
            return
        if left not in self._at:
            if not self._free:
                self._free = list(range(2 * len(self._left) - 1, len(self._left) - 1, -1))
                self._left = np.vstack([self._left, np.zeros_like(self._left)])
            self._at[left] = i = self._free.pop()
            self._left[i] = left
            self.members[i] = []
        self.members[self._at[left]].append([first, count])

    def best(self, need: np.ndarray) -> tuple[int, tuple[int, int, int]] | None:
        fits = np.flatnonzero((self._left >= need).all(1))
        if not len(fits):
            return None
        left = self._left[fits]
        if self._rule == "dot":
            score = -((left / self._scale) * (need / self._scale) * self._weights).sum(1)
        else:
            score = ((((left - need) / self._scale) ** 2) * self._weights).sum(1)
        i = int(fits[np.argmin(score)])
        return i, tuple(map(int, self._left[i]))

    def take(self, i: int, left: tuple, bins: int) -> list[list[int]]:
        """Up to ``bins`` sequences of group ``i`` as ranges; the group goes when empty."""
        taken, members = [], self.members[i]
        while bins and members:
            first, count = members.pop()
            n = min(count, bins)
            taken.append([first, n])
            bins -= n
            if count > n:
                members.append([first + n, count - n])
        if not members:
            del self.members[i], self._at[left]
            self._left[i] = 0
            self._free.append(i)
        return taken


def plan(counts: dict[int, int], capacity: Capacity = Capacity()) -> Plan:
    """Where to put ``counts[length]`` pieces of every length."""
    if capacity.rule not in ("residual", "dot"):
        raise ValueError(f"unknown rule {capacity.rule}")
    whole = (capacity.tokens, capacity.pieces, capacity.cost)
    open_, rows, sequences = _Open(capacity), [], 0
    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, length * length], float)
        if length < 1 or (need > whole).any():
            raise ValueError(f"a piece of {length} tokens does not fit a sequence")
        remaining, rank = counts[length], 0

        def put(first: int, bins: int, left: tuple, each: int) -> None:
            nonlocal rank
            for k in range(each):
                rows.append((length, rank, first, capacity.tokens - left[0] + k * length))
                rank += bins
            rest = (left[0] - each * length, left[1] - each, left[2] - each * length * length)
            open_.add(rest, first, bins)

        while remaining:
            found = open_.best(need)
            left = found[1] if found else whole
            each = min(left[0] // length, left[1], left[2] // (length * length), remaining)
            bins = remaining // each
            if found:
                taken = open_.take(found[0], left, bins)
            else:
                taken = [[sequences, bins]]
                sequences += bins
            for first, n in taken:
                put(first, n, left, each)
                remaining -= n * each
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return Plan(*columns, sequences)


def cut(docs: DataFrame, tokenizer: str, tokens: int) -> DataFrame:
    """Pieces of all documents with the crc32 of their ids."""

    def batch(rows: dict[str, list]) -> dict[str, list]:
        e, out = encoder(tokenizer), []
        for doc_id, ids in zip(rows["doc_id"], e.documents(rows["text"])):
            ids = ids.astype("<u4")
            edges = [0, *range((len(ids) - 1) % tokens + 1, len(ids) + 1, tokens)]
            for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                out.append((doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return dict(zip(names, map(list, zip(*out)))) if out else {n: [] for n in names}

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), batch, PIECES)


def ranked(pieces: DataFrame, buckets: int) -> DataFrame:
    """``pieces`` with ``rank``, a number from 0 on among those of the same length.

    ``salt`` is a stored number that differs between equal rows, which it spreads.
    """
    spread = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "salt"), F.lit(buckets)).cast("int"))
    counts = spread.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32", "salt")
    return (
        spread.withColumn("_n", F.row_number().over(within) - 1)
        .join(first, ["length", "_bucket"])
        .withColumn("rank", F.col("_first") + F.col("_n"))
        .drop("_first", "_n", "_bucket")
    )


def pack(docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity()) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset`` there."""
    spark = docs.sparkSession
    pieces = cut(docs, tokenizer, capacity.tokens).withColumn("salt", F.monotonically_increasing_id())
    pieces = materialize(pieces, "pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most one row a length
    made = spark.sparkContext.broadcast(plan(counts, capacity))

    def batch(rows: dict[str, list]) -> dict[str, list]:
        rank = np.array(rows.pop("rank"), np.int64)
        sequence, offset = made.value.place(np.array(rows["length"], np.int64), rank)
        return rows | {"sequence_id": sequence, "offset": offset}

    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"]
    return map_batches(ranked(pieces, buckets).select(*names), batch, PLACED)
