"""Token ids in segments with Elias-Fano coded document boundaries.

A segment holds consecutive documents: the concatenated ids in 16 or 32 bits each, and
two Elias-Fano sequences, the ends of the documents within the segment and their
doc_ids. An Elias-Fano sequence of n rising numbers below u takes about
2 + log2(u / n) bits a number: low bits side by side, high bits in unary, and a
directory with the place of every 64th one, from which ``select`` finds any number.
There is no table of 64-bit offsets.

Documents are range-partitioned and sorted by doc_id; each task writes its segments as
rows (part, segment, payload) of a table, so a lost task is written again as a whole by
Spark's committer. Offsets count from the start of the part; one sum per part makes
them global.

Nulls and odd cases: null doc_ids come first and are counted in the header; equal
doc_ids stand in the order of their texts' hashes; a null text is empty and has the end
id only; a document longer than a segment gets one of its own; an empty table gives an
empty file; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import fields, record, steps
from .encoder import encoder

SEGMENT_TOKENS = 1 << 20
SELECT_STEP = 64
MAGIC = b"TEF1"
_HEAD = struct.Struct("<4sBQQQ")  # magic, bytes an id, documents, null doc_ids, ids

SEGMENT_SCHEMA = fields(
    "part int, segment int, first long, n_docs long, n_tokens long, payload binary"
)
READ_SCHEMA = fields("doc_id long, start long, n_tokens long, ids binary")
_EF_HEAD = struct.Struct("<QqBI")  # numbers, least number, low bits, bytes of high bits


class EliasFano:
    """A non-decreasing sequence of integers; ``select`` gives any of them."""

    def __init__(self, n: int, base: int, low_bits: int, low: bytes, high: bytes, directory: np.ndarray):
        self.n, self.base, self.low_bits = n, base, low_bits
        self._low, self._high, self._directory = low, high, directory
        self._bits = np.frombuffer(high, np.uint8)

    @staticmethod
    def encode(numbers) -> "EliasFano":
        numbers = list(map(int, numbers))
        if not numbers:
            return EliasFano(0, 0, 0, b"", b"", np.zeros(0, "<u4"))
        base, n = numbers[0], len(numbers)
        x = np.array([v - base for v in numbers], np.uint64)
        low_bits = max(0, (int(x[-1]) // n).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((x[:, None] >> shifts) & np.uint64(1)).astype(np.uint8), bitorder="little")
        places = (x >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1, np.uint8)
        high[places] = 1
        directory = places[::SELECT_STEP].astype("<u4")
        return EliasFano(n, base, low_bits, low.tobytes(), np.packbits(high, bitorder="little").tobytes(), directory)

    def to_bytes(self) -> bytes:
        head = _EF_HEAD.pack(self.n, self.base, self.low_bits, len(self._high))
        return head + self._low + self._high + self._directory.tobytes()

    @staticmethod
    def from_bytes(data: bytes, at: int) -> tuple["EliasFano", int]:
        n, base, low_bits, n_high = _EF_HEAD.unpack_from(data, at)
        at += _EF_HEAD.size
        n_low = (n * low_bits + 7) // 8
        low, high = data[at : at + n_low], data[at + n_low : at + n_low + n_high]
        at += n_low + n_high
        n_directory = -(-n // SELECT_STEP)
        directory = np.frombuffer(data, "<u4", n_directory, at)
        return EliasFano(n, base, low_bits, low, high, directory), at + 4 * n_directory

    def _place(self, i: int) -> int:
        """Bit of the ``i``-th one of the high bits."""
        at, skip = int(self._directory[i // SELECT_STEP]), i % SELECT_STEP
        byte, width = at // 8, 32
        while True:  # a longer stretch of zeros only makes the read longer
            ones = np.flatnonzero(np.unpackbits(self._bits[byte : byte + width], bitorder="little")[at % 8 :])
            if len(ones) > skip:
                return at + int(ones[skip])
            width *= 4

    def numbers(self) -> np.ndarray:
        """All of them at once, in 64 bits that wrap around as those of the ids do."""
        places = np.flatnonzero(np.unpackbits(self._bits, bitorder="little"))[: self.n]
        bits = np.unpackbits(np.frombuffer(self._low, np.uint8), count=self.n * self.low_bits, bitorder="little")
        low = np.zeros(self.n, np.uint64)
        for shift in range(self.low_bits):
            low |= bits[shift :: self.low_bits].astype(np.uint64) << np.uint64(shift)
        high = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        return ((high | low) + np.array(self.base, np.int64).view(np.uint64)).view(np.int64)

    def select(self, i: int) -> int:
        high = self._place(i) - i
        first = i * self.low_bits
        chunk = int.from_bytes(self._low[first // 8 : (first + self.low_bits + 7) // 8], "little")
        low = chunk >> first % 8 & (1 << self.low_bits) - 1
        return self.base + (high << self.low_bits | low)


def pack_segment(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    dtype = ids[0].dtype
    known = [d for d in doc_ids if d is not None]
    ends = EliasFano.encode(np.cumsum([len(x) for x in ids]))
    return b"".join(
        [
            _HEAD.pack(MAGIC, dtype.itemsize, len(ids), len(ids) - len(known), sum(map(len, ids))),
            ends.to_bytes(),
            EliasFano.encode(known).to_bytes(),
            *(x.tobytes() for x in ids),
        ]
    )


class Segment:
    """Random access to the documents of a segment."""

    def __init__(self, data: bytes):
        magic, width, self.n_docs, self._nulls, self.n_tokens = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self._ends, at = EliasFano.from_bytes(data, _HEAD.size)
        self._doc_ids, at = EliasFano.from_bytes(data, at)
        self._ids = np.frombuffer(data, f"<u{width}", self.n_tokens, at)

    def doc_id(self, i: int) -> int | None:
        return None if i < self._nulls else self._doc_ids.select(i - self._nulls)

    def bounds(self, i: int) -> tuple[int, int]:
        return (self._ends.select(i - 1) if i else 0), self._ends.select(i)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """The doc_ids of all documents, and the bounds of their ids."""
        return [None] * self._nulls + self._doc_ids.numbers().tolist(), np.append(0, self._ends.numbers())

    def ids(self, i: int) -> np.ndarray:
        return self.between(*self.bounds(i))

    def between(self, a: int, b: int) -> np.ndarray:
        return self._ids[a:b]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode ``docs`` and write them below ``path`` in ascending doc_id order."""
    arrow = to_arrow_schema(SEGMENT_SCHEMA)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, first = TaskContext.get().partitionId(), 0, 0
        e, doc_ids, ids, size = encoder(tokenizer), [], [], 0

        def full():
            row = [[part], [number], [first], [len(ids)], [size], [pack_segment(doc_ids, ids)]]
            return record(row, arrow)

        for batch in steps(batches):
            for doc_id, doc in zip(batch.column(0), e.documents(batch.column(1).to_pylist())):
                if ids and size + len(doc) > segment_tokens:
                    yield full()
                    number, first, doc_ids, ids, size = number + 1, first + size, [], [], 0
                doc_ids.append(doc_id.as_py())
                ids.append(doc)
                size += len(doc)
        if ids:
            yield full()

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = picked.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(segments, SEGMENT_SCHEMA).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``start``, the number of ids in all segments before."""
    found = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    sums = found.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # one row a task
    before, rows = 0, []
    for part, n in sums:
        rows.append((part, before))
        before += n
    starts = spark.createDataFrame(rows, "part int, before long")
    return found.join(F.broadcast(starts), "part").withColumn("start", F.col("before") + F.col("first")).drop("before")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a token file: doc_id, start, n_tokens, ids (as stored)."""
    arrow = to_arrow_schema(READ_SCHEMA)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch.column(0), batch.column(1)):
                segment, start = Segment(payload.as_py()), start.as_py()
                doc_ids, bounds = segment.documents()
                columns = [
                    doc_ids,
                    start + bounds[:-1],
                    np.diff(bounds),
                    [segment.between(a, b).astype("<u4").tobytes() for a, b in pairwise(bounds.tolist())],
                ]
                yield record(columns, arrow)

    return read_segments(spark, path).select("start", "payload").mapInArrow(documents, READ_SCHEMA)

