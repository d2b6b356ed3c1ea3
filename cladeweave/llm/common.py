"""What the operators share: reading a table, mapping record batches, packed columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: bytes of text that one step of a batch function sees; a longer text is a step of its own
STEP_BYTES = 2 << 20


_TYPES = {"int": T.IntegerType, "long": T.LongType, "double": T.DoubleType, "binary": T.BinaryType}


def fields(text: str) -> T.StructType:
    """Schema of plain columns, ``name type, ...``, made without a session."""
    pairs = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]()) for name, kind in pairs])


def record(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_holder: list = [None, None]


def claim(owner: str, forget: Callable[[], None]) -> None:
    """Let one operator at a time keep memos in a worker: those of the one before go, and
    their memory goes back to the system."""
    if _holder[0] != owner:
        if _holder[1]:
            _holder[1]()
            for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
                pool.release_unused()
        _holder[:] = [owner, forget]


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def steps(batches: Iterator[pa.RecordBatch], size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """``batches`` in slices of about ``size`` bytes."""
    for batch in batches:
        rows = max(1, min(batch.num_rows, batch.num_rows * size // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(
    df: DataFrame,
    fn: Callable[[dict[str, list]], dict[str, list]],
    schema: T.StructType | str,
) -> DataFrame:
    """``df`` through ``fn``, which turns columns of lists into columns of lists.

    Batches are cut to about ``STEP_BYTES``, so memory does not depend on how many
    long texts stand side by side.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            yield pa.RecordBatch.from_pydict(fn(batch.to_pydict()), schema=arrow)

    return df.mapInArrow(run, schema)


def keep_texts(docs: DataFrame, decide: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """The rows of ``docs`` whose texts ``decide`` keeps, step by step, with all their
    columns, whatever their names."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            yield batch.filter(pa.array(decide(batch.column(at).to_pylist()), pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def identity() -> tuple[Column, Column]:
    """``_id`` and ``_hash``, which tell documents apart: no nulls, and the same for rows
    that repeat a doc_id and its text."""
    return (
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.xxhash64(F.col("text").cast("string"), F.col("doc_id").isNull()).alias("_hash"),
    )


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until ``df`` has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    longer = "_" * max((len(c) for c in taken if any(c.endswith(n.lower()) for n in names)), default=0)
    return [longer + n for n in names]


def same_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` out of ``df``, whatever their names."""
    return df.select(*(F.col("`" + c.replace("`", "``") + "`") for c in like.columns))
