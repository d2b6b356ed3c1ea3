"""Dense running ids in a given order, and uniqueness of origin keys."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import materialize

# monotonically_increasing_id() is documented as partition number in the upper
# 31 bits and row number within the partition in the lower 33 bits.
_ROW_BITS = 33


def ordered_ids(df: DataFrame, order: list[str], start: int = 1, column: str = "id") -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in ascending ``order``.

    ``order`` should be unique, nulls sort first. The rows are range partitioned
    and sorted once, and that layout is stored before it is counted, so the counts
    and the numbers come from the same layout. The driver sees one count per
    partition.
    """
    spark = df.sparkSession
    asc = [F.col(c).asc_nulls_first() for c in order]
    laid_out = materialize(
        df.repartitionByRange(*asc).sortWithinPartitions(*asc).withColumn("_pos", F.monotonically_increasing_id()),
        "ordered",
    )
    part = F.shiftright("_pos", _ROW_BITS).cast("int")
    counts = sorted(
        tuple(r) for r in laid_out.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()
    )
    first = [start, *accumulate((n for _, n in counts), initial=start)][1:]
    offsets = spark.createDataFrame(
        [(p, f) for (p, _), f in zip(counts, first)],
        T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_first", T.LongType())]),
    )
    local = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        laid_out.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_first") + local).alias(column), *df.columns)
    )


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once; as in SQL, null keys never repeat."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the lowest row of every key; rows with a null in the key all stay."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rest = [c for c in df.columns if c not in keys]
    kept = (
        df.filter(known)
        .groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("_rest"))
        .select(*[F.col(c) if c in keys else F.col(f"_rest.{c}").alias(c) for c in df.columns])
    )
    return kept.unionByName(df.filter(~known))
