"""Equi joins that stay balanced when a few keys hold most of the rows.

A tree puts its rows under few parents and a name may have very many copies, so the large
side of a join can carry a third of all rows under one key. What counts is rows per task: a
key is hot when it has more than a sixteenth of the rows that a task may get. Hot keys are
found by mergeable heavy-hitter sketches, one per partition, combined in a tree; no key is
shuffled or collected. The sketches work on hashes of keys, and give a stored table of
(hash, salts): fewer than 16 * rows / bound of them, ``MOST_ROWS`` at the very most, which is
why it may be broadcast. The rows of a hot key on the large side are spread over its salts,
its rows on the other side are repeated once per salt, and the join gets as many partitions
as the bound asks for. Two keys of one hash only share their salts.

Keys under a collation have to be given in canonical spelling (:mod:`.spelling`), as hashes
compare bytes; otherwise the join is left to Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import BINARY, materialize, shuffled

_SALT = "_salt"
_SALTS = "_salts"
_HASH = "_key_hash"
ROW = "_row"

#: counters of a sketch at most, the function's own limit; keys that a sketch surely finds
#: have more than 7 / (4 / 3 * counters) of its rows
_MOST_COUNTERS, _COUNTERS_PER_SHARE = 1_000_000, 6
#: a key is hot from this part of the row bound on
_PART = 16
#: so many times the row bound can be guaranteed; with more rows the bound rises
MOST_ROWS = _MOST_COUNTERS // (_COUNTERS_PER_SHARE * _PART)


@dataclass(frozen=True)
class SkewSettings:
    #: rows of the large side that a task should get at most
    rows: int = 2_000_000

    @staticmethod
    def of(spark: SparkSession) -> "SkewSettings":
        return SkewSettings(int(spark.conf.get("spark.cladeweave.skew.rows", "2000000")))

    def bound(self, total: int) -> int:
        return max(self.rows, -(-total // MOST_ROWS))


_row_bound: ContextVar[int | None] = ContextVar("row_bound", default=None)


@contextmanager
def at_most(rows: int) -> Iterator[None]:
    """Within this block the left side of every join has at most ``rows`` rows.

    Keys are then only counted when that many rows could hold a hot one.
    """
    token = _row_bound.set(rows)
    try:
        yield
    finally:
        _row_bound.reset(token)


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _large(df: DataFrame, settings: SkewSettings) -> int | None:
    """Row count of ``df``, or None when one task could take it all."""
    known = _row_bound.get()
    if known is not None and known <= settings.rows:
        return None
    total = df.count()
    return None if total <= settings.rows else total


def _hash_of(keys: list[str]) -> Column:
    """Hash of a key, null where a part of it is null."""
    return F.when(~_any_null(keys), F.xxhash64(*keys))


def _comparable(df: DataFrame, keys: list[str]) -> bool:
    """Whether equal keys have equal bytes."""
    return all(getattr(df.schema[k].dataType, "collation", BINARY) == BINARY for k in keys)


def hot_keys(df: DataFrame, keys: list[str], total: int, settings: SkewSettings) -> DataFrame | None:
    """Stored table of the hashes of hot keys among the ``total`` rows of ``df`` with their
    numbers of salts, or None if there are none.

    Every key with more than a sixteenth of the row bound is in it. The sketches of the
    partitions are combined by groups first and then once more.
    """
    bound = settings.bound(total)
    counters = min(_MOST_COUNTERS, _COUNTERS_PER_SHARE * _PART * -(-total // bound))
    hashed = df.select(_hash_of(keys).alias(_HASH)).filter(F.col(_HASH).isNotNull())
    groups = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sketch = lambda text: F.expr(text).alias("sketch")
    by_group = hashed.groupBy(F.pmod(F.spark_partition_id(), F.lit(groups)).alias("_group")).agg(
        sketch(f"approx_top_k_accumulate({_HASH}, {counters})")
    )
    # grouped, as the function fails on partitions without a sketch, which groups leave out
    combined = by_group.groupBy((F.col("_group") < 0).alias("_all")).agg(sketch("approx_top_k_combine(sketch)"))
    found = combined.select(
        F.explode(F.expr(f"approx_top_k_estimate(sketch, {counters})")).alias("e")
    )
    salts = F.ceil(F.col("e.count") * _PART / F.lit(bound)).cast("int")
    hot = materialize(found.select(F.col("e.item").alias(_HASH), salts.alias(_SALTS)).filter(F.col(_SALTS) > 1), "hot-keys")
    return None if hot.limit(1).count() == 0 else hot


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with ``ROW``, which tells equal rows apart so that they can be spread.

    The numbers are the same when a task is repeated as long as ``df`` is read from
    tables without a shuffle in between.
    """
    return df.withColumn(ROW, F.monotonically_increasing_id())


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str,
    spread: list[str],
    hot_in: DataFrame | None = None,
    null_heavy: bool = False,
    settings: SkewSettings | None = None,
) -> DataFrame:
    """Join on equally named ``keys``; ``left`` may be skewed, ``right`` is not.

    ``how`` is inner, left, left_semi or left_anti. ``spread`` names columns of
    ``left`` that tell the rows of one key apart: salts are a function of them, so
    a task that runs twice sends every row the same way. Neither side is broadcast.

    Keys are counted in ``left``, which should be cheap to read; otherwise give a
    stored table as ``hot_in`` that has the keys and at least the same rows. If
    ``left`` then has many null keys of its own, ``null_heavy`` spreads them.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    settings = settings or SkewSettings.of(left.sparkSession)
    counted = (left if hot_in is None else hot_in).select(*keys)
    total = _large(counted, settings) if _comparable(left, keys) else None
    hot = None if total is None else hot_keys(counted, keys, total, settings)
    if hot is None and (total is None or not null_heavy):
        return left.join(shuffled(right), keys, how)
    parts = -(-3 * total // settings.bound(total))
    hashed = F.xxhash64(*spread)
    own_salt = F.lit(0)
    if hot is not None:  # fewer than MOST_ROWS * _PART rows of 12 bytes
        hot, salts = F.broadcast(hot), F.coalesce(F.col(_SALTS), F.lit(1))
        left = left.withColumn(_HASH, _hash_of(keys)).join(hot, _HASH, "left").drop(_HASH)
        own_salt = F.pmod(hashed, salts.cast("long"))
        right = right.withColumn(_HASH, _hash_of(keys)).join(hot, _HASH, "left").drop(_HASH)
        right = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1)))
    else:
        right = right.withColumn(_SALT, F.lit(0))
    # null keys meet nothing and are spread over all partitions
    salt = F.when(_any_null(keys), F.pmod(hashed, F.lit(4 * parts))).otherwise(own_salt)
    left = left.withColumn(_SALT, salt.cast("int")).drop(_SALTS)
    right = right.drop(_SALTS)
    if parts > int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        left, right = (df.repartition(parts, *keys, _SALT) for df in (left, right))
    return left.join(shuffled(right), [*keys, _SALT], how).drop(_SALT)


def balanced_outer(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """Left outer join in which ``right`` may be skewed and ``left`` is not.

    An outer join cannot split its right side, so with hot keys it is done as an
    inner join from the right and the rows of ``left`` that meet nothing.
    """
    settings = SkewSettings.of(left.sparkSession)
    counted = right.select(*keys)
    total = _large(counted, settings) if _comparable(right, keys) else None
    if total is None or hot_keys(counted, keys, total, settings) is None:
        return left.join(shuffled(right), keys, "left")
    met = balanced_join(right, left, keys, "inner", spread)
    unmet = left.join(shuffled(counted.distinct()), keys, "left_anti")
    return met.unionByName(unmet, allowMissingColumns=True)


def dimension_join(
    left: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str,
    spread: list[str],
    limit: int = 100_000,
) -> DataFrame:
    """Join a table that should be a small dimension.

    It is broadcast when it has at most ``limit`` rows, which is counted first;
    a larger one goes through :func:`balanced_join`.
    """
    if dim.limit(limit + 1).count() <= limit:
        return left.join(F.broadcast(dim), keys, how)
    return balanced_join(left, dim, keys, how, spread)
