"""Sharding by a permutation-filled lookup table.

Every shard has a permutation of the slots of a table of prime size: it starts at an
offset and goes on by a step, both hashes of its name. The shards take turns, each
claiming the next slot of its permutation that is still free, until all are taken.
Slots are shared out evenly (the counts differ by one at most), and when a shard
comes or goes few slots change hands. A row is placed by the slot of its key's hash.

The filled table has ``size`` rows, a parameter, so its broadcast is bounded. Placing
is a projection and a broadcast join: no shuffle, whatever the keys are.

Nulls and odd cases: a null key is placed as the empty text; equal keys share a shard;
empty tables give empty results; the columns ``slot`` and ``shard`` are replaced where
the input has them, other columns stay.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: about a hundred slots a shard keep the shares within one per cent
SHARDS, SIZE = 64, 6421


def shard_names(n: int) -> list[str]:
    return [f"shard-{i}" for i in range(n)]


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(names: list[str], size: int = SIZE) -> list[int]:
    """Shard index of every slot. ``size`` is prime, else a permutation misses slots."""
    if len(set(names)) != len(names) or not names:
        raise ValueError("shard names have to be given and differ")
    if size < len(names) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError(f"{size} is no prime of at least {len(names)}")
    at = [_number(f"offset {n}") % size for n in names]
    step = [_number(f"step {n}") % (size - 1) + 1 for n in names]
    slots: list[int] = [-1] * size
    free = size
    while free:
        for i in range(len(names)):
            while slots[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % size
            slots[at[i]] = i
            free -= 1
            if not free:
                break
    return slots


def lookup(spark: SparkSession, names: list[str], size: int = SIZE) -> DataFrame:
    """The filled table as (slot, shard)."""
    filled = F.split(F.lit(",".join(map(str, fill(names, size)))), ",")
    return spark.range(1).select(F.posexplode(filled).alias("slot", "shard")).select("slot", F.col("shard").cast("int"))


def slot_of(key: Column, size: int) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(df: DataFrame, key: Column | str, names: list[str], size: int = SIZE) -> DataFrame:
    """``df`` with the columns ``slot`` and ``shard``."""
    key = F.col(key) if isinstance(key, str) else key
    df = df.withColumn("slot", slot_of(key, size)).drop("shard")
    return df.join(F.broadcast(lookup(df.sparkSession, names, size)), "slot")


def write_shards(df: DataFrame, path: str, salts: int = 8) -> None:
    """Write placed rows in one folder a shard, by at most ``salts`` tasks each."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    df.repartition("shard", salt).write.partitionBy("shard").parquet(path)
