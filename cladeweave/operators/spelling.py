"""Names that compare without regard to case and accents, in one spelling.

Aggregates and joins on collated texts sort, and hashes of them differ between spellings.
So the spellings are made equal once: the distinct names of all tables concerned are found
byte by byte (a hash aggregation), only these are grouped under the collation, and a stored
dictionary keeps those that are not the canonical spelling of their class. Tables get key
columns with the canonical spelling by a join with that dictionary, which is small where
names are mostly spelled alike; everything after compares bytes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import ROOT_NAME
from ..runtime import BINARY, materialize, name_key, shuffled
from .skew import balanced_join

_PREFIX = "_key_"
#: spellings up to this number are broadcast: names of some 100 bytes
BROADCAST_ROWS = 500_000


def key_of(df: DataFrame, column: str, collation: str) -> Column:
    """What to compare instead of ``column``: its key column, or else the column itself."""
    key = _PREFIX + column
    return F.col(key) if key in df.columns else name_key(column, collation)


def without_keys(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(_PREFIX)])


def rename_key(df: DataFrame, old: str, new: str) -> DataFrame:
    """``df`` whose key column of ``old`` serves ``new``, if it has one."""
    return df.withColumnRenamed(_PREFIX + old, _PREFIX + new)


class Spelling:
    """Canonical spellings of the names in some columns under a collation."""

    def __init__(self, collation: str, *columns: tuple[DataFrame, str]):
        self._variants: DataFrame | None = None
        self._small = True
        if collation == BINARY:
            return
        names = reduce(DataFrame.unionByName, [df.select(F.col(c).alias("name")) for df, c in columns])
        names = materialize(names.filter(F.col("name").isNotNull()).distinct(), "names")
        first = F.min(F.struct(F.col("name") != ROOT_NAME, "name"))["name"]
        classes = (
            names.groupBy(name_key("name", collation).alias("_class"))
            .agg(first.alias("canonical"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1")
            .drop("n")
        )
        # a class of n spellings is one key of n short rows, each spelling once in all tables
        met = names.join(shuffled(classes), name_key("name", collation) == F.col("_class")).drop("_class")
        self._variants = materialize(met.filter(F.col("name") != F.col("canonical")), "variants")
        self._small = self._variants.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS

    def with_keys(self, df: DataFrame, columns: list[str], spread: list[str]) -> DataFrame:
        """``df`` with key columns for ``columns``. ``spread`` names columns that tell rows of
        one name apart."""
        if self._variants is None:
            return df
        for column in columns:
            variants = self._variants.select(F.col("name").alias(column), F.col("canonical").alias(_PREFIX + column))
            if self._small:
                df = df.join(F.broadcast(variants), column, "left")
            else:
                df = balanced_join(df, variants, [column], "left", spread)
            df = df.withColumn(_PREFIX + column, F.coalesce(F.col(_PREFIX + column), F.col(column)))
        return df
