"""Re-attach surviving rows to surviving parents.

Four rules are tried in order: the parent in the own source; a row with the
parent's name in the same family; the same in any family; and finally a row with
that name on the own rank. Where several rows fit, the lowest id is taken. All rules but the last ask
for a parent of higher rank.

The rows that share a key are first reduced to the lowest id per rank code, so a
lookup meets one row with at most one entry per code of the rank vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import PARENT_ID, SCOPE, TAXON_ID
from ..runtime import DEFAULT_COLLATION, materialize
from .skew import balanced_join
from .spelling import key_of


def _by_rank(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One row per key with ``column``: array of (rank code, lowest id)."""
    return (
        rows.groupBy(*keys, "rank_code")
        .agg(F.min("id").alias("id"))
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("rank_code", "id")).alias(column))
    )


def _lowest(candidates: str, test) -> Column:
    return F.array_min(F.transform(F.filter(F.col(candidates), lambda c: test(c["rank_code"])), lambda c: c["id"]))


def _higher(candidates: str) -> Column:
    return _lowest(candidates, lambda code: code > F.col("rank_code"))


def parent_same_source(rows: DataFrame) -> DataFrame:
    """Add ``p1``: the parent by source key, of higher rank."""
    keys = [*SCOPE, PARENT_ID]
    found = _by_rank(rows.select(*SCOPE, F.col(TAXON_ID).alias(PARENT_ID), "rank_code", "id"), keys, "_c")
    return balanced_join(rows, found, keys, "left", ["id"]).withColumn("p1", _higher("_c")).drop("_c")


def _with_family_matches(df: DataFrame, rows: DataFrame, collation: str) -> DataFrame:
    """Add ``_c``: the entries of ``rows`` with the parent's name and the own family."""
    keys = ["_name", "_family"]
    family, parent = key_of(df, "familyCache", collation), key_of(df, "parent_taxon", collation)
    found = _by_rank(
        rows.filter(F.col("familyCache").isNotNull()).select(
            key_of(rows, "taxon", collation).alias("_name"),
            key_of(rows, "familyCache", collation).alias("_family"),
            "rank_code",
            "id",
        ),
        keys,
        "_c",
    )
    keyed = df.withColumn("_name", parent).withColumn("_family", family)
    return balanced_join(keyed, found, keys, "left", ["id"]).drop(*keys)


def _with_name_matches(df: DataFrame, rows: DataFrame, collation: str, stored: DataFrame | None = None) -> DataFrame:
    """Add ``_c``: the entries of ``rows`` with the parent's name.

    ``stored`` has the same rows as ``df`` if that is expensive to count.
    """
    parent = key_of(df, "parent_taxon", collation)
    found = _by_rank(rows.select(key_of(rows, "taxon", collation).alias("_name"), "rank_code", "id"), ["_name"], "_c")
    keyed = df.withColumn("_name", parent)
    counted = (df if stored is None else stored).select(parent.alias("_name"))
    return balanced_join(keyed, found, ["_name"], "left", ["id"], hot_in=counted).drop("_name")


def _equal_rank(df: DataFrame, collation: str) -> Column:
    other = key_of(df, "parent_taxon", collation) != key_of(df, "taxon", collation)
    return F.when(other, _lowest("_c", lambda code: code == F.col("rank_code")))


def parent_same_family(rows: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Add ``p2``: a row named as the parent, in the same family, of higher rank."""
    return _with_family_matches(rows, rows, collation).withColumn("p2", _higher("_c")).drop("_c")


def parent_any_family(rows: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Add ``p3``: a row named as the parent, of higher rank."""
    return _with_name_matches(rows, rows, collation).withColumn("p3", _higher("_c")).drop("_c")


def parent_same_rank(rows: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Add ``p4``: a row named as the parent but not as the row itself, of equal rank."""
    return _with_name_matches(rows, rows, collation).withColumn("p4", _equal_rank(rows, collation)).drop("_c")


def link_parents(rows: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Set ``parent_id`` by the first rule that finds a parent.

    The parent in the own source replaces an existing ``parent_id``; the other
    rules only fill gaps, so only rows without parent go through the joins by name.
    """
    columns = rows.columns
    first = materialize(
        parent_same_source(rows).withColumn("parent_id", F.coalesce("p1", "parent_id")).select(*columns), "own-parents"
    )
    open_ = F.col("parent_id").isNull() & F.col("parent_taxon").isNotNull()
    open_rows = first.filter(open_)
    linked = _with_family_matches(open_rows, rows, collation)
    linked = linked.withColumn("parent_id", _higher("_c")).drop("_c")
    linked = _with_name_matches(linked, rows, collation, stored=open_rows)
    linked = linked.withColumn("parent_id", F.coalesce("parent_id", _higher("_c"), _equal_rank(first, collation)))
    return first.filter(~open_).unionByName(linked.select(*columns))
