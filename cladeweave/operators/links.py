"""Dependent rows (synonyms, red-list values) and the taxa they belong to.

Before the merge the name and family of the taxon are noted on the dependent row.
After the merge the row is linked to the surviving row of its taxon, or else to a
surviving row with that name and family.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import ACCEPTED_ID, KEY, SCOPE, TAXON_ID
from ..runtime import DEFAULT_COLLATION, materialize
from .skew import ROW, balanced_join, numbered
from .spelling import Spelling, key_of, without_keys


def _prepare(df: DataFrame, lineage_df: DataFrame, key: str, name: str) -> DataFrame:
    noted = lineage_df.select(
        *SCOPE, F.col(TAXON_ID).alias(key), F.col("taxon").alias(name), F.col("family").alias("familyCache")
    )
    return balanced_join(numbered(df), noted, [*SCOPE, key], "left", [ROW]).drop(ROW)


def prepare_synonyms(synonyms: DataFrame, lineage_df: DataFrame) -> DataFrame:
    """Add ``accepted_taxon`` and ``familyCache`` of the accepted taxon."""
    return _prepare(synonyms, lineage_df, ACCEPTED_ID, "accepted_taxon")


def prepare_redlist(redlist: DataFrame, lineage_df: DataFrame) -> DataFrame:
    """Add ``taxon`` and ``familyCache`` of the taxon itself."""
    return _prepare(redlist, lineage_df, TAXON_ID, "taxon")


def link_by_key(df: DataFrame, merged: DataFrame, key: str, column: str = "by_key") -> DataFrame:
    """Add the merged id of the row's own taxon; the lowest if it has several rows."""
    ids = merged.groupBy(*KEY).agg(F.min("id").alias(column)).withColumnRenamed(TAXON_ID, key)
    return balanced_join(df, ids, [*SCOPE, key], "left", [ROW] if ROW in df.columns else df.columns)


def link_by_name(
    df: DataFrame,
    merged: DataFrame,
    name: str,
    column: str = "by_name",
    collation: str = DEFAULT_COLLATION,
    open_column: str | None = None,
    hot_in: DataFrame | None = None,
) -> DataFrame:
    """Add the lowest merged id with the row's taxon name and family.

    With ``open_column`` only rows in which that column is null are looked up.
    ``hot_in`` is a stored table with the names and families of ``df``.
    """
    keys = ["_name", "_family"]
    ids = (
        merged.filter(F.col("familyCache").isNotNull())
        .groupBy(key_of(merged, "taxon", collation).alias("_name"), key_of(merged, "familyCache", collation).alias("_family"))
        .agg(F.min("id").alias(column))
    )
    wanted, family = key_of(df, name, collation), key_of(df, "familyCache", collation)
    counted = (df if hot_in is None else hot_in).select(wanted.alias("_name"), family.alias("_family"))
    if open_column:
        wanted = F.when(F.col(open_column).isNull(), wanted)
    keyed = df.withColumn("_name", wanted).withColumn("_family", family)
    spread = [ROW] if ROW in df.columns else df.columns
    return balanced_join(keyed, ids, keys, "left", spread, hot_in=counted, null_heavy=True).drop(*keys)


def _relink(df: DataFrame, merged: DataFrame, key: str, name: str, column: str, collation: str) -> DataFrame:
    spelling = Spelling(
        collation, *((d, c) for d, c in ((df, name), (df, "familyCache"), (merged, "taxon"), (merged, "familyCache")))
    )
    known = spelling.with_keys(merged, ["taxon", "familyCache"], ["id"])
    rows = spelling.with_keys(numbered(df), [name, "familyCache"], [ROW])
    if rows.columns != [*df.columns, ROW]:
        rows = materialize(rows, "spelled")  # keys are counted on it
    linked = link_by_name(
        link_by_key(rows, known, key), known, name, collation=collation, open_column="by_key", hot_in=rows
    )
    return without_keys(linked.withColumn(column, F.coalesce("by_key", "by_name")).drop("by_key", "by_name", ROW)).select(*df.columns, column)


def relink_synonyms(prepared: DataFrame, merged: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Add ``syn_taxon_id``, the merged id of the accepted taxon, or null."""
    return _relink(prepared, merged, ACCEPTED_ID, "accepted_taxon", "syn_taxon_id", collation)


def relink_redlist(prepared: DataFrame, merged: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Add ``taxon_id``, the merged id of the taxon, or null."""
    return _relink(prepared, merged, TAXON_ID, "taxon", "taxon_id", collation)
