"""Extracted rows brought into the shape of the merge, and the tables written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranks import normalize_ranks
from ..model import (
    COMMON_NAMES_SCHEMA,
    FIRST_FREE_ID,
    PARENT_ID,
    PROJECT,
    REDLIST_SCHEMA,
    ROOT_SOURCE,
    SOURCE,
    SYNONYM_ORIGIN,
    SYNONYMS_SCHEMA,
    TAXA_ORIGIN,
    TAXA_SCHEMA,
    TAXON_ID,
    root_rows,
)
from ..operators.ids import one_per_key, ordered_ids
from ..runtime import DEFAULT_COLLATION

# Extracted columns and their names in the staged tables.
_RENAMES = {
    "canonicalName": "taxon",
    "scientificNameAuthorShip": "author",
    "parentCanonicalName": "parent_taxon",
    "taxonRank": "rank",
    "CommonName": "name",
    "Code": "code",
    "Term": "term",
    "Value": "value",
    "Reference": "reference",
}


def _shape(df: DataFrame, schema: T.StructType) -> DataFrame:
    renamed = df.withColumnsRenamed({k: v for k, v in _RENAMES.items() if k in df.columns})
    return renamed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stage_taxa(df: DataFrame) -> DataFrame:
    return _shape(df, TAXA_SCHEMA)


def stage_synonyms(df: DataFrame) -> DataFrame:
    """Staged synonyms, one row per origin key."""
    return one_per_key(_shape(df, SYNONYMS_SCHEMA), SYNONYM_ORIGIN)


def stage_common_names(df: DataFrame) -> DataFrame:
    return _shape(df, COMMON_NAMES_SCHEMA)


def stage_redlist(df: DataFrame) -> DataFrame:
    return _shape(df, REDLIST_SCHEMA)


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """All extracted rows, duplicates kept."""
    return reduce(DataFrame.unionByName, parts)


def source_registry(spark: SparkSession, names: list[str]) -> DataFrame:
    """Source ids in the given order, which is the priority of the sources."""
    if len(set(names)) != len(names):
        raise ValueError("source names must be unique")
    rows = [(i, name) for i, name in enumerate(names, start=ROOT_SOURCE + 1)]
    return spark.createDataFrame(
        rows, T.StructType([T.StructField(SOURCE, T.LongType()), T.StructField("taxonomy_source_name", T.StringType())])
    )


def number_taxa(
    staged: DataFrame, project_order: dict[int, list[int]] | None = None, collation: str = DEFAULT_COLLATION
) -> DataFrame:
    """The table to merge: roots and staged taxa with ids, ranks and rank codes.

    Ids follow the source, the position of the project in ``project_order`` of the
    source (projects not given come last, by number), the taxon id and the parent id. They
    decide between equally deep copies. The rows are stored on the way, the result
    only adds the ids to a scan of them.
    """
    unique = normalize_ranks(one_per_key(staged, TAXA_ORIGIN), collation)
    places = [
        F.when((F.col(SOURCE) == source) & (F.col(PROJECT) == project), F.lit(place))
        for source, projects in (project_order or {}).items()
        for place, project in enumerate(projects)
    ]
    place = F.coalesce(*places, F.lit(1 << 30))
    order = [SOURCE, "_place", PROJECT, TAXON_ID, PARENT_ID, "taxon", "rank", "author", "parent_taxon", "scientificName"]
    numbered = ordered_ids(unique.withColumn("_place", place), order, FIRST_FREE_ID).drop("_place")
    return normalize_ranks(root_rows(staged.sparkSession), collation).unionByName(
        numbered.withColumn("parent_id", F.lit(None).cast("long"))
    )


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write a result table; by default a run replaces what was there."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options: str) -> None:
    """Write a result table to a database."""
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()
