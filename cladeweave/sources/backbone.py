"""A flat taxon table with parent and accepted ids (a backbone taxonomy)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import ACCEPTED_ID, PARENT_ID, PROJECT, SOURCE, TAXON_ID
from ..runtime import DEFAULT_COLLATION, same_name
from .checklist import tag_source

# The columns of the table, and the kingdom that is taken.
COLUMNS = [
    "TaxonID",
    "parentNameUsageID",
    "acceptedNameUsageID",
    "canonicalName",
    "scientificNameAuthorShip",
    "parentCanonicalName",
    "taxonRank",
    "scientificName",
    "taxonomicStatus",
    "kingdom",
]
KINGDOM = "Animalia"

_SCHEMA = ", ".join(f"{c} {'bigint' if c.endswith('ID') else 'string'}" for c in COLUMNS)


def read_backbone(spark: SparkSession, location: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """The backbone table; text files are tab separated with a header, and an empty
    field in them is null."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(sep="\t", header="true").schema(_SCHEMA)
    return reader.options(**options).load(location).select(*COLUMNS)


def _filled(column: str) -> Column:
    return F.col(column).isNotNull() & (F.rtrim(F.col(column)) != "")


def backbone_accepted(df: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Accepted names of the kingdom that have a name and a parent name.

    The kingdom's own row is taken whatever its status.
    """
    usable = (
        same_name("taxonomicStatus", F.lit("accepted"), collation)
        & _filled("canonicalName")
        & _filled("parentCanonicalName")
        & same_name("kingdom", F.lit(KINGDOM), collation)
    )
    return df.filter(usable | same_name("canonicalName", F.lit(KINGDOM), collation))


def backbone_synonyms(df: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    return df.filter(same_name("taxonomicStatus", F.lit("synonym"), collation))


def has_accepted_id(df: DataFrame) -> DataFrame:
    return df.filter(F.col("acceptedNameUsageID").isNotNull())


def extract_backbone_taxa(df: DataFrame, source_id: int, collation: str = DEFAULT_COLLATION) -> DataFrame:
    return tag_source(backbone_accepted(df, collation), source_id, 0).select(
        SOURCE,
        F.col("TaxonID").alias(TAXON_ID),
        F.col("parentNameUsageID").alias(PARENT_ID),
        PROJECT,
        "canonicalName",
        "scientificNameAuthorShip",
        "parentCanonicalName",
        "taxonRank",
        "scientificName",
    ).distinct()


def extract_backbone_synonyms(df: DataFrame, source_id: int, collation: str = DEFAULT_COLLATION) -> DataFrame:
    return tag_source(has_accepted_id(backbone_synonyms(df, collation)), source_id, 0).select(
        SOURCE,
        F.col("TaxonID").alias(TAXON_ID),
        PROJECT,
        F.col("acceptedNameUsageID").alias(ACCEPTED_ID),
        "canonicalName",
        "scientificNameAuthorShip",
        "taxonRank",
    ).distinct()
