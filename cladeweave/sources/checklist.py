"""Checklist databases: reading their tables, and the four extractions.

A checklist keeps names, hierarchy, acceptance, synonymy, lists and list properties
of many projects in normalised tables. An extraction takes the part of the
projects asked for, all of them in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..model import ACCEPTED_ID, PARENT_ID, PROJECT, REDLIST_LABELS, REDLIST_PROJECT_RANGES, SOURCE, TAXON_ID, SourceSpec
from ..operators.skew import ROW, balanced_join, balanced_outer, dimension_join, numbered
from ..runtime import DEFAULT_COLLATION, materialize, name_key, shuffled

# Tables of a checklist database and the columns that are used.
TABLES = {
    "TaxonName": [
        "NameID",
        "GenusOrSupragenericName",
        "SpeciesEpithet",
        "InfraspecificEpithet",
        "NomenclaturalCode",
        "BasionymAuthors",
        "CombiningAuthors",
        "SanctioningAuthor",
        "BasionymAuthorsYear",
        "YearOfPubl",
        "IsRecombination",
        "NonNomenclaturalNameSuffix",
        "TaxonomicRank",
        "TaxonNameCache",
    ],
    "TaxonNameProject": ["NameID", "ProjectID"],
    "TaxonHierarchy": ["NameID", "NameParentID", "ProjectID"],
    "TaxonNameTaxonomicRank_Enum": ["Code", "DisplayOrder"],
    "TaxonAcceptedName": ["NameID", "ProjectID", "IgnoreButKeepForReference"],
    "TaxonSynonymy": ["NameID", "SynNameID"],
    "TaxonCommonName": ["NameID", "CommonName", "LanguageCode"],
    "TaxonNameList": ["NameID", "ProjectID"],
    "TaxonNameListReference": ["NameID", "ProjectID", "TaxonNameListRefText"],
    "TaxonNameListAnalysis": ["NameID", "ProjectID", "AnalysisID", "AnalysisValue"],
    "TaxonNameListAnalysisCategory": ["AnalysisID", "DisplayText"],
}

Tables = dict[str, DataFrame]

#: ranges of NameID, of about as many rows each, that a table of a database is read in
JDBC_PARTITIONS = 32

#: a name in a project
_MEMBER = ["NameID", "ProjectID"]


def read_checklist(spark: SparkSession, spec: SourceSpec) -> Tables:
    """The tables of one source, reduced to the columns in use.

    File formats are read from ``location/<table>``. Over JDBC, tables with a NameID
    are read in parallel ranges of it that hold about as many rows each, however the ids lie;
    there are ``JDBC_PARTITIONS`` of them, or the option ``numPartitions`` says.
    """
    if spec.fmt == "jdbc":
        return {name: _read_jdbc(spark, spec, name, columns) for name, columns in TABLES.items()}
    reader = spark.read.format(spec.fmt).options(**spec.options)
    return {name: reader.load(f"{spec.location}/{name}").select(*columns) for name, columns in TABLES.items()}


def jdbc_options(spec: SourceSpec) -> dict[str, str]:
    """Options of every reader of a source."""
    return {k: v for k, v in spec.options.items() if k != "numPartitions"} | {"url": spec.location}


def jdbc_quantiles(spec: SourceSpec, table: str) -> str:
    """The query for the least NameID of each of the parts that hold as many rows."""
    parts = int(spec.options.get("numPartitions", JDBC_PARTITIONS))
    tiles = f"SELECT NameID, NTILE({parts}) OVER (ORDER BY NameID) AS part FROM {table} WHERE NameID IS NOT NULL"
    return f"SELECT MIN(NameID) AS low FROM ({tiles}) tiles GROUP BY part"


def jdbc_predicates(lows: Sequence[int]) -> list[str]:
    """Conditions that put every row into one range, the first of which has the rows without
    NameID too. Parts that begin with the same NameID fall together."""
    cuts = sorted(set(lows))[1:]
    if not cuts:
        return ["1 = 1"]
    between = [f"NameID >= {low} AND NameID < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"NameID < {cuts[0]} OR NameID IS NULL", *between, f"NameID >= {cuts[-1]}"]


def _read_jdbc(spark: SparkSession, spec: SourceSpec, table: str, columns: list[str]) -> DataFrame:
    """A table, read once in parallel and stored: later scans and counts spare the database.

    The driver gets one number per range.
    """
    options = jdbc_options(spec)
    lows = []
    if "NameID" in columns:
        found = spark.read.format("jdbc").options(**options, query=jdbc_quantiles(spec, table)).load()
        lows = [int(r["low"]) for r in found.collect()]
    properties = {k: v for k, v in options.items() if k != "url"}
    read = spark.read.jdbc(spec.location, table, predicates=jdbc_predicates(lows), properties=properties)
    return materialize(read.select(*columns), f"jdbc-{table}")


# --- filters and joins --------------------------------------------------------------


def by_project(df: DataFrame, project_ids: Sequence[int]) -> DataFrame:
    return df.filter(F.col("ProjectID").isin(list(project_ids)))


def project_members(t: Tables, project_ids: Sequence[int]) -> DataFrame:
    """(NameID, ProjectID) of the names in the projects."""
    return by_project(t["TaxonNameProject"], project_ids).select(*_MEMBER)


def _acceptance(t: Tables, project_ids: Sequence[int]) -> DataFrame:
    return by_project(t["TaxonAcceptedName"], project_ids).filter("IgnoreButKeepForReference = 0").select(*_MEMBER)


def accepted_only(members: DataFrame, t: Tables, project_ids: Sequence[int]) -> DataFrame:
    """Members whose name is accepted in the project."""
    return members.join(shuffled(_acceptance(t, project_ids)), _MEMBER, "left_semi")


def not_accepted(members: DataFrame, t: Tables, project_ids: Sequence[int]) -> DataFrame:
    """Members whose name is not accepted in the project."""
    return members.join(shuffled(_acceptance(t, project_ids)), _MEMBER, "left_anti")


def with_hierarchy(members: DataFrame, t: Tables, project_ids: Sequence[int]) -> DataFrame:
    """Add ``NameParentID`` in the same project; one row per parent."""
    parents = by_project(t["TaxonHierarchy"], project_ids).select(*_MEMBER, "NameParentID")
    return balanced_outer(members, parents, _MEMBER, ["NameParentID"])


def with_name(members: DataFrame, names_: DataFrame, spread: list[str], hot_in: DataFrame | None = None) -> DataFrame:
    """Add the columns of the name."""
    return balanced_join(members, names_, ["NameID"], "inner", spread, hot_in=hot_in)


def with_parent_name(
    placed: DataFrame, names_: DataFrame, columns: dict[str, str], hot_in: DataFrame | None = None
) -> DataFrame:
    """Add ``columns`` (name in ``names_`` to new name) of the parent's row."""
    parent = names_.select(F.col("NameID").alias("NameParentID"), *[F.col(c).alias(n) for c, n in columns.items()])
    return balanced_join(
        placed, parent, ["NameParentID"], "left", ["NameID", "ProjectID"], hot_in=hot_in, null_heavy=hot_in is not None
    )


def with_display_order(df: DataFrame, t: Tables) -> DataFrame:
    """Add the ``DisplayOrder`` of the rank, null for an unknown rank."""
    ranks = t["TaxonNameTaxonomicRank_Enum"].select(F.col("Code").alias("TaxonomicRank"), "DisplayOrder")
    return dimension_join(df, ranks, ["TaxonomicRank"], "left", ["NameID"])


def _canonical() -> Column:
    return names.canonical_name(
        F.col("GenusOrSupragenericName"), F.col("SpeciesEpithet"), F.col("InfraspecificEpithet"), F.col("DisplayOrder")
    )


def zoological() -> Column:
    return names.zoo_authorship(
        F.col("BasionymAuthors"),
        F.col("BasionymAuthorsYear"),
        F.col("YearOfPubl"),
        F.col("IsRecombination"),
        F.col("NonNomenclaturalNameSuffix"),
    )


def botanical() -> Column:
    return names.botanical_authorship(
        F.col("BasionymAuthors"),
        F.col("CombiningAuthors"),
        F.col("SanctioningAuthor"),
        F.col("SpeciesEpithet"),
        F.col("InfraspecificEpithet"),
        F.col("TaxonomicRank"),
        F.col("NonNomenclaturalNameSuffix"),
    )


def with_canonical_name(df: DataFrame, t: Tables) -> DataFrame:
    """Add ``DisplayOrder`` and ``canonicalName``."""
    return with_display_order(df, t).withColumn("canonicalName", _canonical())


def with_authorship(df: DataFrame) -> DataFrame:
    """Add ``scientificNameAuthorShip``; needs ``DisplayOrder``."""
    return df.withColumn(
        "scientificNameAuthorShip",
        names.authorship(F.col("NomenclaturalCode"), F.col("DisplayOrder"), zoological(), botanical()),
    )


def tag_source(df: DataFrame, source_id: int, project: Column | int, db_name: str | None = None) -> DataFrame:
    """Add the source and project ids, and the database name if given."""
    project = project if isinstance(project, Column) else F.lit(project)
    tagged = df.withColumn(SOURCE, F.lit(source_id).cast("long")).withColumn(PROJECT, project.cast("long"))
    return tagged if db_name is None else tagged.withColumn("db_name", F.lit(db_name))


# --- extractions --------------------------------------------------------------------


#: what the extractions take from a name
_TEXTS = ["NameID", "canonicalName", "scientificNameAuthorShip", "TaxonomicRank", "TaxonNameCache"]


def name_texts(t: Tables, project_ids: Sequence[int]) -> DataFrame:
    """Canonical name, authorship and rank of the names in the projects and of the parents
    there, a stored table: other names of the database get no texts, and these get them once."""
    members = project_members(t, project_ids).select("NameID")
    parents = by_project(t["TaxonHierarchy"], project_ids).select(F.col("NameParentID").alias("NameID"))
    needed = members.union(parents).filter(F.col("NameID").isNotNull()).distinct()
    found = t["TaxonName"].join(shuffled(needed), "NameID", "left_semi")
    return materialize(with_authorship(with_canonical_name(found, t)).select(*_TEXTS), "name-texts")


def extract_taxa(t: Tables, source_id: int, project_ids: Sequence[int], texts: DataFrame | None = None) -> DataFrame:
    """Accepted names of the projects with authorship, parent and rank.

    All projects of a source go through together. ``texts`` are the :func:`name_texts` of the
    projects, made here if not given, so that the joins carry few columns and the parent's
    name needs no rank lookup of its own. List membership gives no column and would only
    repeat rows, so it is not joined.
    """
    texts = name_texts(t, project_ids) if texts is None else texts
    accepted = accepted_only(project_members(t, project_ids), t, project_ids)
    placed = with_hierarchy(accepted, t, project_ids)
    edges = by_project(t["TaxonHierarchy"], project_ids)
    named = with_name(placed, texts, ["ProjectID", "NameParentID"], hot_in=edges)
    full = with_parent_name(named, texts, {"canonicalName": "parentCanonicalName"}, hot_in=edges)
    return tag_source(full, source_id, F.col("ProjectID")).select(
        SOURCE,
        F.col("NameID").alias(TAXON_ID),
        F.col("NameParentID").alias(PARENT_ID),
        PROJECT,
        "canonicalName",
        "scientificNameAuthorShip",
        "parentCanonicalName",
        F.col("TaxonomicRank").alias("taxonRank"),
        F.col("TaxonNameCache").alias("scientificName"),
    ).distinct()


def list_members(named: DataFrame, t: Tables) -> DataFrame:
    """Rows of ``named`` once per list of their name, with the list's project."""
    lists = t["TaxonNameList"].select("NameID", F.col("ProjectID").alias("ListProjectID"))
    return balanced_join(lists, named, ["NameID"], "inner", ["ListProjectID"])


def synonym_targets(members: DataFrame, t: Tables) -> DataFrame:
    """Add ``SynNameID``: what the name is a synonym of, in any project."""
    return balanced_join(t["TaxonSynonymy"], members, ["NameID"], "inner", ["SynNameID"])


def extract_synonyms(t: Tables, source_id: int, project_ids: Sequence[int], texts: DataFrame | None = None) -> DataFrame:
    """Names of the projects that are not accepted, one row per accepted name.

    The hierarchy gives no column here and would only repeat rows. ``texts`` as in
    :func:`extract_taxa`.
    """
    texts = (name_texts(t, project_ids) if texts is None else texts).drop("TaxonNameCache")
    own = synonym_targets(not_accepted(project_members(t, project_ids), t, project_ids), t)
    named = with_name(own, texts, ["ProjectID", "SynNameID"], hot_in=t["TaxonSynonymy"])
    return tag_source(named, source_id, F.col("ProjectID")).select(
        SOURCE,
        F.col("NameID").alias(TAXON_ID),
        PROJECT,
        F.col("SynNameID").alias(ACCEPTED_ID),
        "canonicalName",
        "scientificNameAuthorShip",
        F.col("TaxonomicRank").alias("taxonRank"),
    ).distinct()


def _known_members(t: Tables, project_ids: Sequence[int]) -> DataFrame:
    return project_members(t, project_ids).join(shuffled(t["TaxonName"].select("NameID")), "NameID", "left_semi")


def common_names(t: Tables, project_ids: Sequence[int]) -> DataFrame:
    """Common names of the names of the projects."""
    known = _known_members(t, project_ids)
    return balanced_join(numbered(t["TaxonCommonName"]), known, ["NameID"], "inner", [ROW]).drop(ROW)


def extract_common_names(t: Tables, source_id: int, project_ids: Sequence[int], db_name: str) -> DataFrame:
    """Distinct common names, cut to the lengths of the target table.

    Repeated names are removed first; the projects then only add their number.
    """
    cut = (
        t["TaxonCommonName"]
        .select(
            "NameID",
            names.truncated(F.col("CommonName"), 255).alias("CommonName"),
            names.truncated(F.col("LanguageCode"), 2).alias("Code"),
        )
        .distinct()
    )
    known = _known_members(t, project_ids).distinct()
    placed = balanced_join(cut, known, ["NameID"], "inner", ["CommonName", "Code"], hot_in=t["TaxonCommonName"])
    return tag_source(placed, source_id, F.col("ProjectID"), db_name).select(
        SOURCE, F.col("NameID").alias(TAXON_ID), PROJECT, "CommonName", "Code", "db_name"
    )


def redlist_projects(df: DataFrame, db_name: str) -> DataFrame:
    """Rows of the projects that hold red lists in that database."""
    bounds = REDLIST_PROJECT_RANGES.get(db_name)
    return df if bounds is None else df.filter(F.col("ProjectID").between(*bounds))


def redlist_properties(df: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Rows whose property label belongs to a red list."""
    return df.filter(name_key("DisplayText", collation).isin(*[name_key(F.lit(x), collation) for x in REDLIST_LABELS]))


def redlist_values(t: Tables, db_name: str, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Red-list properties with their references, a bag."""
    labels = redlist_properties(t["TaxonNameListAnalysisCategory"], collation)
    analysis = numbered(redlist_projects(t["TaxonNameListAnalysis"], db_name))
    values = dimension_join(analysis, labels, ["AnalysisID"], "inner", [ROW])
    members = redlist_projects(t["TaxonNameList"], db_name)
    references = numbered(redlist_projects(t["TaxonNameListReference"], db_name))
    listed = balanced_join(references, members, _MEMBER, "inner", [ROW]).drop(ROW)
    return balanced_join(values, listed, _MEMBER, "inner", [ROW], hot_in=analysis).drop(ROW)


def extract_redlist(
    t: Tables,
    source_id: int,
    project_ids: Sequence[int],
    db_name: str,
    collation: str = DEFAULT_COLLATION,
) -> DataFrame:
    """Red-list values with term and reference.

    The values do not depend on a project; each project of the source carries them all, so
    that they link to the taxa of any.
    """
    return redlist_values(t, db_name, collation).select(
        F.lit(source_id).cast("long").alias(SOURCE),
        F.col("NameID").alias(TAXON_ID),
        F.explode(F.array(*[F.lit(p).cast("long") for p in project_ids])).alias(PROJECT),
        names.redlist_term(F.col("DisplayText")).alias("Term"),
        F.col("AnalysisValue").alias("Value"),
        F.col("TaxonNameListRefText").alias("Reference"),
    )
