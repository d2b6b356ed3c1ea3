"""Data model: column names, table schemas and the fixed vocabularies."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SOURCE = "TaxonomySourceID"
PROJECT = "SourceProjectID"
TAXON_ID = "SourceTaxonID"
PARENT_ID = "SourceParentTaxonID"
ACCEPTED_ID = "SourceAcceptedTaxonID"

#: a tree lives inside one (source, project)
SCOPE = [SOURCE, PROJECT]
#: identifies a taxon inside its tree
KEY = [SOURCE, PROJECT, TAXON_ID]
#: uniqueness of staged rows
TAXA_ORIGIN = [TAXON_ID, SOURCE, PARENT_ID, PROJECT]
SYNONYM_ORIGIN = [TAXON_ID, SOURCE, PROJECT, ACCEPTED_ID]

ROOT_NAME = "root"
#: source number of the generated root rows; real sources count from 1
ROOT_SOURCE = 0


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


_LONG, _INT, _STR = T.LongType(), T.IntegerType(), T.StringType()

TAXA_SCHEMA = _schema(
    (SOURCE, _LONG, False),
    (TAXON_ID, _LONG, False),
    (PARENT_ID, _LONG, True),
    (PROJECT, _LONG, False),
    ("taxon", _STR, False),
    ("author", _STR, True),
    ("parent_taxon", _STR, True),
    ("rank", _STR, False),
    ("scientificName", _STR, True),
)

SYNONYMS_SCHEMA = _schema(
    (SOURCE, _LONG, False),
    (TAXON_ID, _LONG, False),
    (PROJECT, _LONG, False),
    (ACCEPTED_ID, _LONG, False),
    ("taxon", _STR, False),
    ("author", _STR, True),
    ("rank", _STR, False),
)

COMMON_NAMES_SCHEMA = _schema(
    (SOURCE, _LONG, False),
    (TAXON_ID, _LONG, False),
    (PROJECT, _LONG, False),
    ("name", _STR, False),
    ("code", _STR, False),
    ("db_name", _STR, False),
)

REDLIST_SCHEMA = _schema(
    (SOURCE, _LONG, False),
    (TAXON_ID, _LONG, False),
    (PROJECT, _LONG, False),
    ("term", _STR, True),
    ("value", _STR, False),
    ("reference", _STR, True),
)

#: (column, may be null, longest text or None) as the target tables enforce it
CONSTRAINTS = {
    "taxa": [
        (TAXON_ID, False, None),
        (SOURCE, False, None),
        (PROJECT, False, None),
        ("taxon", False, 255),
        ("author", True, 255),
        ("parent_taxon", True, 255),
        ("rank", False, 25),
        ("scientificName", True, 255),
    ],
    "synonyms": [
        (TAXON_ID, False, None),
        (SOURCE, False, None),
        (PROJECT, False, None),
        (ACCEPTED_ID, False, None),
        ("taxon", False, 255),
        ("author", True, 255),
        ("rank", False, 25),
    ],
    "common_names": [
        (TAXON_ID, False, None),
        (SOURCE, False, None),
        (PROJECT, False, None),
        ("name", False, 255),
        ("code", False, 2),
        ("db_name", False, 50),
    ],
    "redlist": [
        (TAXON_ID, False, None),
        (SOURCE, False, None),
        (PROJECT, False, None),
        ("term", True, 50),
        ("value", False, 50),
        ("reference", True, 800),
    ],
}

# The rank vocabulary with its codes.
RANK_CODES = [
    ("cand.", 10),
    ("tax. infrasp.", 20),
    ("f. sp.", 30),
    ("subsubfm.", 40),
    ("subfm.", 50),
    ("f.", 60),
    ("subvar.", 70),
    ("var.", 80),
    ("pathovar.", 90),
    ("biovar.", 100),
    ("cult.", 110),
    ("convar.", 120),
    ("cultivar. group", 130),
    ("graft-chimaera", 140),
    ("infrasp.", 150),
    ("subsp.", 160),
    ("grex", 165),
    ("sp.", 170),
    ("sp. group", 180),
    ("aggr.", 190),
    ("agg.", 191),
    ("tax. infragen.", 200),
    ("subser.", 210),
    ("ser.", 220),
    ("subsect.", 230),
    ("sect.", 240),
    ("infragen.", 250),
    ("subgen.", 260),
    ("gen.", 270),
    ("infratrib.", 280),
    ("subtrib.", 290),
    ("trib.", 300),
    ("supertrib.", 310),
    ("infrafam.", 320),
    ("subfam.", 330),
    ("fam.", 340),
    ("superfam.", 350),
    ("infraord.", 360),
    ("subord.", 370),
    ("ord.", 380),
    ("superord.", 390),
    ("infracl.", 400),
    ("subcl.", 410),
    ("cl.", 420),
    ("supercl.", 430),
    ("infraphyl./div.", 440),
    ("subphyl./div.", 450),
    ("phyl./div.", 460),
    ("superphyl./div.", 470),
    ("infrareg.", 480),
    ("subreg.", 490),
    ("reg.", 500),
    ("superreg.", 510),
    ("dom.", 520),
    ("tax. supragen.", 530),
]

# Long rank labels and their abbreviations.
RANK_RENAMES = {
    "species": "sp.",
    "variety": "var.",
    "subspecies": "subsp.",
    "phylum": "phyl./div.",
    "family": "fam.",
    "order": "ord.",
    "class": "cl.",
    "form": "f.",
    "genus": "gen.",
    "kingdom": "reg.",
    "infraorder": "infraord.",
}

FAMILY_RANK = "fam."

# The property terms that consumers of the red list know by id.
REDLIST_TERMS = [
    (27, "AktuelleBestandssituation", "rl_category", "de"),
    (28, "KurzfristigerBestandstrend", "rl_category", "de"),
    (29, "LangfristigerBestandstrend", "rl_category", "de"),
    (30, "LetzterNachweis", "rl_category", "de"),
    (31, "Neobiota", "rl_category", "de"),
    (32, "Risikofaktoren", "rl_category", "de"),
    (33, "RL-Kategorie", "rl_category", "de"),
    (34, "Sonderfälle", "rl_category", "de"),
    (35, "Verantwortlichkeit", "rl_category", "de"),
]

# Property labels that are red-list data, by edition.
REDLIST_LABELS = [
    "RoteListe_D_2009_AktuelleBestandssituation",
    "RoteListe_D_2009_KurzfristigerBestandstrend",
    "RoteListe_D_2009_LangfristigerBestandstrend",
    "RoteListe_D_2009_LetzterNachweis",
    "RoteListe_D_2009_Neobiota",
    "RoteListe_D_2009_RL-Kategorie",
    "RoteListe_D_2009_Risikofaktoren",
    "RoteListe_D_2009_Sonderfälle",
    "RoteListe_D_2009_Verantwortlichkeit",
    "RoteListe_D_2011_AktuelleBestandssituation",
    "RoteListe_D_2011_KurzfristigerBestandstrend",
    "RoteListe_D_2011_LangfristigerBestandstrend",
    "RoteListe_D_2011_LetzterNachweis",
    "RoteListe_D_2011_Neobiota",
    "RoteListe_D_2011_RL-Kategorie",
    "RoteListe_D_2011_Risikofaktoren",
    "RoteListe_D_2011_Verantwortlichkeit",
    "RoteListe_D_2016_AktuelleBestandssituation",
    "RoteListe_D_2016_KurzfristigerBestandstrend",
    "RoteListe_D_2016_LangfristigerBestandstrend",
    "RoteListe_D_2016_LetzterNachweis",
    "RoteListe_D_2016_Neobiota",
    "RoteListe_D_2016_RL-Kategorie",
    "RoteListe_D_2016_Risikofaktoren",
    "RoteListe_D_2016_Sonderfälle",
    "RoteListe_D_2016_Verantwortlichkeit",
]

# List projects that hold red lists, by database; others take all.
REDLIST_PROJECT_RANGES = {
    "Animalia": (381, 881),
    "Insecta": (381, 881),
    "Vertebrata": (923, 927),
}

# The generated root rows (id, parent id, taxon, rank, parent).
ROOTS = [
    (1, None, "root", "root", None),
    (2, 1, "Animalia", "reg.", "root"),
    (3, 1, "Plantae", "reg.", "root"),
    (4, 1, "Fungi", "reg.", "root"),
]
FIRST_FREE_ID = 5


@dataclass(frozen=True)
class SourceSpec:
    """One checklist database: where it is and which projects to take from it.

    ``location`` is a folder with one table per sub-path for file formats and a
    JDBC url for ``fmt="jdbc"``. The order of the specs given to a run is the
    priority of the sources; the order of ``project_ids`` that of the projects.
    """

    name: str
    dbname: str
    location: str
    project_ids: tuple[int, ...]
    fmt: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)


def rank_dim(spark: SparkSession) -> DataFrame:
    """The rank vocabulary, 55 rows."""
    return spark.createDataFrame(RANK_CODES, _schema(("rank", _STR, False), ("rank_code", _INT, False)))


def redlist_terms(spark: SparkSession) -> DataFrame:
    """The property terms with their fixed ids, 9 rows."""
    return spark.createDataFrame(
        REDLIST_TERMS,
        _schema(("id", _LONG, False), ("term", _STR, False), ("category", _STR, False), ("lang", _STR, False)),
    )


def root_rows(spark: SparkSession) -> DataFrame:
    """Root and kingdoms with their merged ids, in the shape of staged taxa."""
    rows = [
        (i, ROOT_SOURCE, i, parent, 0, taxon, None, parent_taxon, rank, None, parent)
        for i, parent, taxon, rank, parent_taxon in ROOTS
    ]
    schema = T.StructType(
        [T.StructField("id", _LONG, False), *TAXA_SCHEMA.fields, T.StructField("parent_id", _LONG, True)]
    )
    return spark.createDataFrame(rows, schema)
