"""Inputs in the shape of checklists, a backbone and staged rows, derived by Spark
from the given tables (see FIXTURES.md)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeweave.model import PARENT_ID, RANK_CODES, SCOPE, TAXON_ID

SPECIES_LIST_DB = "Vertebrata"
PROJECTS = (85, 930)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _long(value: Column | int) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("long")


# --- checklist --------------------------------------------------------------------


def checklist(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part = table(spark, sf_dir, "part")
    # the number of names is a single number that only scales a key
    n_names = part.count()
    key, size = F.col("p_partkey"), F.col("p_size")
    word = F.split("p_name", " ")
    species = F.when(key % 7 != 0, F.concat(word[1], (key % 89).cast("string")))
    # name 0 is the kingdom; as many digits as levels below it, as parents are one digit shorter
    levels = ["fam.", "gen.", "sp.", "subsp."]
    rank = F.when(key == 0, "reg.")
    for digits, level in enumerate(levels, start=1):
        rank = rank.when(key < 10**digits, level)
    names = part.select(
        key.alias("NameID"),
        F.when(key == 0, "Animalia").otherwise(F.concat(F.upper(word[0]), (key % 10).cast("string"))).alias("GenusOrSupragenericName"),
        species.alias("SpeciesEpithet"),
        F.when(key % 4 == 1, "").when(key % 4 == 2, species).when(key % 4 == 3, "minor").alias("InfraspecificEpithet"),
        F.when(key % 2 == 0, 3).otherwise(1).alias("NomenclaturalCode"),
        F.when(size % 7 == 0, None).when(size % 5 == 0, "").otherwise(F.col("p_brand")).alias("BasionymAuthors"),
        F.when(size % 3 == 0, F.col("p_type")).alias("CombiningAuthors"),
        F.when(size % 11 == 0, "Fr.").alias("SanctioningAuthor"),
        F.when(size % 6 != 0, size + 1800).alias("BasionymAuthorsYear"),
        F.when(size % 6 != 0, size + 1800).alias("YearOfPubl"),
        (size % 2).alias("IsRecombination"),
        F.when(key % 13 == 0, "s.l.").alias("NonNomenclaturalNameSuffix"),
        rank.otherwise("var.").alias("TaxonomicRank"),
        F.col("p_name").alias("TaxonNameCache"),
    )
    projects = part.select(
        key.alias("NameID"),
        F.explode(F.when((key % 2 == 0) | (key < 100), F.array(*map(F.lit, PROJECTS))).otherwise(F.array(F.lit(PROJECTS[0])))).alias("ProjectID"),
    )
    lineitem = table(spark, sf_dir, "lineitem")
    lists = lineitem.select(
        F.col("l_partkey").alias("NameID"), (F.col("l_suppkey") % 50 + 900).cast("int").alias("ProjectID"), "l_returnflag", "l_linenumber"
    )
    labels = [
        "RoteListe_D_2009_RL-Kategorie",
        "RoteListe_D_2009_Neobiota",
        "RoteListe_D_2009_Sonderfälle",
        "RoteListe_D_2016_RL-Kategorie",
        "RoteListe_D_2016_LetzterNachweis",
        "RoteListe_D_2011_Risikofaktoren",
        "RoteListe_D_1998_RL-Kategorie",
    ]
    return {
        "TaxonName": names,
        "TaxonNameProject": projects,
        "TaxonHierarchy": projects.select("NameID", F.floor(F.col("NameID") / 10).alias("NameParentID"), "ProjectID"),
        "TaxonNameTaxonomicRank_Enum": spark.createDataFrame(RANK_CODES, "Code string, DisplayOrder int"),
        "TaxonAcceptedName": projects.filter("NameID % 5 != 0 OR NameID < 100").select(
            "NameID", "ProjectID", F.when((F.col("NameID") % 50 == 1) & (F.col("NameID") >= 100), 1).otherwise(0).alias("IgnoreButKeepForReference")
        ),
        "TaxonSynonymy": part.filter(key % 5 == 0).select(key.alias("NameID"), (key + F.when(key % 2 == 0, 2).otherwise(1)).alias("SynNameID")),
        "TaxonCommonName": table(spark, sf_dir, "documents").select(
            (F.col("doc_id") % n_names).alias("NameID"), F.col("text").alias("CommonName"), F.col("lang").alias("LanguageCode")
        ),
        "TaxonNameList": lists.select("NameID", "ProjectID").distinct(),
        "TaxonNameListReference": lists.select(
            "NameID", "ProjectID", F.concat(F.lit("List "), "l_returnflag").alias("TaxonNameListRefText")
        ).distinct(),
        "TaxonNameListAnalysis": lists.select(
            "NameID", "ProjectID", F.col("l_linenumber").alias("AnalysisID"), F.col("l_returnflag").alias("AnalysisValue")
        ).distinct(),
        "TaxonNameListAnalysisCategory": spark.createDataFrame(
            list(enumerate(labels, start=1)), "AnalysisID int, DisplayText string"
        ),
    }


# --- backbone -----------------------------------------------------------------------


def backbone(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    rows = customer.select(
        (key + 10).alias("TaxonID"),
        _long(F.col("c_nationkey")).alias("parentNameUsageID"),
        F.when((key % 3 == 1) & (key % 5 != 0), key + 9).alias("acceptedNameUsageID"),
        F.when(key % 17 == 0, "").when(key % 19 == 0, None).otherwise(F.col("c_name")).alias("canonicalName"),
        F.lit(None).cast("string").alias("scientificNameAuthorShip"),
        F.when(key % 23 != 0, F.when(key % 2 == 0, "Animalia").otherwise(F.col("c_mktsegment"))).alias("parentCanonicalName"),
        F.lit("species").alias("taxonRank"),
        F.col("c_name").alias("scientificName"),
        F.when(key % 3 == 0, "accepted").when(key % 3 == 1, "synonym").otherwise("doubtful").alias("taxonomicStatus"),
        F.when(F.col("c_nationkey") % 2 == 0, "Animalia").otherwise("Plantae").alias("kingdom"),
    )
    top = spark.createDataFrame(
        [(1, None, None, "Animalia", None, None, "kingdom", "Animalia", "doubtful", "Animalia")], rows.schema
    )
    return rows.unionByName(top)


# --- staged taxa ----------------------------------------------------------------------

STAGED_COLUMNS = [
    "TaxonomySourceID",
    "SourceTaxonID",
    "SourceParentTaxonID",
    "SourceProjectID",
    "taxon",
    "author",
    "parent_taxon",
    "rank",
    "scientificName",
]
PROJECT = 1


def _staged(df: DataFrame, source, taxon_id, parent_id, taxon, parent_taxon, rank) -> DataFrame:
    author = F.concat(F.lit("Author "), (_long(taxon_id) % 97).cast("string"))
    return df.select(
        _long(source).alias("TaxonomySourceID"),
        _long(taxon_id).alias("SourceTaxonID"),
        _long(parent_id).alias("SourceParentTaxonID"),
        _long(PROJECT).alias("SourceProjectID"),
        taxon.alias("taxon"),
        author.alias("author"),
        parent_taxon.alias("parent_taxon"),
        rank.alias("rank"),
        F.concat_ws(" ", taxon, author).alias("scientificName"),
    )


def _segment() -> Column:
    """Position of the market segment in alphabetical order, and back."""
    names = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return F.array(*map(F.lit, names))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, id, key, nation, segment): the leaves of both sources."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_nationkey").alias("n"),
        (F.array_position(_segment(), F.col("c_mktsegment")) - 1).alias("g"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("n"), (F.col("s_suppkey") % 5).alias("g")
    )
    first = customer.select(_long(1).alias("s"), (F.col("key") + 1000000).alias("id"), "key", "n", "g")
    second = customer.filter("key % 3 = 0").select(_long(2).alias("s"), (F.col("key") + 1000000).alias("id"), "key", "n", "g")
    third = supplier.select(_long(2).alias("s"), (F.col("key") + 2000000).alias("id"), "key", "n", "g")
    return first.unionByName(second).unionByName(third).withColumn("ge", F.col("key") % 37)


def staged_taxa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows of both sources, without the roots."""
    col, lit = F.col, F.lit
    both = F.explode(F.array(_long(1), _long(2))).alias("s")
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation").join(F.broadcast(region), col("n_regionkey") == col("r_regionkey"))
    part = table(spark, sf_dir, "part")
    people = members(spark, sf_dir)
    segment = F.element_at(_segment(), (col("g") + 1).cast("int"))
    sub = (col("s") == 2) & (col("n") % 2 == 0)
    nation_names = nation.select(_long(col("n_nationkey")).alias("n"), "n_name")
    even = col("n_nationkey") % 2 == 0
    family_rows = people.select("s", "n", "g").distinct().join(F.broadcast(nation_names), "n")
    genus_rows = people.select("s", "n", "g", "ge").distinct()
    family_name = F.concat(segment, lit("_"), col("n").cast("string"))
    genus_name = F.concat(lit("Genus"), col("ge").cast("string"))
    brands = part.select("p_brand", _long(F.substring("p_brand", 7, 10)).alias("b"))
    parts = [
        # one kingdom row per source
        _staged(
            region.filter("r_regionkey = 0").select(both), col("s"), 1, lit(None), lit("Animalia"), lit(None).cast("string"), lit("kingdom")
        ),
        _staged(region.select("*", both), col("s"), col("r_regionkey") + 1000, 1, col("r_name"), lit("Animalia"), lit("class")),
        _staged(
            nation.select("*", both), col("s"), col("n_nationkey") + 2000, col("n_regionkey") + 1000, col("n_name"), col("r_name"), lit("order")
        ),
        _staged(
            nation.filter(even),
            2,
            col("n_nationkey") + 3000,
            col("n_nationkey") + 2000,
            F.concat(lit("Sub"), "n_name"),
            col("n_name"),
            F.when(col("n_nationkey") % 4 == 0, "order").otherwise("subord."),
        ),
        _staged(
            family_rows,
            col("s"),
            4000 + col("n") * 10 + col("g"),
            F.when(sub, col("n") + 3000).otherwise(col("n") + 2000),
            family_name,
            F.when(sub, F.concat(lit("Sub"), "n_name")).otherwise(col("n_name")),
            lit("family"),
        ),
        _staged(
            genus_rows,
            col("s"),
            100000 + (col("n") * 10 + col("g")) * 100 + col("ge"),
            4000 + col("n") * 10 + col("g"),
            genus_name,
            family_name,
            lit("genus"),
        ),
        _staged(
            people,
            col("s"),
            col("id"),
            100000 + (col("n") * 10 + col("g")) * 100 + col("ge"),
            F.concat(genus_name, lit(" sp"), (col("key") % 211).cast("string")),
            genus_name,
            F.when(col("key") % 13 == 0, "subspecies").when(col("key") % 29 == 0, "variety").otherwise("species"),
        ),
        _staged(brands.distinct(), 1, col("b") + 500000, lit(None), col("p_brand"), lit("NoFam"), lit("genus")),
        _staged(
            part.select("*", _long(F.substring("p_brand", 7, 10)).alias("b")),
            1,
            col("p_partkey") + 3000000,
            col("b") + 500000,
            F.concat("p_brand", lit(" p"), col("p_partkey").cast("string")),
            col("p_brand"),
            lit("species"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def respelled(staged: DataFrame) -> DataFrame:
    """Staged taxa of the second source with other case and accents in a part of the names."""
    other = F.col("TaxonomySourceID") == 2
    taxon = F.when(other & (F.col("SourceTaxonID") % 3 == 0), F.upper("taxon")).when(
        other & (F.col("SourceTaxonID") % 3 == 1), F.translate("taxon", "aeou", "äéöú")
    )
    parent = F.when(other & (F.col("SourceTaxonID") % 4 == 0), F.upper("parent_taxon")).when(
        other & (F.col("SourceTaxonID") % 4 == 1), F.translate("parent_taxon", "aeou", "äéöú")
    )
    return staged.withColumns(
        {"taxon": F.coalesce(taxon, "taxon"), "parent_taxon": F.coalesce(parent, "parent_taxon")}
    )


def familyless_copies(banded: DataFrame) -> DataFrame:
    """``banded`` and, as if listed once more, second copies with the whole name: of every
    third row without family, and of every fiftieth below family level with the family lost."""
    lower = banded.filter("band != 'family'")
    again = lower.filter("(family IS NULL AND id % 3 = 0) OR (family IS NOT NULL AND id % 50 = 0)")
    again = again.withColumn("id", F.col("id") + 10**9).withColumn("family", F.lit(None).cast("string"))
    return banded.unionByName(again)


def staged_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.col("o_orderstatus") == "P"
    return table(spark, sf_dir, "orders").select(
        F.when(first, _long(1)).otherwise(_long(2)).alias("TaxonomySourceID"),
        (F.col("o_orderkey") + 5000000).alias("SourceTaxonID"),
        _long(PROJECT).alias("SourceProjectID"),
        (1000000 + F.when(first, F.col("o_custkey")).otherwise(F.floor(F.col("o_custkey") / 3) * 3)).alias("SourceAcceptedTaxonID"),
        F.concat(F.lit("Syn"), F.col("o_orderkey").cast("string")).alias("taxon"),
        F.lit(None).cast("string").alias("author"),
        F.lit("species").alias("rank"),
    )


def staged_redlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem").select(
            (F.col("l_orderkey") % 2 + 1).alias("TaxonomySourceID"),
            (F.col("l_suppkey") * 3 + 1000000).alias("SourceTaxonID"),
            _long(PROJECT).alias("SourceProjectID"),
            F.lit("RL-Kategorie").alias("term"),
            F.concat("l_returnflag", "l_linestatus").alias("value"),
            F.lit(None).cast("string").alias("reference"),
        )
    )


def staged_common_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_customers = table(spark, sf_dir, "customer").count()
    return table(spark, sf_dir, "documents").select(
        _long(1).alias("TaxonomySourceID"),
        (F.col("doc_id") % n_customers + 1000000).alias("SourceTaxonID"),
        _long(PROJECT).alias("SourceProjectID"),
        F.col("text").alias("name"),
        F.col("lang").alias("code"),
        F.lit("customer").alias("db_name"),
    )


def winding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxa whose parents wind into cycles: one per customer, squared and folded back, and
    a second parent for those of one nation."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("k"), "c_nationkey")
    n = customers.agg(F.coalesce(F.max("k"), F.lit(1)).alias("n")).first()["n"]
    first = customers.select("k", (F.col("k") * F.col("k") + 1) % n + 1)
    second = customers.filter("c_nationkey = 0").select("k", (3 * F.col("k") + 2) % n + 1)
    one = F.lit(1).cast("long")
    return first.union(second).toDF(TAXON_ID, PARENT_ID).select(
        *(one.alias(c) for c in SCOPE), TAXON_ID, PARENT_ID
    )
