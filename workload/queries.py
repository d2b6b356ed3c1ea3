"""One query per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeweave import model
from cladeweave.functions import names, ranks
from cladeweave.operators import checks, doubles, hierarchy, ids, links, parents, repair
from cladeweave.operators.cycles import cycles
from cladeweave.operators.skew import dimension_join
from cladeweave.plans import full_run, merge
from cladeweave.runtime import BINARY, materialize, scratch_root
from cladeweave.sources import backbone, checklist, staging
from cladeweave.sources.publish import read_run

from . import fixtures as fx
from .stages import stages

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

P1, P2 = fx.PROJECTS
KEY = model.KEY
DB = fx.SPECIES_LIST_DB


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, name: str, by: list[str]) -> DataFrame:
    spark = df.sparkSession
    path = _new_path(spark, name)
    staging.write_table(df, path, by)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


# --- sources and sinks --------------------------------------------------------------


@query
def read_checklist(spark, sf_dir):
    path = _new_path(spark, "checklist")
    for name, df in stages(spark, sf_dir).checklist.items():
        df.write.parquet(f"{path}/{name}")
    spec = model.SourceSpec("first", DB, path, fx.PROJECTS)
    rows = [
        df.select(
            F.lit(name).alias("table"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in checklist.TABLES[name]]).alias("row"),
        )
        for name, df in checklist.read_checklist(spark, spec).items()
    ]
    return staging.union_sources(rows)


@query
def read_backbone(spark, sf_dir):
    path = _new_path(spark, "backbone")
    fx.backbone(spark, sf_dir).write.parquet(path)
    return backbone.read_backbone(spark, path)


def _extracted_taxa(spark, sf_dir) -> list[DataFrame]:
    t = stages(spark, sf_dir).checklist
    return [
        checklist.extract_taxa(t, 1, fx.PROJECTS),
        backbone.extract_backbone_taxa(fx.backbone(spark, sf_dir), 2),
    ]


@query
def union_sources(spark, sf_dir):
    return staging.stage_taxa(staging.union_sources(_extracted_taxa(spark, sf_dir)))


@query
def source_registry(spark, sf_dir):
    rows = fx.staged_taxa(spark, sf_dir).groupBy(model.SOURCE).agg(F.count(F.lit(1)).alias("n"))
    return staging.source_registry(spark, ["customers", "suppliers"]).join(rows, model.SOURCE, "left")


@query
def root_rows(spark, sf_dir):
    columns = [model.SOURCE, model.TAXON_ID, model.PARENT_ID, "taxon", "parent_taxon", "rank"]
    return model.root_rows(spark).select(*columns).unionByName(fx.staged_taxa(spark, sf_dir).select(*columns))


@query
def rank_dim(spark, sf_dir):
    used = stages(spark, sf_dir).taxa.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))
    dim = model.rank_dim(spark).withColumn("rank_code", F.col("rank_code").cast("long"))
    return dim.join(used, "rank", "left").select("rank", "rank_code", F.coalesce("n", F.lit(0)).alias("n"))


@query
def redlist_terms(spark, sf_dir):
    used = fx.staged_redlist(spark, sf_dir).groupBy("term", "value").agg(F.count(F.lit(1)).alias("n"))
    return model.redlist_terms(spark).join(used, "term", "left").select("id", "term", "category", "lang", "value", "n")


@query
def write_taxa(spark, sf_dir):
    taxa = stages(spark, sf_dir).taxa
    return _written(
        taxa.withColumn("rank_code", F.col("rank_code").cast("long")), "out-taxa", [model.SOURCE]
    )


@query
def write_synonyms(spark, sf_dir):
    return _written(staging.stage_synonyms(fx.staged_synonyms(spark, sf_dir)), "out-synonyms", [model.SOURCE])


@query
def write_common_names(spark, sf_dir):
    return _written(staging.stage_common_names(fx.staged_common_names(spark, sf_dir)), "out-names", [model.SOURCE])


@query
def write_redlist(spark, sf_dir):
    return _written(staging.stage_redlist(fx.staged_redlist(spark, sf_dir)), "out-redlist", [model.SOURCE])


@query
def write_closure(spark, sf_dir):
    return _written(hierarchy.closure(stages(spark, sf_dir).taxa), "out-closure", [model.SOURCE])


@query
def ordered_ids(spark, sf_dir):
    order = [model.SOURCE, model.TAXON_ID, model.PARENT_ID]
    return ids.ordered_ids(fx.staged_taxa(spark, sf_dir).select(*order), order, model.FIRST_FREE_ID)


@query
def origin_unique(spark, sf_dir):
    """Origin keys that repeat when the projects of a source are taken as one."""
    t = stages(spark, sf_dir).checklist
    found = []
    for dataset, df, other in (
        ("synonyms", checklist.extract_synonyms(t, 1, fx.PROJECTS), model.ACCEPTED_ID),
        ("taxa", checklist.extract_taxa(t, 1, fx.PROJECTS), model.PARENT_ID),
    ):
        repeated = ids.duplicates(df, [model.TAXON_ID, model.SOURCE, other])
        found.append(repeated.withColumnRenamed(other, "other").withColumn("dataset", F.lit(dataset)))
    return staging.union_sources(found)


@query
def constraint_violations(spark, sf_dir):
    """All rules on the rows of all four tables; common names before they are cut."""
    s = stages(spark, sf_dir)
    t, table = s.checklist, fx.backbone(spark, sf_dir)
    raw = checklist.tag_source(t["TaxonCommonName"], 1, P1, DB)
    rows = {
        "taxa": staging.stage_taxa(staging.union_sources(_extracted_taxa(spark, sf_dir))),
        "synonyms": staging.stage_synonyms(
            checklist.extract_synonyms(t, 1, fx.PROJECTS).unionByName(backbone.extract_backbone_synonyms(table, 2))
        ),
        "common_names": staging.stage_common_names(
            raw.withColumnsRenamed({"NameID": model.TAXON_ID, "LanguageCode": "Code"})
        ),
        "redlist": staging.stage_redlist(checklist.extract_redlist(t, 1, fx.PROJECTS, DB)),
    }
    return checks.all_violations(rows)


# --- projections ----------------------------------------------------------------------


def _names(spark, sf_dir) -> DataFrame:
    t = stages(spark, sf_dir).checklist
    return checklist.with_canonical_name(t["TaxonName"], t)


@query
def canonical_name(spark, sf_dir):
    return _names(spark, sf_dir).select("NameID", "canonicalName")


@query
def zoo_authorship(spark, sf_dir):
    return _names(spark, sf_dir).select("NameID", checklist.zoological().alias("authorship"))


@query
def botanical_authorship(spark, sf_dir):
    return _names(spark, sf_dir).select("NameID", checklist.botanical().alias("authorship"))


@query
def authorship(spark, sf_dir):
    return checklist.with_authorship(_names(spark, sf_dir)).select("NameID", "scientificNameAuthorShip")


@query
def parent_canonical_name(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    own = checklist.with_hierarchy(checklist.project_members(t, fx.PROJECTS), t, fx.PROJECTS)
    parent = {"canonicalName": "parentCanonicalName"}
    return checklist.with_parent_name(own, _names(spark, sf_dir), parent).select(
        "NameID", F.col("ProjectID").cast("long").alias("ProjectID"), "NameParentID", "parentCanonicalName"
    )


@query
def null_or_empty(spark, sf_dir):
    columns = ["BasionymAuthors", "CombiningAuthors", "SanctioningAuthor", "InfraspecificEpithet"]
    return stages(spark, sf_dir).checklist["TaxonName"].select("NameID", *[names.is_blank(F.col(c)).alias(c) for c in columns])


@query
def tag_source(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    return checklist.tag_source(t["TaxonCommonName"].select("NameID"), 1, P1, DB)


@query
def truncate_cast(spark, sf_dir):
    return stages(spark, sf_dir).checklist["TaxonCommonName"].select(
        "NameID",
        names.truncated(F.col("CommonName"), 255).alias("CommonName"),
        names.truncated(F.col("LanguageCode"), 2).alias("Code"),
    )


@query
def redlist_term(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    return dimension_join(
        t["TaxonNameListAnalysis"], t["TaxonNameListAnalysisCategory"], ["AnalysisID"], "inner", ["NameID", "ProjectID"]
    ).select(
        "NameID", F.col("ProjectID").cast("long").alias("ProjectID"), "AnalysisValue", names.redlist_term(F.col("DisplayText")).alias("Term")
    )


@query
def year_text(spark, sf_dir):
    return stages(spark, sf_dir).checklist["TaxonName"].select("NameID", names.year_text(F.col("YearOfPubl")).alias("year"))


@query
def rename_ranks(spark, sf_dir):
    return ranks.rename_ranks(fx.staged_taxa(spark, sf_dir), collation=BINARY).select(*KEY, "rank")


@query
def rank_codes(spark, sf_dir):
    coded = ranks.rank_codes(ranks.rename_ranks(fx.staged_taxa(spark, sf_dir), collation=BINARY), BINARY)
    return coded.select(*KEY, "rank", F.col("rank_code").cast("long").alias("rank_code"))


# --- filters ----------------------------------------------------------------------------


@query
def by_project(spark, sf_dir):
    return checklist.by_project(stages(spark, sf_dir).checklist["TaxonNameProject"], [P2]).select(
        "NameID", F.col("ProjectID").cast("long").alias("ProjectID")
    )


def _members(df: DataFrame) -> DataFrame:
    return df.select("NameID", F.col("ProjectID").cast("long").alias("ProjectID"))


@query
def accepted_only(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    return _members(checklist.accepted_only(checklist.project_members(t, fx.PROJECTS), t, fx.PROJECTS))


@query
def not_accepted(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    return _members(checklist.not_accepted(checklist.project_members(t, fx.PROJECTS), t, fx.PROJECTS))


@query
def backbone_accepted(spark, sf_dir):
    return backbone.backbone_accepted(fx.backbone(spark, sf_dir)).select("TaxonID", "canonicalName", "taxonomicStatus")


@query
def backbone_synonym(spark, sf_dir):
    return backbone.backbone_synonyms(fx.backbone(spark, sf_dir)).select("TaxonID", "acceptedNameUsageID")


@query
def has_accepted_id(spark, sf_dir):
    return backbone.has_accepted_id(fx.backbone(spark, sf_dir)).select("TaxonID", "acceptedNameUsageID")


@query
def redlist_properties(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    categories = t["TaxonNameListAnalysisCategory"]
    labelled = dimension_join(t["TaxonNameListAnalysis"], categories, ["AnalysisID"], "inner", ["NameID", "ProjectID"])
    return checklist.redlist_properties(labelled).select(
        "NameID", F.col("ProjectID").cast("long").alias("ProjectID"), "DisplayText", "AnalysisValue"
    )


@query
def redlist_projects(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    return checklist.redlist_projects(t["TaxonNameList"], DB).select(
        "NameID", F.col("ProjectID").cast("long").alias("ProjectID")
    )


@query
def rank_band(spark, sf_dir):
    return stages(spark, sf_dir).taxa.select("id", "rank", doubles.rank_band().alias("band"))


@query
def drop_parentless(spark, sf_dir):
    return doubles.with_band(stages(spark, sf_dir).taxa).select("id", "band", "parent_taxon")


# --- joins --------------------------------------------------------------------------------


@query
def name_project(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    return checklist.with_name(checklist.project_members(t, fx.PROJECTS), t["TaxonName"], ["ProjectID"]).select(
        "NameID", F.col("ProjectID").cast("long").alias("ProjectID"), "TaxonNameCache"
    )


@query
def name_hierarchy(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    placed = checklist.with_hierarchy(checklist.project_members(t, fx.PROJECTS), t, fx.PROJECTS)
    return placed.select("NameID", F.col("ProjectID").cast("long").alias("ProjectID"), "NameParentID")


@query
def parent_name(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    own = checklist.with_hierarchy(checklist.project_members(t, fx.PROJECTS), t, fx.PROJECTS)
    return checklist.with_parent_name(
        own, t["TaxonName"], {"GenusOrSupragenericName": "genus", "SpeciesEpithet": "species", "TaxonomicRank": "rank"}
    ).select("NameID", F.col("ProjectID").cast("long").alias("ProjectID"), "NameParentID", "genus", "species", "rank")


@query
def rank_lookup(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    return checklist.with_display_order(t["TaxonName"], t).select(
        "NameID", F.col("DisplayOrder").cast("long").alias("DisplayOrder")
    )


@query
def list_fanout(spark, sf_dir):
    """A name once per list that it stands on, whatever the list's project."""
    t = stages(spark, sf_dir).checklist
    named = checklist.with_name(checklist.project_members(t, fx.PROJECTS), t["TaxonName"], ["ProjectID"])
    return checklist.list_members(named, t).select(
        F.col("ListProjectID").cast("long").alias("ListProjectID"), F.col("ProjectID").cast("long").alias("ProjectID"), "NameID", "TaxonomicRank", "TaxonNameCache"
    )


@query
def synonym_target(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    own = checklist.not_accepted(checklist.project_members(t, fx.PROJECTS), t, fx.PROJECTS)
    return checklist.synonym_targets(own, t).select("NameID", F.col("ProjectID").cast("long").alias("ProjectID"), "SynNameID")


@query
def common_name_join(spark, sf_dir):
    return checklist.common_names(stages(spark, sf_dir).checklist, fx.PROJECTS).select(
        "NameID", F.col("ProjectID").cast("long").alias("ProjectID"), "CommonName", "LanguageCode"
    )


@query
def redlist_join(spark, sf_dir):
    return checklist.redlist_values(stages(spark, sf_dir).checklist, DB).select(
        "NameID", F.col("ProjectID").cast("long").alias("ProjectID"), "DisplayText", "AnalysisValue", "TaxonNameListRefText"
    )


@query
def closure_step(spark, sf_dir):
    s = stages(spark, sf_dir)
    return hierarchy.closure_step(s.closure, s.taxa).select(
        "AncestorID", "DescendantID", "PathLength", *model.SCOPE
    )


@query
def self_doubles(spark, sf_dir):
    return doubles.flag_doubles(stages(spark, sf_dir).banded, False, BINARY).select("id", "band", "is_double")


@query
def ancestor_family(spark, sf_dir):
    s = stages(spark, sf_dir)
    return hierarchy.ancestor_families(s.taxa, s.closure, BINARY).select(
        *model.SCOPE, "DescendantID", "PathLength", "family", "family_id"
    )


@query
def parent_by_key(spark, sf_dir):
    return parents.parent_same_source(stages(spark, sf_dir).survivors).select("id", "p1")


@query
def parent_by_name(spark, sf_dir):
    rows = stages(spark, sf_dir).survivors
    higher = parents.parent_any_family(rows, BINARY).select("id", "p3")
    return parents.parent_same_rank(rows, BINARY).select("id", "p4").join(higher, "id").select("id", "p3", "p4")


@query
def next_rank(spark, sf_dir):
    rows = stages(spark, sf_dir).linked.select("id", "rank_code")
    both = repair.next_rank(rows, repair.STEP).unionByName(repair.next_rank(rows, -repair.STEP))
    return both.select(
        "id", F.col("rank_code").cast("long").alias("rank_code"), F.col("new_code").cast("long").alias("new_code"), "new_rank"
    )


@query
def parent_child_probe(spark, sf_dir):
    return repair.same_rank_flags(stages(spark, sf_dir).linked).filter("state != 0").select(
        "id", "parent_id", F.col("state").cast("long").alias("state")
    )


@query
def orphans(spark, sf_dir):
    return hierarchy.orphans(stages(spark, sf_dir).repaired.filter("parent_id IS NOT NULL OR taxon = 'root'"), BINARY).select(
        "id", "taxon", "parent_id"
    )


@query
def link_by_key(spark, sf_dir):
    s = stages(spark, sf_dir)
    return links.link_by_key(s.synonyms, s.merged, model.ACCEPTED_ID).select(model.SOURCE, model.TAXON_ID, "by_key")


@query
def link_by_name(spark, sf_dir):
    s = stages(spark, sf_dir)
    return links.link_by_name(s.synonyms, s.merged, "accepted_taxon", collation=BINARY).select(
        model.SOURCE, model.TAXON_ID, "by_name"
    )


# --- aggregations -----------------------------------------------------------------------------


@query
def count_rows(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    sets = {
        "taxa": staging.union_sources(_extracted_taxa(spark, sf_dir)),
        "synonyms": staging.union_sources(
            [
                df.select(model.SOURCE)
                for df in (
                    checklist.extract_synonyms(t, 1, fx.PROJECTS),
                    backbone.extract_backbone_synonyms(fx.backbone(spark, sf_dir), 2),
                )
            ]
        ),
        "common_names": checklist.extract_common_names(t, 1, fx.PROJECTS, DB),
        "redlist": checklist.extract_redlist(t, 1, fx.PROJECTS, DB),
    }
    tagged = [df.select(F.lit(name).alias("dataset"), F.col(model.SOURCE)) for name, df in sets.items()]
    return staging.union_sources(tagged).groupBy("dataset", model.SOURCE).agg(F.count(F.lit(1)).alias("n"))


@query
def max_path_length(spark, sf_dir):
    return stages(spark, sf_dir).closure.agg(F.max("PathLength").alias("max_path_length"))


@query
def first_copy(spark, sf_dir):
    return doubles.first_copy(stages(spark, sf_dir).banded, BINARY)


@query
def closure_level_counts(spark, sf_dir):
    return stages(spark, sf_dir).closure.groupBy("PathLength").agg(F.count(F.lit(1)).alias("n"))


@query
def distinct_payload(spark, sf_dir):
    t = stages(spark, sf_dir).checklist
    cut = t["TaxonCommonName"].select(
        names.truncated(F.col("CommonName"), 255).alias("CommonName"), names.truncated(F.col("LanguageCode"), 2).alias("Code")
    )
    return cut.distinct()


@query
def count_orphans(spark, sf_dir):
    rows = stages(spark, sf_dir).repaired.filter("parent_id IS NOT NULL OR taxon = 'root'")
    return hierarchy.orphans(rows, BINARY).agg(F.count(F.lit(1)).alias("n"))


# --- hierarchy -----------------------------------------------------------------------------------


@query
def closure(spark, sf_dir):
    return hierarchy.closure(stages(spark, sf_dir).taxa).select("AncestorID", "DescendantID", "PathLength", *model.SCOPE)


@query
def depth(spark, sf_dir):
    return hierarchy.depth(stages(spark, sf_dir).closure).select(*KEY, "depth")


@query
def family_of(spark, sf_dir):
    return hierarchy.lineage(stages(spark, sf_dir).taxa, collation=BINARY).select(*KEY, "depth", "family")


@query
def prune_unconnected(spark, sf_dir):
    return hierarchy.prune_unconnected(stages(spark, sf_dir).repaired, BINARY).select("id", "taxon", "parent_id")


@query
def closure_after_merge(spark, sf_dir):
    return full_run.closure_after_merge(stages(spark, sf_dir).merged)


@query
def cycle_guard(spark, sf_dir):
    """Taxa that a closure limited to four steps would name in its error."""
    return hierarchy.too_deep(stages(spark, sf_dir).taxa, 4).select(*KEY)


@query
def cycle_members(spark, sf_dir):
    """The cycles of a graph with tails and forks over all customers."""
    return cycles(fx.winding(spark, sf_dir))


# --- merge -----------------------------------------------------------------------------------------


@query
def split_bands(spark, sf_dir):
    return doubles.with_band(stages(spark, sf_dir).taxa).groupBy("band", model.SOURCE).agg(F.count(F.lit(1)).alias("n"))


@query
def doubles_by_name(spark, sf_dir):
    rows = stages(spark, sf_dir).banded.filter(F.col("band") == doubles.FAMILY_BAND)
    return doubles.flag_doubles(rows, False, BINARY).filter("is_double").select("id", "taxon")


@query
def doubles_by_family(spark, sf_dir):
    rows = stages(spark, sf_dir).banded.filter((F.col("band") != doubles.FAMILY_BAND) & F.col("family").isNotNull())
    return doubles.flag_doubles(rows, True, BINARY).filter("is_double").select("id", "band", "taxon", "family")


@query
def doubles_without_family(spark, sf_dir):
    """Whole names, with copies that have no family."""
    rows = fx.familyless_copies(stages(spark, sf_dir).banded)
    return doubles.without_family(rows, BINARY).select("id", "band", "taxon")


@query
def pick_deepest(spark, sf_dir):
    return doubles.pick_winners(stages(spark, sf_dir).banded, BINARY).select("band", "id")


@query
def surviving_rows(spark, sf_dir):
    return doubles.surviving_ids(stages(spark, sf_dir).banded, BINARY)


@query
def family_cache(spark, sf_dir):
    s = stages(spark, sf_dir)
    return doubles.survivors(s.taxa, s.banded, BINARY).select("id", "familyCache")


@query
def merge_doubles(spark, sf_dir):
    s = stages(spark, sf_dir)
    return merge.merge_doubles(s.taxa, s.lineage, BINARY).select("id", *KEY, "taxon", "rank", "familyCache")


@query
def parent_same_source(spark, sf_dir):
    return parents.parent_same_source(stages(spark, sf_dir).survivors).filter("p1 IS NOT NULL").select("id", "p1")


@query
def parent_same_family(spark, sf_dir):
    return parents.parent_same_family(stages(spark, sf_dir).survivors, BINARY).filter("p2 IS NOT NULL").select("id", "p2")


@query
def parent_any_family(spark, sf_dir):
    return parents.parent_any_family(stages(spark, sf_dir).survivors, BINARY).filter("p3 IS NOT NULL").select("id", "p3")


@query
def parent_same_rank(spark, sf_dir):
    return parents.parent_same_rank(stages(spark, sf_dir).survivors, BINARY).filter("p4 IS NOT NULL").select("id", "p4")


@query
def link_parents(spark, sf_dir):
    return parents.link_parents(stages(spark, sf_dir).survivors, BINARY).select("id", "taxon", "parent_id")


@query
def same_rank_flags(spark, sf_dir):
    return repair.same_rank_flags(stages(spark, sf_dir).linked).select(
        "id",
        F.col("rank_code").cast("long").alias("rank_code"),
        F.col("parent_code").cast("long").alias("parent_code"),
        F.col("state").cast("long").alias("state"),
    )


def _moves(df: DataFrame) -> DataFrame:
    return df.select(
        "id", F.col("rank_code").cast("long").alias("rank_code"), F.col("new_code").cast("long").alias("new_code"), "new_rank"
    )


@query
def raise_rank(spark, sf_dir):
    return _moves(repair.raise_rank(stages(spark, sf_dir).flags))


@query
def lower_rank(spark, sf_dir):
    s = stages(spark, sf_dir)
    return _moves(repair.lower_rank(s.flags, s.linked, repair.raise_rank(s.flags)))


@query
def repair_ranks(spark, sf_dir):
    return repair.repair_ranks(stages(spark, sf_dir).linked).select(
        "id", "rank", F.col("rank_code").cast("long").alias("rank_code")
    )


@query
def merge_taxonomy(spark, sf_dir):
    merged = merge.merge_taxonomy(stages(spark, sf_dir).taxa, collation=BINARY)
    return merged.select(
        "id",
        *KEY,
        "taxon",
        "parent_taxon",
        "parent_id",
        "rank",
        F.col("rank_code").cast("long").alias("rank_code"),
        "familyCache",
        "author",
        "scientificName",
    )


@query
def merge_taxonomy_collated(spark, sf_dir):
    """The merge in the default collation, of names spelled with other case and accents."""
    plain = F.translate(F.lower("familyCache"), "äéöú", "aeou")
    return stages(spark, sf_dir).respelled_merged.select(
        "id",
        *KEY,
        "taxon",
        "parent_taxon",
        "parent_id",
        "rank",
        F.col("rank_code").cast("long").alias("rank_code"),
        plain.alias("family"),
    )


# --- links -------------------------------------------------------------------------------------------


@query
def synonym_accepted_name(spark, sf_dir):
    s = stages(spark, sf_dir)
    return links.prepare_synonyms(fx.staged_synonyms(spark, sf_dir), s.lineage).select(
        model.SOURCE, model.TAXON_ID, model.ACCEPTED_ID, "accepted_taxon"
    )


@query
def synonym_family(spark, sf_dir):
    s = stages(spark, sf_dir)
    return links.prepare_synonyms(fx.staged_synonyms(spark, sf_dir), s.lineage).select(
        model.SOURCE, model.TAXON_ID, model.ACCEPTED_ID, "familyCache"
    )


@query
def relink_synonyms(spark, sf_dir):
    s = stages(spark, sf_dir)
    return links.relink_synonyms(s.synonyms, s.merged, BINARY).select(model.SOURCE, model.TAXON_ID, "taxon", "syn_taxon_id")


@query
def relink_synonyms_collated(spark, sf_dir):
    s = stages(spark, sf_dir)
    noted = links.prepare_synonyms(s.staged_synonyms, s.respelled_lineage)
    found = links.relink_synonyms(materialize(noted, "respelled-synonyms"), s.respelled_merged)
    return found.select(model.SOURCE, model.TAXON_ID, "taxon", "accepted_taxon", "syn_taxon_id")


@query
def redlist_taxon_name(spark, sf_dir):
    s = stages(spark, sf_dir)
    return links.prepare_redlist(fx.staged_redlist(spark, sf_dir), s.lineage).select(*KEY, "value", "taxon")


@query
def redlist_family(spark, sf_dir):
    s = stages(spark, sf_dir)
    return links.prepare_redlist(fx.staged_redlist(spark, sf_dir), s.lineage).select(*KEY, "value", "familyCache")


@query
def relink_redlist(spark, sf_dir):
    s = stages(spark, sf_dir)
    return links.relink_redlist(s.redlist, s.merged, BINARY).select(*KEY, "term", "value", "taxon_id")


# --- extractions ----------------------------------------------------------------------------------------


@query
def extract_taxa(spark, sf_dir):
    return checklist.extract_taxa(stages(spark, sf_dir).checklist, 1, fx.PROJECTS)


@query
def extract_synonyms(spark, sf_dir):
    return checklist.extract_synonyms(stages(spark, sf_dir).checklist, 1, fx.PROJECTS)


@query
def extract_common_names(spark, sf_dir):
    return checklist.extract_common_names(stages(spark, sf_dir).checklist, 1, fx.PROJECTS, DB)


@query
def extract_redlist(spark, sf_dir):
    return checklist.extract_redlist(stages(spark, sf_dir).checklist, 1, fx.PROJECTS, DB)


@query
def extract_backbone_taxa(spark, sf_dir):
    return backbone.extract_backbone_taxa(fx.backbone(spark, sf_dir), 2)


@query
def extract_backbone_synonyms(spark, sf_dir):
    return backbone.extract_backbone_synonyms(fx.backbone(spark, sf_dir), 2)


# --- a whole run -------------------------------------------------------------------------------


def _full_run(spark, sf_dir) -> full_run.Merged:
    return stages(spark, sf_dir).full_run


@query
def full_run_taxa(spark, sf_dir):
    return _full_run(spark, sf_dir).taxa.select(
        "id", *KEY, model.PARENT_ID, "taxon", "author", "parent_taxon", "scientificName", "parent_id", "rank", "familyCache"
    )


@query
def full_run_synonyms(spark, sf_dir):
    return _full_run(spark, sf_dir).synonyms.select(*KEY, model.ACCEPTED_ID, "taxon", "author", "syn_taxon_id")


@query
def full_run_redlist(spark, sf_dir):
    return _full_run(spark, sf_dir).redlist.select(*KEY, "term", "value", "reference", "taxon_id")


@query
def write_run(spark, sf_dir):
    """All tables of the whole run published together and read back."""
    root = f"{scratch_root(spark)}/published-{uuid.uuid4().hex}"
    _full_run(spark, sf_dir).write(root)
    return reduce(
        DataFrame.unionByName,
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n") for name, df in read_run(spark, root).items()],
    )


@query
def full_run_common_names(spark, sf_dir):
    return _full_run(spark, sf_dir).common_names


@query
def backbone_accepted_collated(spark, sf_dir):
    """The backbone with the case of status and kingdom changed in some rows."""
    table = fx.backbone(spark, sf_dir)
    odd = F.col("TaxonID") % 2 == 1
    mixed = table.withColumns(
        {
            "taxonomicStatus": F.when(odd, F.upper("taxonomicStatus")).otherwise(F.col("taxonomicStatus")),
            "kingdom": F.when(odd, F.regexp_replace("kingdom", "a", "\u00e1")).otherwise(F.col("kingdom")),
        }
    )
    return backbone.backbone_accepted(mixed).select("TaxonID", "canonicalName")
