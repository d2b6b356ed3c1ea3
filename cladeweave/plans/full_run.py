"""A whole run: extraction of all sources, merge, links of the dependent rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import SCOPE, SOURCE, SYNONYM_ORIGIN, TAXA_ORIGIN, SourceSpec, rank_dim, redlist_terms
from ..operators.checks import all_violations
from ..operators.hierarchy import closure, lineage
from ..operators.ids import duplicates
from ..operators.links import prepare_redlist, prepare_synonyms, relink_redlist, relink_synonyms
from ..runtime import DEFAULT_COLLATION, materialize
from ..sources import backbone as bb
from ..sources import checklist as cl
from ..sources import staging as st
from ..sources.publish import publish
from .merge import merge_taxonomy


@dataclass(frozen=True)
class Backbone:
    """An optional flat taxonomy that comes after all checklists."""

    name: str
    location: str
    fmt: str = "parquet"


@dataclass
class Staged:
    sources: DataFrame
    taxa: DataFrame
    synonyms: DataFrame
    common_names: DataFrame
    redlist: DataFrame
    #: rows that the target tables would reject: dataset, origin, column, kind
    violations: DataFrame | None = None
    #: origin keys that occur more than once: dataset, key, n
    repeated: DataFrame | None = None


@dataclass
class Merged:
    sources: DataFrame
    taxa: DataFrame
    synonyms: DataFrame
    common_names: DataFrame
    redlist: DataFrame

    def write(self, path: str) -> int:
        """Publish all tables as the next run below ``path`` (see :mod:`..sources.publish`)."""
        spark = self.taxa.sparkSession
        tables = {
            "ranks": (rank_dim(spark), None),
            "redlist_terms": (redlist_terms(spark), None),
            "relations": (closure_after_merge(self.taxa), [SOURCE]),
            "sources": (self.sources, None),
            "taxa": (self.taxa, [SOURCE]),
            "synonyms": (self.synonyms, [SOURCE]),
            "common_names": (self.common_names, [SOURCE]),
            "redlist": (self.redlist, [SOURCE]),
        }
        return publish(spark, path, tables)


def extract_all(
    spark: SparkSession,
    specs: list[SourceSpec],
    backbone: Backbone | None = None,
    collation: str = DEFAULT_COLLATION,
) -> Staged:
    """Extract all sources in priority order and store the staged tables."""
    taxa, synonyms, common, red = [], [], [], []
    names = [s.name for s in specs] + ([backbone.name] if backbone else [])
    for source_id, spec in enumerate(specs, start=1):
        t = cl.read_checklist(spark, spec)
        texts = cl.name_texts(t, spec.project_ids)
        taxa.append(cl.extract_taxa(t, source_id, spec.project_ids, texts))
        synonyms.append(cl.extract_synonyms(t, source_id, spec.project_ids, texts))
        common.append(cl.extract_common_names(t, source_id, spec.project_ids, spec.dbname))
        red.append(cl.extract_redlist(t, source_id, spec.project_ids, spec.dbname, collation))
    if backbone:
        table = bb.read_backbone(spark, backbone.location, backbone.fmt)
        taxa.append(bb.extract_backbone_taxa(table, len(names), collation))
        synonyms.append(bb.extract_backbone_synonyms(table, len(names), collation))
    projects = {i: list(s.project_ids) for i, s in enumerate(specs, start=1)}
    all_taxa = materialize(st.stage_taxa(st.union_sources(taxa)), "staged-taxa")
    all_synonyms = materialize(st.union_sources(synonyms), "extracted-synonyms")
    tables = {
        "synonyms": materialize(st.stage_synonyms(all_synonyms), "synonyms"),
        "common_names": materialize(st.stage_common_names(st.union_sources(common)), "common-names"),
        "redlist": materialize(st.stage_redlist(st.union_sources(red)), "redlist"),
    }
    repeated = [
        duplicates(df, keys).select(F.lit(name).alias("dataset"), F.to_json(F.struct(*keys)).alias("key"), "n")
        for name, df, keys in (("taxa", all_taxa, TAXA_ORIGIN), ("synonyms", all_synonyms, SYNONYM_ORIGIN))
    ]
    return Staged(
        sources=st.source_registry(spark, names),
        taxa=st.number_taxa(all_taxa, projects, collation),
        violations=materialize(all_violations({"taxa": all_taxa, **tables}), "violations"),
        repeated=materialize(st.union_sources(repeated), "repeated"),
        **tables,
    )


def merge_all(
    staged: Staged, collation: str = DEFAULT_COLLATION, winner_scope: str = "taxon", max_depth: int | None = None
) -> Merged:
    """Merge the taxa and link the dependent rows.

    Names and families of the dependents are taken from the trees as they were
    before the merge.
    """
    line = lineage(staged.taxa, max_depth, collation)
    synonyms = materialize(prepare_synonyms(staged.synonyms, line), "synonyms")
    redlist = materialize(prepare_redlist(staged.redlist, line), "redlist")
    merged = materialize(merge_taxonomy(staged.taxa, line, collation, winner_scope, max_depth), "merged")
    return Merged(
        sources=staged.sources,
        taxa=merged,
        synonyms=relink_synonyms(synonyms, merged, collation),
        common_names=staged.common_names,
        redlist=relink_redlist(redlist, merged, collation),
    )


def closure_after_merge(merged: DataFrame, max_depth: int | None = None) -> DataFrame:
    """The closure rebuilt on the merged rows, as other applications may want it.

    It stays in source coordinates: paths lie inside one source and project.
    """
    return closure(merged, max_depth).select("AncestorID", "DescendantID", "PathLength", *SCOPE)
