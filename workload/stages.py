"""Stored intermediate results that several queries start from.

A stage is computed on first use and kept for the session, as a table in the
shared folder.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cladeweave.model import SourceSpec
from cladeweave.operators import doubles, hierarchy, links, parents, repair
from cladeweave.plans import full_run, merge
from cladeweave.runtime import BINARY, materialize, scratch_root
from cladeweave.sources import staging

from . import fixtures

_known: dict[tuple[str, str], "Stages"] = {}


def stages(spark: SparkSession, sf_dir: str) -> "Stages":
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _known:
        _known[key] = Stages(spark, sf_dir)
    return _known[key]


class Stages:
    """The merge step by step; names compare byte by byte, as in the SQL."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def checklist(self) -> dict[str, DataFrame]:
        return fixtures.checklist(self.spark, self.sf_dir)

    @cached_property
    def full_run(self) -> full_run.Merged:
        """Extraction from stored source tables, merge and links."""
        root = f"{scratch_root(self.spark)}/sources-{uuid.uuid4().hex}"
        for name, df in self.checklist.items():
            df.write.parquet(f"{root}/checklist/{name}")
        fixtures.backbone(self.spark, self.sf_dir).write.parquet(f"{root}/backbone")
        specs = [
            SourceSpec(name, fixtures.SPECIES_LIST_DB, f"{root}/checklist", projects)
            for name, projects in (("checklist", fixtures.PROJECTS), ("second", fixtures.PROJECTS[1:]))
        ]
        backbone = full_run.Backbone("backbone", f"{root}/backbone")
        return full_run.merge_all(full_run.extract_all(self.spark, specs, backbone, BINARY), BINARY)

    @cached_property
    def taxa(self) -> DataFrame:
        return materialize(
            staging.number_taxa(fixtures.staged_taxa(self.spark, self.sf_dir), collation=BINARY), "taxa"
        )

    @cached_property
    def closure(self) -> DataFrame:
        return materialize(hierarchy.closure(self.taxa), "closure")

    @cached_property
    def lineage(self) -> DataFrame:
        return hierarchy.lineage(self.taxa, collation=BINARY)

    @cached_property
    def banded(self) -> DataFrame:
        return materialize(doubles.with_lineage(doubles.with_band(self.taxa), self.lineage), "banded")

    @cached_property
    def survivors(self) -> DataFrame:
        return materialize(doubles.survivors(self.taxa, self.banded, BINARY), "survivors")

    @cached_property
    def linked(self) -> DataFrame:
        return materialize(parents.link_parents(self.survivors, BINARY), "linked")

    @cached_property
    def flags(self) -> DataFrame:
        return materialize(repair.same_rank_flags(self.linked), "flags")

    @cached_property
    def repaired(self) -> DataFrame:
        return repair.repair_ranks(self.linked)

    @cached_property
    def merged(self) -> DataFrame:
        return materialize(merge.merge_taxonomy(self.taxa, self.lineage, BINARY), "merged")

    @cached_property
    def respelled(self) -> DataFrame:
        """As ``taxa``, with names that differ in case and accents."""
        staged = fixtures.respelled(fixtures.staged_taxa(self.spark, self.sf_dir))
        return materialize(staging.number_taxa(staged), "respelled")

    @cached_property
    def respelled_lineage(self) -> DataFrame:
        return hierarchy.lineage(self.respelled)

    @cached_property
    def respelled_merged(self) -> DataFrame:
        return materialize(merge.merge_taxonomy(self.respelled, self.respelled_lineage), "respelled-merged")

    @cached_property
    def synonyms(self) -> DataFrame:
        return materialize(links.prepare_synonyms(self.staged_synonyms, self.lineage), "synonyms")

    @cached_property
    def staged_synonyms(self) -> DataFrame:
        return materialize(fixtures.staged_synonyms(self.spark, self.sf_dir), "synonyms")

    @cached_property
    def redlist(self) -> DataFrame:
        staged = materialize(fixtures.staged_redlist(self.spark, self.sf_dir), "redlist")
        return materialize(links.prepare_redlist(staged, self.lineage), "redlist")
