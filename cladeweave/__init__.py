"""Merging of biological taxonomies as Spark jobs."""

from .model import SourceSpec
from .plans.full_run import Backbone, Merged, Staged, extract_all, merge_all
from .plans.merge import merge_taxonomy
from .sources.publish import read_run

__all__ = ["Backbone", "Merged", "SourceSpec", "Staged", "extract_all", "merge_all", "merge_taxonomy", "read_run"]
