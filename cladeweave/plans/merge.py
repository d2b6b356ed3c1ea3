"""The merge of several source trees into one."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..model import KEY
from ..operators.doubles import survivors, with_band, with_lineage
from ..operators.hierarchy import lineage, prune_unconnected
from ..operators.parents import link_parents
from ..operators.repair import repair_ranks
from ..operators.skew import at_most
from ..operators.spelling import Spelling, without_keys
from ..runtime import DEFAULT_COLLATION, materialize, shuffled

# long texts that no step of the merge looks at join in at the end
_TEXTS = ["author", "scientificName"]


def merge_doubles(
    taxa: DataFrame, lineage_df: DataFrame, collation: str = DEFAULT_COLLATION, winner_scope: str = "taxon"
) -> DataFrame:
    """One row per taxon: the deepest copy, then the one of the first source."""
    banded = materialize(with_lineage(with_band(taxa), lineage_df), "banded")
    return materialize(survivors(taxa, banded, collation, winner_scope), "survivors")


def merge_taxonomy(
    taxa: DataFrame,
    lineage_df: DataFrame | None = None,
    collation: str = DEFAULT_COLLATION,
    winner_scope: str = "taxon",
    max_depth: int | None = None,
) -> DataFrame:
    """Merge numbered taxa into one tree.

    ``taxa`` should be a stored table, it is read several times. ``lineage_df`` can be
    given if it is already there. Names that differ only for the eye of ``collation`` get
    the same key once, at the beginning; nothing after compares under it.
    """
    slim = taxa.drop(*_TEXTS)
    with at_most(taxa.count()):
        if lineage_df is None:
            lineage_df = lineage(slim, max_depth, collation)
        spelling = Spelling(collation, (slim, "taxon"), (slim, "parent_taxon"))
        slim = spelling.with_keys(slim, ["taxon", "parent_taxon"], ["id"])
        lineage_df = spelling.with_keys(lineage_df, ["family"], KEY)
        kept = merge_doubles(slim, lineage_df, collation, winner_scope)
        linked = materialize(link_parents(kept, collation), "linked")
        tree = prune_unconnected(repair_ranks(linked), collation)
    return without_keys(tree).join(shuffled(taxa.select("id", *_TEXTS)), "id")
