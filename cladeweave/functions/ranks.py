"""Rank labels and codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import FAMILY_RANK, RANK_RENAMES, rank_dim
from ..runtime import DEFAULT_COLLATION, name_key


def rename_ranks(df: DataFrame, mapping: dict[str, str] | None = None, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Replace long rank labels by their abbreviations; other labels stay."""
    mapping = RANK_RENAMES if mapping is None else mapping
    renamed = F.col("rank")
    for label, short in mapping.items():
        renamed = F.when(name_key("rank", collation) == name_key(F.lit(label), collation), F.lit(short)).otherwise(renamed)
    return df.withColumn("rank", renamed)


def rank_codes(df: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Add ``rank_code`` from the vocabulary, 0 for a label it does not have."""
    dim = rank_dim(df.sparkSession).select(name_key("rank", collation).alias("_rank"), "rank_code")
    return (
        df.withColumn("_rank", name_key("rank", collation))
        .join(F.broadcast(dim), "_rank", "left")
        .withColumn("rank_code", F.coalesce("rank_code", F.lit(0)))
        .drop("_rank")
    )


def normalize_ranks(df: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Abbreviated labels with their codes.

    A label that equals the family label only under ``collation`` is written like it.
    """
    return rank_codes(rename_ranks(df, {**RANK_RENAMES, FAMILY_RANK: FAMILY_RANK}, collation), collation)
