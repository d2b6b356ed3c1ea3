"""Which copy of a taxon survives.

Rows compete inside one of three rank bands. The copies of a name may be very many,
so nothing here collects or sorts them: counts and winners are aggregates, combined
before the shuffle, and rows are fetched by id at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import DEFAULT_COLLATION, is_root, materialize, shuffled
from .hierarchy import family_of
from .skew import balanced_join
from .spelling import key_of, rename_key

FAMILY_BAND, GENUS_BAND, SPECIES_BAND = "family", "genus", "species"

# Inclusive rank codes of the bands.
BANDS = {FAMILY_BAND: (340, 500), GENUS_BAND: (270, 330), SPECIES_BAND: (150, 260)}

# A winner is the lowest (depth descending, id): both in one number of 37 digits, which
# has room for every depth and id, so that the aggregation stays a hash aggregation.
_ID_DIGITS, _DEPTH_DIGITS = 19, 18


def _order(depth: Column, id_: Column) -> Column:
    rest = F.lit(10**_DEPTH_DIGITS - 1) - depth
    packed = F.concat(F.lpad(rest.cast("string"), _DEPTH_DIGITS, "0"), F.lpad(id_.cast("string"), _ID_DIGITS, "0"))
    return packed.cast("decimal(38,0)")


def _id_of(order: Column) -> Column:
    return (order % F.lit(str(10**_ID_DIGITS)).cast("decimal(20,0)")).cast("long")


def rank_band(code: Column | str = "rank_code") -> Column:
    """Name of the band a rank code lies in, null outside all bands."""
    code = F.col(code) if isinstance(code, str) else code
    band = F.lit(None).cast("string")
    for name, (low, high) in BANDS.items():
        band = F.when(code.between(low, high), F.lit(name)).otherwise(band)
    return band


def with_band(taxa: DataFrame) -> DataFrame:
    """Rows that take part in the merge: in a band and with a parent name."""
    return taxa.withColumn("band", rank_band()).filter(F.col("band").isNotNull() & F.col("parent_taxon").isNotNull())


def with_lineage(banded: DataFrame, lineage_df: DataFrame) -> DataFrame:
    """Add ``depth`` and ``family``; families and above have no family."""
    placed = family_of(banded, lineage_df)
    families = [c for c in placed.columns if c.endswith("family")]  # and its key column
    return placed.withColumns({c: F.when(F.col("band") != FAMILY_BAND, F.col(c)) for c in families})


def _groups(banded: DataFrame, collation: str) -> DataFrame:
    keyed = banded.select(
        "band",
        key_of(banded, "taxon", collation).alias("_taxon"),
        key_of(banded, "family", collation).alias("_family"),
        "id",
        F.when(F.col("depth") >= 1, _order(F.col("depth"), F.col("id"))).alias("_order"),
    )
    return keyed.groupBy("band", "_taxon", "_family").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.min("_order").alias("_order")
    )


def _comparable() -> Column:
    """Families and above compare by name alone, the others need a family."""
    return (F.col("band") == FAMILY_BAND) | F.col("_family").isNotNull()


def flag_doubles(banded: DataFrame, by_family: bool, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Add ``is_double``: another row of the band has the same name (and family)."""
    keys = ["band", "_taxon", "_family"] if by_family else ["band", "_taxon"]
    keyed = banded.withColumn("_taxon", key_of(banded, "taxon", collation))
    if by_family:
        keyed = keyed.withColumn("_family", key_of(banded, "family", collation))
    several = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return (
        balanced_join(keyed, several, keys, "left", ["id"])
        .withColumn("is_double", F.col("_n").isNotNull())
        .drop("_n", "_taxon", "_family")
    )


def without_family(banded: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Rows below family level that lose: no family, and the name occurs again."""
    lower = banded.filter(F.col("band") != FAMILY_BAND)
    keyed = lower.withColumn("_taxon", key_of(lower, "taxon", collation))
    several = keyed.groupBy("band", "_taxon").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return balanced_join(
        keyed.filter(F.col("family").isNull()), several, ["band", "_taxon"], "left_semi", ["id"]
    ).drop("_taxon")


def first_copy(banded: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Lowest id of every name in a band."""
    return banded.groupBy("band", key_of(banded, "taxon", collation).alias("_taxon")).agg(
        F.min("id").alias("id"), F.min("taxon").alias("taxon")
    ).select("band", "taxon", "id")


def _winners(groups: DataFrame, keys: list[str]) -> DataFrame:
    return (
        groups.filter(_comparable() & (F.col("n") > 1))
        .groupBy(*keys)
        .agg(F.min("_order").alias("_order"))
        .filter(F.col("_order").isNotNull())
        .select("band", _id_of(F.col("_order")).alias("id"))
    )


_WINNER_KEYS = {"taxon": ["band", "_taxon"], "taxon_family": ["band", "_taxon", "_family"]}


def pick_winners(
    banded: DataFrame, collation: str = DEFAULT_COLLATION, winner_scope: str = "taxon"
) -> DataFrame:
    """Ids of the copies that win: the deepest, then the lowest id.

    Copies are rows with the same name and family, but one winner is taken per
    name; ``winner_scope="taxon_family"`` takes one per name and family. Copies of
    depth 0 never win.
    """
    return _winners(_groups(banded, collation), _WINNER_KEYS[winner_scope])


def surviving_ids(
    banded: DataFrame, collation: str = DEFAULT_COLLATION, winner_scope: str = "taxon"
) -> DataFrame:
    """Ids of all rows that stay: rows without double, and the winners.

    The rows are reduced to one per name and family once, and that table is stored;
    the three kinds of survivors are found on it.
    """
    groups = materialize(_groups(banded, collation), "groups")
    singles = groups.filter(_comparable() & (F.col("n") == 1)).select(F.col("first_id").alias("id"))
    unplaced = (
        groups.groupBy("band", "_taxon")
        .agg(F.sum("n").alias("n"), F.min(F.when(~_comparable(), F.col("first_id"))).alias("id"))
        .filter((F.col("n") == 1) & F.col("id").isNotNull())
        .select("id")
    )
    winners = _winners(groups, _WINNER_KEYS[winner_scope]).select("id")
    return singles.unionByName(unplaced).unionByName(winners)


def survivors(
    taxa: DataFrame, banded: DataFrame, collation: str = DEFAULT_COLLATION, winner_scope: str = "taxon"
) -> DataFrame:
    """Surviving rows with ``familyCache``, and the roots.

    ``banded`` is the output of :func:`with_lineage` on ``taxa``.
    """
    kept = banded.join(shuffled(surviving_ids(banded, collation, winner_scope)), "id", "left_semi").filter(~is_root(collation))
    kept = rename_key(kept.withColumnRenamed("family", "familyCache"), "family", "familyCache")
    added = [c for c in kept.columns if c.endswith("familyCache")]
    roots = taxa.filter(is_root(collation)).withColumns({c: F.lit(None).cast("string") for c in added})
    return kept.select(*taxa.columns, *added).unionByName(roots)
