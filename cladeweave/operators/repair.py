"""Repair of chains in which a child has the rank of its parent.

A row that has a child of its own rank moves one rank up, a row that has the rank
of its parent moves one rank down, if the vocabulary has that rank and it still
lies between parent and child. A row that is both stays. Only ranks between the
bounds below move. This is done in two rounds; within a round, moving down sees
the ranks already moved up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import rank_dim
from ..runtime import materialize, shuffled
from .skew import balanced_join, dimension_join

# Only codes strictly between these move, by one step.
LOWEST, HIGHEST, STEP = 280, 490, 10

SAME_AS_CHILD, SAME_AS_BOTH, SAME_AS_PARENT = 1, 3, 5


def same_rank_flags(tree: DataFrame) -> DataFrame:
    """(id, parent_id, rank_code, parent_code, state) of every row.

    ``state`` is 0, or 1 for the rank of a child, 5 for the rank of the parent, 3
    for both.
    """
    codes = tree.select(F.col("id").alias("parent_id"), F.col("rank_code").alias("parent_code"))
    linked = balanced_join(tree.select("id", "parent_id", "rank_code"), codes, ["parent_id"], "left", ["id"])
    as_parent = F.coalesce(F.col("rank_code") == F.col("parent_code"), F.lit(False))
    with_child = (
        linked.filter(as_parent).select(F.col("parent_id").alias("id")).distinct().withColumn("_child", F.lit(True))
    )
    as_child = F.col("_child").isNotNull()
    state = (
        F.when(as_parent & as_child, SAME_AS_BOTH).when(as_child, SAME_AS_CHILD).when(as_parent, SAME_AS_PARENT).otherwise(0)
    )
    return linked.join(shuffled(with_child), "id", "left").withColumn("state", state).drop("_child")


def _movable() -> Column:
    return (F.col("rank_code") > LOWEST) & (F.col("rank_code") < HIGHEST)


def next_rank(rows: DataFrame, step: int) -> DataFrame:
    """Add ``new_rank`` and ``new_code``, ``step`` away; rows without such a rank go."""
    dim = rank_dim(rows.sparkSession).select(F.col("rank").alias("new_rank"), F.col("rank_code").alias("new_code"))
    return rows.withColumn("new_code", F.col("rank_code") + step).join(F.broadcast(dim), "new_code")


def raise_rank(flags: DataFrame) -> DataFrame:
    """(id, rank_code, new_code, new_rank) of the rows that move up."""
    rows = next_rank(flags.filter((F.col("state") == SAME_AS_CHILD) & _movable()), STEP)
    return rows.filter(F.col("new_code") < F.col("parent_code")).select("id", "rank_code", "new_code", "new_rank")


def lower_rank(flags: DataFrame, tree: DataFrame, raised: DataFrame) -> DataFrame:
    """(id, rank_code, new_code, new_rank) of the rows that move down.

    One child of lower rank is enough, at its rank after ``raised``.
    """
    rows = next_rank(flags.filter((F.col("state") == SAME_AS_PARENT) & _movable()), -STEP)
    children = dimension_join(
        tree.select("id", "parent_id", "rank_code"), rows.select(F.col("id").alias("parent_id")), ["parent_id"], "left_semi", ["id"]
    )
    lowest = (
        children.join(shuffled(raised.select("id", "new_code")), "id", "left")
        .groupBy(F.col("parent_id").alias("id"))
        .agg(F.min(F.coalesce("new_code", "rank_code")).alias("child_code"))
    )
    return (
        rows.join(shuffled(lowest), "id")
        .filter(F.col("new_code") > F.col("child_code"))
        .select("id", "rank_code", "new_code", "new_rank")
    )


def repair_round(tree: DataFrame) -> DataFrame:
    flags = materialize(same_rank_flags(tree).filter("state != 0"), "same-rank")
    raised = raise_rank(flags)
    # stored, so that its true size is known when the join with the tree is planned
    moved = materialize(raised.unionByName(lower_rank(flags, tree, raised)).drop("rank_code"), "moved")
    columns = [c for c in tree.columns if c not in ("rank", "rank_code")]
    return dimension_join(tree, moved, ["id"], "left", ["id"]).select(
        *columns,
        F.coalesce("new_rank", "rank").alias("rank"),
        F.coalesce("new_code", "rank_code").alias("rank_code"),
    )


def repair_ranks(tree: DataFrame, rounds: int = 2) -> DataFrame:
    for _ in range(rounds):
        tree = materialize(repair_round(tree), "repaired")
    return tree
