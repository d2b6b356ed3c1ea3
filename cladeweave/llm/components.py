"""Connected components of a graph given as a table of links.

Every round, each node hooks to its least neighbour if that is less than itself, the
pointers are followed, and the links are drawn anew between the nodes that they lead to.
Links within one node go. Least neighbours are partial sums, so a node with very many
links costs a row per task; the other joins have a unique key on one side and can be
split. Every round is a stored table; the driver sees one row count a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component), the least node reachable, for all nodes of ``links(a, b)``."""
    edges = materialize(links.select("a", "b").filter("a != b").distinct(), "links")
    found: DataFrame | None = None
    while edges.head(1):
        least = F.least("a", "b").alias("up")
        hooks = edges.select(F.explode(F.array("a", "b")).alias("node"), least).groupBy("node").agg(F.min("up").alias("up"))
        hooks = materialize(hooks, "hooks")
        above = lambda name: hooks.select(F.col("node").alias("up"), F.col("up").alias(name))
        jumped = hooks.join(above("up2"), "up").select("node", F.col("up2").alias("up"))
        jumped = jumped.join(above("up2"), "up").select("node", F.col("up2").alias("component"))
        jumped = materialize(jumped, "jumped")
        if found is None:
            found = jumped
        else:
            later = jumped.select(F.col("node").alias("component"), F.col("component").alias("_next"))
            found = found.join(later, "component", "left").select("node", F.coalesce("_next", "component").alias("component"))
            found = materialize(found, "components")
        for side in ("a", "b"):
            edges = edges.join(jumped.select(F.col("node").alias(side), F.col("component").alias("_c")), side)
            edges = edges.drop(side).withColumnRenamed("_c", side)
        edges = materialize(edges.filter("a != b").distinct(), "links")
    if found is None:
        found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found
