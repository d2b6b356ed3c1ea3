"""The cycles of the source trees: which taxa lie on them, not merely below.

Taxa with one parent form chains, which pointer doubling follows in about log2(length)
rounds. A chain that never ends runs into a cycle of such taxa; what its pointers reach
after enough doublings is that cycle and nothing else. A chain that ends at a taxon with
several parents is one step between such taxa, and the strongly connected components of
these steps hold the other cycles: every round colours each taxon by the lowest one that
leads to it, keeps those that lead back, and goes on within the colours.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import KEY, PARENT_ID, SCOPE, TAXON_ID
from ..runtime import materialize, shuffled
from .skew import balanced_join

_UP = "_up"


def _parent_of() -> Column:
    return F.when(F.col(PARENT_ID) != F.col(TAXON_ID), F.col(PARENT_ID))


def _joined(left: DataFrame, right: DataFrame, at: str, how: str = "inner") -> DataFrame:
    """``left`` with the row of ``right`` whose taxon its column ``at`` names."""
    return balanced_join(left, right.withColumnRenamed(TAXON_ID, at), [*SCOPE, at], how, [TAXON_ID])


def _follow(single: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ends of the chains (key, top), and the taxa of chains without end (key, top), their
    pointers on the cycle."""
    known = single.select(*KEY, F.lit(True).alias("_more"))
    state = _joined(single, known, "top", "left").select(*KEY, "top", F.col("_more").isNull().alias("arrived"))
    done, moving, before = [], materialize(state, "chains"), None
    while True:
        done.append(moving.filter("arrived"))
        moving = moving.filter("NOT arrived")
        now = moving.agg(F.count(F.lit(1)), F.countDistinct(*SCOPE, "top")).first()
        # no chain ended and no taxon fell out of reach, so none ever will
        if not now[0] or now == before:
            return reduce(DataFrame.unionByName, done).drop("arrived"), moving.drop("arrived")
        before = now
        ahead = reduce(DataFrame.unionByName, [*done, moving]).select(
            *KEY, F.col("top").alias("_top"), F.col("arrived").alias("_arrived")
        )
        moved = _joined(moving.drop("arrived"), ahead, "top")
        moving = materialize(moved.select(*KEY, F.col("_top").alias("top"), F.col("_arrived").alias("arrived")), "chains")


def _rings(single: DataFrame, members: DataFrame) -> DataFrame:
    """(key, name) of the taxa of cycles without forks; the name is the lowest of them."""
    start = balanced_join(single, members, KEY, "left_semi", ["top"])
    ring = materialize(start.withColumn("name", F.col(TAXON_ID)), "rings")
    while True:
        ahead = ring.select(*KEY, F.col("top").alias("_top"), F.col("name").alias("_name"))
        low = F.least("name", "_name")
        longer = _joined(ring, ahead, "top").select(*KEY, F.col("_top").alias("top"), low.alias("name"), (low < F.col("name")).alias("_moved"))
        longer = materialize(longer, "rings")
        ring = longer.drop("_moved")
        # every taxon has the name of the one ahead, and so of all on its cycle
        if not longer.filter("_moved").limit(1).count():
            return ring.select(*KEY, "name")


def _colours(steps: DataFrame) -> DataFrame:
    """(key, colour): the lowest taxon from which steps lead to each."""
    ends = steps.select(*KEY).unionByName(steps.select(*SCOPE, F.col(_UP).alias(TAXON_ID))).distinct()
    found = materialize(ends.withColumn("colour", F.col(TAXON_ID)), "colours")
    while True:
        moved = balanced_join(steps, found, KEY, "inner", [_UP]).select(*SCOPE, F.col(_UP).alias(TAXON_ID), "colour")
        both = found.withColumn("_own", F.col("colour")).unionByName(moved, allowMissingColumns=True)
        lower = both.groupBy(*KEY).agg(F.min("colour").alias("colour"), F.max("_own").alias("_own"))
        lower = materialize(lower, "colours")
        found = lower.drop("_own")
        if not lower.filter("colour < _own").limit(1).count():
            return found


def strong_components(steps: DataFrame) -> DataFrame:
    """(key, name) of the taxa from which ``steps`` (key, _up) lead back to themselves."""
    found = [steps.select(*KEY, F.col(_UP).alias("name")).limit(0)]
    steps = materialize(steps.select(*KEY, _UP).distinct(), "steps")
    while steps.limit(1).count():
        colours = _colours(steps)
        inside = balanced_join(steps, colours, KEY, "inner", [_UP])
        inside = _joined(inside, colours.withColumnRenamed("colour", "_other"), _UP)
        inside = materialize(inside.filter("colour = _other").drop("_other"), "inside")
        back = materialize(inside.filter(F.col(_UP) == F.col("colour")).select(*KEY, "colour").distinct(), "back")
        size = back.count()
        while size:
            below = _joined(inside, back.select(*KEY), _UP, "left_semi").select(*KEY, "colour")
            back = materialize(back.unionByName(below).distinct(), "back")
            before, size = size, back.count()
            if size == before:
                break
        found.append(back.withColumnRenamed("colour", "name"))
        # a taxon that leads to all of its colour is done, as are those that lead back to it
        gone = back.select(*KEY).unionByName(inside.select(*SCOPE, F.col("colour").alias(TAXON_ID))).distinct()
        gone = materialize(gone, "gone")
        rest = balanced_join(inside.select(*KEY, _UP), gone, KEY, "left_anti", [_UP])
        steps = materialize(_trimmed(_joined(rest, gone, _UP, "left_anti")), "steps")
    return reduce(DataFrame.unionByName, found)


def _trimmed(steps: DataFrame) -> DataFrame:
    """Steps that another step goes on from and another one leads to."""
    on = _joined(steps, steps.select(*KEY).distinct(), _UP, "left_semi")
    return balanced_join(on, on.select(*SCOPE, F.col(_UP).alias(TAXON_ID)).distinct(), KEY, "left_semi", [_UP])


def _passed(pointers: DataFrame, marks: DataFrame) -> DataFrame:
    """(key, name) of all taxa that chains from ``marks`` pass, themselves included."""
    marks = materialize(marks.distinct(), "marks")
    pointers = materialize(_joined(pointers, pointers.select(*KEY), "top", "left_semi"), "pointers")
    while pointers.limit(1).count():
        pushed = balanced_join(pointers, marks, KEY, "inner", ["top"]).select(*SCOPE, F.col("top").alias(TAXON_ID), "name")
        marks = materialize(marks.unionByName(pushed).distinct(), "marks")
        ahead = pointers.select(*KEY, F.col("top").alias("_top"))
        pointers = materialize(_joined(pointers, ahead, "top").select(*KEY, F.col("_top").alias("top")), "pointers")
    return marks


def cycles(taxa: DataFrame) -> DataFrame:
    """(cycle, source, project, taxon id) of every taxon that is its own ancestor.

    Taxa that lead to each other share a ``cycle``, the lowest taxon id among them. A
    taxon given as its own parent counts as having none, parents that do not exist end
    a path, repeated rows count once.
    """
    rows = materialize(taxa.select(*KEY, _parent_of().alias(_UP)).distinct(), "edges")
    edges = _joined(rows.filter(F.col(_UP).isNotNull()), rows.select(*KEY).distinct(), _UP, "left_semi")
    edges = materialize(edges, "edges")
    fan = materialize(edges.groupBy(*KEY).agg(F.min(_UP).alias("top"), F.max(_UP).alias("_hi")), "fan")
    single = materialize(fan.filter("top = _hi").drop("_hi"), "single")
    forks = fan.filter("top < _hi").select(*KEY)

    ended, endless = _follow(single)
    ring = _rings(single, materialize(endless.select(*SCOPE, F.col("top").alias(TAXON_ID)).distinct(), "members"))

    # a step leads from a fork through one of its parents to the fork at the end of the chain
    ends = ended.unionByName(forks.withColumn("top", F.col(TAXON_ID)))
    ends = materialize(_joined(ends, forks, "top", "left_semi"), "ends")
    parents = balanced_join(edges, forks, KEY, "left_semi", [_UP])
    steps = materialize(_joined(parents, ends, _UP), "steps")
    core = materialize(strong_components(steps.select(*KEY, F.col("top").alias(_UP))), "core")
    own = balanced_join(steps, core, KEY, "inner", [_UP])
    both = _joined(own, core.withColumnRenamed("name", "_other"), "top").filter("name = _other")
    between = balanced_join(single, _joined(ends, core.select(*KEY), "top", "left_semi"), KEY, "left_semi", ["top"])
    passed = _passed(between, both.select(*SCOPE, F.col(_UP).alias(TAXON_ID), "name"))

    members = materialize(ring.unionByName(core).unionByName(passed).distinct(), "members")
    least = members.groupBy(*SCOPE, "name").agg(F.min(TAXON_ID).alias("cycle"))
    return members.join(shuffled(least), [*SCOPE, "name"]).select("cycle", *KEY)
