"""Ancestor relations of the source trees: closure, depth, family, pruning.

A tree is given by staged rows (source, project, taxon id, parent id). Most taxa
are leaves, so the iterative part runs on inner nodes only (those that are some
row's parent) and doubles the covered distance each round: a tree of depth d takes
about log2(d) joins on the small inner table, then the leaves follow in one join.
Each round ends in a stored table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import FAMILY_RANK, KEY, PARENT_ID, SCOPE, TAXON_ID
from ..runtime import DEFAULT_COLLATION, is_root, materialize, same_name, shuffled, store
from .cycles import cycles
from .skew import balanced_join, dimension_join

_UP = "_up"


class HierarchyError(ValueError):
    """A path runs into a cycle or is longer than allowed.

    ``path`` is a stored table of all (source, project, taxon) from which one starts,
    ``cycles`` one of the taxa on cycles, as :func:`cycles` gives it, if there are any.
    """

    def __init__(self, message: str, path: str, cycles: str | None = None):
        super().__init__(message)
        self.path = path
        self.cycles = cycles


def _fail(keys: DataFrame, reason: str) -> None:
    path = store(keys.select(*KEY).distinct(), "bad-paths")
    shown = [tuple(r) for r in keys.sparkSession.read.parquet(path).limit(20).collect()]
    raise HierarchyError(f"{reason}; all taxa concerned are in {path}, among them {shown}", path)


def _fail_cycle(keys: DataFrame, taxa: DataFrame) -> None:
    path = store(keys.select(*KEY).distinct(), "bad-paths")
    members = store(cycles(taxa), "cycles")
    shown = [tuple(r) for r in taxa.sparkSession.read.parquet(members).select(*KEY).limit(20).collect()]
    raise HierarchyError(
        f"path runs into a cycle; the taxa of cycles are in {members}, among them {shown}, all that lead to one in {path}",
        path,
        members,
    )


def _fail_beyond(keys: DataFrame, max_depth: int) -> None:
    _fail(keys, f"path longer than {max_depth}")


def _parent_of() -> Column:
    """The parent id; a taxon that is its own parent counts as having none."""
    return F.when(F.col(PARENT_ID) != F.col(TAXON_ID), F.col(PARENT_ID))


# Numbers of ways saturate here: on a cycle they grow without bound until the lack of
# progress ends the loop. A saturated number in the result is an error.
_MANY = (1 << 63) - 1
# Ways are expanded in two steps of at most so many rows from one.
_WAYS = 1 << 20


def _times(a: str, b: str) -> Column:
    return F.coalesce(F.try_multiply(F.col(a), F.col(b)), F.lit(_MANY))


def _is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


# --- closure -----------------------------------------------------------------


def closure_step(frontier: DataFrame, taxa: DataFrame) -> DataFrame:
    """Extend every path of ``frontier`` by one step towards the root."""
    up = taxa.select(*KEY, _parent_of().alias(_UP)).filter(F.col(_UP).isNotNull())
    parents = taxa.select(*SCOPE, F.col(TAXON_ID).alias(_UP))
    steps = materialize(balanced_join(up, parents, [*SCOPE, _UP], "inner", [TAXON_ID]), "steps")
    return balanced_join(
        frontier, steps.withColumnRenamed(TAXON_ID, "AncestorID"), [*SCOPE, "AncestorID"], "inner", ["DescendantID"]
    ).select(F.col(_UP).alias("AncestorID"), "DescendantID", (F.col("PathLength") + 1).alias("PathLength"), *SCOPE)


def closure(taxa: DataFrame, max_depth: int | None = None) -> DataFrame:
    """All (AncestorID, DescendantID, PathLength) per source and project.

    A bag: a taxon that occurs in several rows, or reaches an ancestor in several
    ways, appears once per way. Parents missing from the same source and project
    end a path. Raises :class:`HierarchyError` on a cycle, and beyond ``max_depth``
    where one is given.
    """
    rows = taxa.select(*KEY, _parent_of().alias(_UP))
    copies = materialize(rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies")), "keys")
    repeated = not _is_empty(copies.filter("copies > 1"))

    # one step up from every taxon; n counts the ways
    edges = rows.filter(F.col(_UP).isNotNull())
    if repeated:
        ways = edges.groupBy(*KEY, _UP).agg(F.count(F.lit(1)).alias("ways"))
        steps = balanced_join(ways, copies, KEY, "inner", [_UP]).select(
            *KEY, _UP, _times("ways", "copies").alias("n")
        )
    else:
        steps = edges.withColumn("n", F.lit(1).cast("long"))
    steps = materialize(steps, "steps")

    parents = steps.select(*SCOPE, F.col(_UP).alias(TAXON_ID)).distinct()
    inner = materialize(copies.join(shuffled(parents), KEY, "left_semi"), "inner")
    up_exists = inner.select(*SCOPE, F.col(TAXON_ID).alias(_UP))
    jump = materialize(
        balanced_join(
            dimension_join(steps, inner.select(*KEY), KEY, "left_semi", [_UP]),
            up_exists,
            [*SCOPE, _UP],
            "inner",
            [TAXON_ID],
            hot_in=steps,
        ),
        "jump",
    )
    # paths of inner nodes, starting with themselves
    reach = inner.select(
        *KEY, F.col(TAXON_ID).alias("AncestorID"), F.lit(0).cast("long").alias("PathLength"), F.col("copies").alias("n")
    )
    covered, before = 1, None
    while left := jump.select(*KEY).distinct().count():
        if max_depth is not None and covered > max_depth:
            _fail_beyond(jump, max_depth)
        if left == before:
            # a path of twice the length has all shorter ones along it, so taxa drop out
            # in every round as long as some path ends
            _fail_cycle(jump, taxa)
        before = left
        longer = balanced_join(
            jump.withColumnRenamed("n", "n0"),
            reach.withColumnRenamed(TAXON_ID, _UP),
            [*SCOPE, _UP],
            "inner",
            [TAXON_ID],
        ).select(
            *KEY, "AncestorID", (F.col("PathLength") + covered).alias("PathLength"), _times("n0", "n").alias("n")
        )
        next_jump = balanced_join(
            jump.withColumnRenamed("n", "n0"),
            jump.select(*SCOPE, F.col(TAXON_ID).alias(_UP), F.col(_UP).alias("_next"), "n"),
            [*SCOPE, _UP],
            "inner",
            [TAXON_ID],
        ).select(*KEY, F.col("_next").alias(_UP), _times("n0", "n").alias("n"))
        if repeated:
            longer = longer.groupBy(*KEY, "AncestorID", "PathLength").agg(F.coalesce(F.try_sum("n"), F.lit(_MANY)).alias("n"))
            next_jump = next_jump.groupBy(*KEY, _UP).agg(F.coalesce(F.try_sum("n"), F.lit(_MANY)).alias("n"))
        reach = reach.unionByName(materialize(longer, "reach"))
        jump = materialize(next_jump, "jump")
        covered *= 2
    if max_depth is not None:
        too_long = reach.filter(F.col("PathLength") + 1 > max_depth)
        if not _is_empty(too_long):
            _fail_beyond(too_long, max_depth)

    itself = rows.select(
        F.col(TAXON_ID).alias("AncestorID"),
        F.col(TAXON_ID).alias("DescendantID"),
        F.lit(0).cast("long").alias("PathLength"),
        *SCOPE,
    )
    above = balanced_join(
        steps.withColumnRenamed("n", "n0"),
        reach.withColumnRenamed(TAXON_ID, _UP),
        [*SCOPE, _UP],
        "inner",
        [TAXON_ID],
    ).select(
        "AncestorID",
        F.col(TAXON_ID).alias("DescendantID"),
        (F.col("PathLength") + 1).alias("PathLength"),
        *SCOPE,
        _times("n0", "n").alias("n"),
    )
    if repeated:
        above = _repeated(above)
    return itself.unionByName(above.drop("n"))


def _repeated(above: DataFrame) -> DataFrame:
    """Every row ``n`` times; no array has more than ``_WAYS`` entries below 2^40 ways."""
    one, most = F.lit(1).cast("long"), F.lit(_WAYS).cast("long")
    bounded = F.when(F.col("n") < _MANY, F.col("n")).otherwise(F.raise_error("too many ways between two taxa").cast("long"))
    counted = above.withColumn("n", bounded)
    parts = counted.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / most))))
    rest = F.least(most, F.col("n") - F.col("_part") * most)
    return parts.withColumn("_copy", F.explode(F.sequence(one, rest))).drop("_part", "_copy")


def depth(closure_df: DataFrame) -> DataFrame:
    """Longest path of every taxon, from its closure."""
    return closure_df.groupBy(*SCOPE, F.col("DescendantID").alias(TAXON_ID)).agg(F.max("PathLength").alias("depth"))


def ancestor_families(taxa: DataFrame, closure_df: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Every ancestor of rank family, itself included, of every taxon."""
    families = taxa.filter(same_name("rank", F.lit(FAMILY_RANK), collation)).select(
        *SCOPE, F.col(TAXON_ID).alias("AncestorID"), F.col("taxon").alias("family"), F.col("id").alias("family_id")
    )
    return balanced_join(closure_df, families, [*SCOPE, "AncestorID"], "inner", ["DescendantID", "PathLength"])


def too_deep(taxa: DataFrame, max_depth: int) -> DataFrame:
    """Taxa from which a path longer than ``max_depth`` starts, for error reports.

    Taxa on or below a cycle are among them. Takes ``max_depth`` + 1 rounds, or fewer
    when no path is left.
    """
    rows = materialize(taxa.select(*KEY, _parent_of().alias(_UP)).distinct(), "edges")
    keys = rows.select(*KEY).distinct()
    edges = materialize(
        balanced_join(
            rows.filter(F.col(_UP).isNotNull()),
            keys.withColumnRenamed(TAXON_ID, _UP),
            [*SCOPE, _UP],
            "left_semi",
            [TAXON_ID],
        ),
        "edges",
    )
    # taxa with a path of at least `length` steps
    reaching = keys
    for _ in range(max_depth + 1):
        reaching = materialize(
            balanced_join(edges, reaching.withColumnRenamed(TAXON_ID, _UP), [*SCOPE, _UP], "left_semi", [TAXON_ID])
            .select(*KEY)
            .distinct(),
            "reaching",
        )
        if _is_empty(reaching):
            break
    return reaching


# --- depth and family without the closure ---------------------------------------


def climb(state: DataFrame, scope: list[str], node: str) -> tuple[DataFrame, int]:
    """Move every node's pointer up to the end of its chain by pointer doubling.

    ``state`` has one row per node: ``scope``, ``node``, ``top`` (a node),
    ``dist`` (steps to it), ``arrived`` (the pointer will not move any more) and
    ``gain`` (struct<dist,id,name>, the nearest family met so far, or null).
    Returns the final state and the number of nodes that never arrive because
    their chain runs into a cycle.
    """
    pending = state.filter(~F.col("arrived")).count()
    done: list[DataFrame] = [state.filter("arrived")]
    moving = state.filter(~F.col("arrived"))
    while pending:
        # a pointer leads to a node that has arrived before, or to one that moves as well
        ahead = reduce(DataFrame.unionByName, [*done, moving]).select(
            *scope,
            F.col(node).alias("top"),
            F.col("top").alias("_top"),
            F.col("dist").alias("_dist"),
            F.col("arrived").alias("_arrived"),
            F.col("gain").alias("_gain"),
        )
        moved = balanced_join(moving.drop("arrived"), ahead, [*scope, "top"], "inner", [node]).select(
            *scope,
            node,
            F.col("_top").alias("top"),
            (F.col("dist") + F.col("_dist")).alias("dist"),
            F.col("_arrived").alias("arrived"),
            F.coalesce("gain", _shift("_gain", F.col("dist"))).alias("gain"),
        )
        moved = materialize(moved, "climb")
        done.append(moved.filter("arrived"))
        moving = moved.filter(~F.col("arrived"))
        left = moving.count()
        if left == pending:
            # chains of every length have shorter ones inside, so no progress means cycles
            break
        pending = left
    return reduce(DataFrame.unionByName, [*done, moving]), pending


def _shift(gain: str, steps: Column) -> Column:
    """``gain`` seen from ``steps`` further below."""
    return F.when(
        F.col(gain).isNotNull(),
        F.struct(
            (F.col(f"{gain}.dist") + steps).alias("dist"),
            F.col(f"{gain}.id").alias("id"),
            F.col(f"{gain}.name").alias("name"),
        ),
    )


def lineage(taxa: DataFrame, max_depth: int | None = None, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Name, depth and family of every taxon: one row per (source, project, taxon id).

    ``depth`` is the longest path to a taxon without parent; ``family`` the name of
    the nearest ancestor of rank family, itself included, the lowest id winning on
    equal distance. The taxa need merged ids and renamed ranks. Gives what the
    closure would give without building it.
    """
    zero = F.lit(0).cast("long")
    family = F.when(
        same_name("rank", F.lit(FAMILY_RANK), collation),
        F.struct(zero.alias("dist"), F.col("id").alias("id"), F.col("taxon").alias("name")),
    )
    nodes = materialize(
        taxa.select(*KEY, "id", "taxon", _parent_of().alias(_UP), family.alias("gain"))
        .groupBy(*KEY)
        .agg(
            F.min(_UP).alias("lo"),
            F.max(_UP).alias("hi"),
            F.min("gain").alias("gain"),
            F.min(F.struct("id", "taxon")).getField("taxon").alias("taxon"),
        ),
        "nodes",
    )
    edges = taxa.select(*KEY, _parent_of().alias(_UP)).filter(F.col(_UP).isNotNull())
    single = F.col("lo") == F.col("hi")
    multi = nodes.filter("lo < hi").select(*KEY)
    has_multi = not _is_empty(multi)

    # inner nodes: chains of single parents end at a taxon without parent or with several
    parents = materialize(edges.select(*SCOPE, F.col(_UP).alias(TAXON_ID)).distinct(), "parents")
    inner = materialize(
        dimension_join(nodes, parents, KEY, "left_semi", [TAXON_ID]).select(*KEY, F.when(single, F.col("lo")).alias("top"), "gain"), "inner"
    )
    known = inner.select(*SCOPE, F.col(TAXON_ID).alias("top"), F.lit(True).alias("found"))
    start = balanced_join(inner, known, [*SCOPE, "top"], "left", [TAXON_ID]).select(
        *KEY,
        F.when(F.col("found"), F.col("top")).otherwise(F.col(TAXON_ID)).alias("top"),
        F.when(F.col("found"), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("dist"),
        F.col("found").isNull().alias("arrived"),
        "gain",
    )
    state, cyclic = climb(materialize(start, "climb"), SCOPE, TAXON_ID)
    if cyclic:
        _fail_cycle(state.filter(~F.col("arrived")), taxa)
    chain = state.select(
        *SCOPE,
        F.col(TAXON_ID).alias("_first"),
        F.col("top").alias("_anchor"),
        (F.col("dist") + 1).alias("_dist"),
        _shift("gain", F.lit(1)).alias("_gain"),
    )

    own = nodes.select(*KEY, "taxon", "gain", F.when(single, F.col("lo")).alias("_first"))
    reached = dimension_join(own, chain, [*SCOPE, "_first"], "left", [TAXON_ID]).select(
        *KEY,
        "taxon",
        F.coalesce("_anchor", F.col(TAXON_ID)).alias("_anchor"),
        F.coalesce("_dist", zero).alias("depth"),
        F.coalesce("gain", "_gain").alias("gain"),
    )
    if has_multi:
        reached = materialize(reached, "reached")
        forks = _fork_values(taxa, edges, multi, chain)
        reached = balanced_join(
            reached,
            forks.select(*SCOPE, F.col(TAXON_ID).alias("_anchor"), F.col("depth").alias("_d"), F.col("gain").alias("_g")),
            [*SCOPE, "_anchor"],
            "left",
            [TAXON_ID],
        ).select(
            *KEY,
            "taxon",
            (F.col("depth") + F.coalesce("_d", zero)).alias("depth"),
            F.coalesce("gain", "_g").alias("gain"),
        )
    result = materialize(reached.select(*KEY, "taxon", "depth", F.col("gain.name").alias("family")), "lineage")
    if max_depth is not None:
        too_long = result.filter(F.col("depth") > max_depth)
        if not _is_empty(too_long):
            _fail_beyond(too_long, max_depth)
    return result


def _fork_values(taxa: DataFrame, edges: DataFrame, multi: DataFrame, chain: DataFrame) -> DataFrame:
    """Depth and family of the taxa with several parents.

    Works on the condensed graph in which a step leads from such a taxon to the end
    of the chain above one of its parents. Paths double in every round: ``values`` knows
    the longest way and the nearest family within ``covered`` steps, ``jump`` the ends of
    all paths of exactly so many steps, with the longest way there and the shortest one
    that meets no family. Taxa with such a path get fewer in every round unless the rest
    lies on or below a cycle.
    """
    zero = F.lit(0).cast("long")
    above = materialize(balanced_join(edges, multi, KEY, "left_semi", [_UP]).distinct(), "forks")
    steps = balanced_join(
        above.withColumnRenamed(_UP, "_first"), chain, [*SCOPE, "_first"], "inner", [TAXON_ID]
    ).drop("_first")
    forks = multi.select(*SCOPE, F.col(TAXON_ID).alias("_anchor"), F.lit(True).alias("_open"))
    steps = materialize(balanced_join(steps, forks, [*SCOPE, "_anchor"], "left", [TAXON_ID, "_dist"]), "forks")
    none = F.lit(None).cast(steps.schema["_gain"].dataType)
    first = steps.select(*KEY, F.col("_dist").alias("depth"), F.col("_gain").alias("gain"))
    stepless = multi.select(*KEY, zero.alias("depth"), none.alias("gain"))
    values = materialize(_best(first.unionByName(stepless)), "fork-values")
    near = F.when(F.col("_gain").isNull(), F.col("_dist")).alias("near")
    jump = _ends(steps.filter("_open").select(*KEY, "_anchor", F.col("_dist").alias("far"), near))
    jump, before = materialize(jump, "forks"), None
    while left := jump.select(*KEY).distinct().count():
        if left == before:
            _fail_cycle(jump, taxa)
        before = left
        ahead = values.select(*SCOPE, F.col(TAXON_ID).alias("_anchor"), F.col("depth").alias("_d"), F.col("gain").alias("_g"))
        reached = balanced_join(jump, ahead, [*SCOPE, "_anchor"], "inner", [TAXON_ID])
        gain = F.when(F.col("near").isNotNull(), _shift("_g", F.col("near"))).alias("gain")
        longer = reached.select(*KEY, (F.col("far") + F.col("_d")).alias("depth"), gain)
        values = materialize(_best(values.unionByName(longer)), "fork-values")
        onward = jump.select(
            *SCOPE,
            F.col(TAXON_ID).alias("_anchor"),
            F.col("_anchor").alias("_next"),
            F.col("far").alias("_far"),
            F.col("near").alias("_near"),
        )
        twice = balanced_join(jump, onward, [*SCOPE, "_anchor"], "inner", [TAXON_ID]).select(
            *KEY,
            F.col("_next").alias("_anchor"),
            (F.col("far") + F.col("_far")).alias("far"),
            (F.col("near") + F.col("_near")).alias("near"),
        )
        jump = materialize(_ends(twice), "forks")
    return values


def _best(values: DataFrame) -> DataFrame:
    return values.groupBy(*KEY).agg(F.max("depth").alias("depth"), F.min("gain").alias("gain"))


def _ends(paths: DataFrame) -> DataFrame:
    return paths.groupBy(*KEY, "_anchor").agg(F.max("far").alias("far"), F.min("near").alias("near"))


def family_of(taxa: DataFrame, lineage_df: DataFrame) -> DataFrame:
    """``taxa`` with ``depth`` and ``family`` added."""
    return balanced_join(taxa, lineage_df.drop("taxon"), KEY, "left", ["id"])


# --- pruning ----------------------------------------------------------------------


def orphans(tree: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Rows whose parent row does not exist, roots excepted."""
    ids = tree.select(F.col("id").alias("parent_id"))
    return balanced_join(tree.filter(~is_root(collation)), ids, ["parent_id"], "left_anti", ["id"])


def prune_unconnected(tree: DataFrame, collation: str = DEFAULT_COLLATION) -> DataFrame:
    """Drop every row whose chain of ``parent_id`` ends anywhere but at a root.

    Same result as dropping parentless rows again and again until none is left.
    Rows of a cycle all have a parent and stay.
    """
    links = tree.select("id", F.when(~is_root(collation), F.col("parent_id")).alias("top"), is_root(collation).alias("root"))
    parents = links.filter(F.col("top").isNotNull()).select(F.col("top").alias("id")).distinct()
    inner = materialize(dimension_join(links, materialize(parents, "parents"), ["id"], "left_semi", ["id"]), "inner")
    known = inner.select(F.col("id").alias("top"), F.lit(True).alias("found"))
    none = F.lit(None).cast("struct<dist:bigint,id:bigint,name:string>")
    start = balanced_join(inner, known, ["top"], "left", ["id"]).select(
        "id",
        F.when(F.col("found"), F.col("top")).otherwise(F.col("id")).alias("top"),
        F.when(F.col("found"), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("dist"),
        F.col("found").isNull().alias("arrived"),
        none.alias("gain"),
    )
    state, _ = climb(materialize(start, "climb"), [], "id")
    ends = inner.filter("root").select(F.col("id").alias("top"), F.lit(True).alias("root"))
    good = (
        dimension_join(state, ends, ["top"], "left", ["id"])
        .filter(F.coalesce("root", F.lit(False)) | ~F.col("arrived"))
        .select(F.col("id").alias("parent_id"))
    )
    return dimension_join(tree.filter(~is_root(collation)), good, ["parent_id"], "left_semi", ["id"]).unionByName(
        tree.filter(is_root(collation))
    )
