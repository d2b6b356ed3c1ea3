"""Which taxa lie on cycles, and values of many levels of forks, against plain loops."""

import random

import pytest

from cladeweave.operators import hierarchy as h
from cladeweave.operators.cycles import cycles
from cladeweave.runtime import BINARY

from tests.trees import frame, row


def taxa_of(spark, edges):
    """Rows from (source, taxon, parent)."""
    return frame(spark, [row(5 + i, s, t, p, f"T{t}", None, "sp.") for i, (s, t, p) in enumerate(edges)])


def found(df):
    return {(r.cycle, r.TaxonomySourceID, r.SourceTaxonID) for r in df.collect()}


def plain(edges):
    """Members by depth-first search from every taxon."""
    up = {}
    for s, t, p in edges:
        up.setdefault((s, t), set())
        if p is not None and p != t:
            up[s, t].add((s, p))
    reach = {}
    for start in up:
        seen, todo = set(), [start]
        while todo:
            for n in up[todo.pop()] & up.keys():
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        reach[start] = seen
    return {(min(m for _, m in reach[v] if v in reach[_, m]), *v) for v in up if v in reach[v]}


def test_two_cycles_and_a_long_tail(spark):
    ring = [(1, i, i % 500 + 1) for i in range(1, 501)] + [(1, 600, 601), (1, 601, 600)]
    tail = [(1, 1000 + i, 999 + i if i else 250) for i in range(10_000)]
    ends = [(1, 20_000, None), (1, 20_001, 20_000), (1, 20_002, 20_002), (1, 20_003, 77_777)]
    got = found(cycles(taxa_of(spark, ring + tail + ends)))
    assert got == {(1, 1, i) for i in range(1, 501)} | {(600, 1, 600), (600, 1, 601)}


@pytest.mark.parametrize("seed, none", [(0, 1), (7, 1), (3, 0)])
def test_cycles_of_random_graphs(spark, skew, seed, none):
    rnd = random.Random(seed)
    edges = []
    for source in (1, 2):
        for t in range(1, 120):
            for _ in range(rnd.choice([1, 1, 1, 1, 2, 3] if seed else [1, 1, 1, 1, 1, 1, 1, 2])):
                edges.append((source, t, rnd.choice([None] * none + [rnd.randint(1, 140), max(1, t - rnd.randint(-1, 4))])))
    edges += edges[:10]
    want = plain(edges)
    assert len(want) > 2 and found(cycles(taxa_of(spark, edges))) == want


def test_no_taxa_no_cycles(spark):
    assert cycles(taxa_of(spark, [(1, 1, None)])).collect() == []
    assert cycles(taxa_of(spark, [(1, 1, None)]).limit(0)).collect() == []


def test_the_error_names_the_cycle(spark):
    edges = [(1, 1, 2), (1, 2, 1), (1, 3, 2), (1, 4, 3), (1, 4, 1)]
    with pytest.raises(h.HierarchyError, match="cycle") as error:
        h.closure(taxa_of(spark, edges))
    assert found(spark.read.parquet(error.value.cycles)) == {(1, 1, 1), (1, 1, 2)}


def test_a_thousand_levels_of_forks(spark, monkeypatch):
    """Two taxa a level with two parents each; some levels skip, one taxon is a family."""
    levels = 1000
    rows, n = [row(5, 1, 1, None, "T1", None, "gen."), row(6, 1, 2, None, "T2", None, "gen.")], 7
    up = {1: [], 2: []}
    for level in range(1, levels):
        for side in (1, 2):
            taxon = 2 * level + side
            over = [2 * level - 1, max(1, 2 * level - (3 if level % 7 == side else 0))]
            rank = "fam." if (level, side) == (400, 1) else "sp."
            for parent in over:
                rows.append(row(n, 1, taxon, parent, f"T{taxon}", None, rank))
                n += 1
            up[taxon] = over
    depth, near = {}, {}
    for taxon, over in up.items():
        depth[taxon] = max((depth[p] + 1 for p in over), default=0)
        far = [near[p] + 1 for p in over if near[p] is not None]
        near[taxon] = 0 if taxon == 801 else min(far, default=None)
    rounds = []
    best = h._best
    monkeypatch.setattr(h, "_best", lambda values: rounds.append(1) or best(values))
    got = {r.SourceTaxonID: (r.depth, r.family) for r in h.lineage(frame(spark, rows), collation=BINARY).collect()}
    assert got == {t: (depth[t], None if near[t] is None else "T801") for t in up}
    assert len(rounds) <= 12
