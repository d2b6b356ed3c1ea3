from collections import Counter

import pytest

from cladeweave.operators import hierarchy as h
from cladeweave.runtime import BINARY, materialize

from tests import brute
from tests.trees import frame, random_taxa, roots, row


def bag(df):
    return Counter(
        ((r.TaxonomySourceID, r.SourceProjectID, r.AncestorID), (r.TaxonomySourceID, r.SourceProjectID, r.DescendantID), r.PathLength)
        for r in df.collect()
    )


def test_closure_is_the_bag_of_all_paths(spark, skew):
    rows = random_taxa(1)
    assert bag(h.closure(frame(spark, rows))) == Counter(brute.closure(rows))


def test_closure_of_plain_trees(spark):
    rows = random_taxa(3, forks=False)
    assert bag(h.closure(frame(spark, rows))) == Counter(brute.closure(rows))


def test_closure_step_extends_by_one(spark, skew):
    rows = random_taxa(4)
    taxa = frame(spark, rows)
    all_paths = materialize(h.closure(taxa), "closure")
    step = h.closure_step(all_paths.filter("PathLength = 1"), taxa)
    assert bag(step) == Counter(p for p in brute.closure(rows) if p[2] == 2)


def test_lineage_matches_closure(spark, skew):
    rows = random_taxa(5, size=120)
    got = {
        (r.TaxonomySourceID, r.SourceProjectID, r.SourceTaxonID): (r.depth, r.family)
        for r in h.lineage(frame(spark, rows), collation=BINARY).collect()
    }
    assert got == brute.lineage(rows)


def chain(length):
    return [row(5 + n, 1, n, n - 1 if n else None, f"T{n}", None, "sp.") for n in range(length)]


def test_depth_of_long_chain(spark):
    taxa = frame(spark, chain(20))
    assert {r.SourceTaxonID: r.depth for r in h.lineage(taxa, max_depth=19).collect()} == {n: n for n in range(20)}
    assert h.closure(taxa, max_depth=19).count() == 20 * 21 // 2
    for build in (h.lineage, h.closure):
        with pytest.raises(h.HierarchyError):
            build(taxa, max_depth=18)


def test_too_deep_names_the_lower_end(spark):
    assert {r.SourceTaxonID for r in h.too_deep(frame(spark, chain(8)), 5).collect()} == {6, 7}


def test_cycles_are_reported(spark):
    cycle = [row(5, 1, 1, 2, "A", "B", "sp."), row(6, 1, 2, 1, "B", "A", "sp."), row(7, 1, 3, 2, "C", "B", "sp.")]
    fork = cycle + [row(8, 1, 1, 4, "A", "D", "sp."), row(9, 1, 4, None, "D", None, "gen.")]
    for rows in (cycle, fork):
        taxa = frame(spark, roots() + rows)
        for build in (h.lineage, h.closure):
            with pytest.raises(h.HierarchyError, match=r"\(1, 1, [123]\)"):
                build(taxa, max_depth=6)
        assert {r.SourceTaxonID for r in h.too_deep(taxa, 5).collect()} == {1, 2, 3}


def test_self_parent_ends_a_path(spark):
    taxa = frame(spark, [row(5, 1, 1, 1, "A", "A", "gen."), row(6, 1, 2, 1, "B", "A", "sp.")])
    assert sorted((r.AncestorID, r.DescendantID, r.PathLength) for r in h.closure(taxa).collect()) == [
        (1, 1, 0),
        (1, 2, 1),
        (2, 2, 0),
    ]


def test_sources_and_projects_stay_apart(spark):
    taxa = frame(
        spark,
        [
            row(5, 1, 1, None, "A", None, "gen.", project=1),
            row(6, 1, 2, 1, "B", "A", "sp.", project=2),
            row(7, 2, 2, 1, "B", "A", "sp.", project=1),
        ],
    )
    assert {r.PathLength for r in h.closure(taxa).collect()} == {0}


def _tree(spark, links):
    rows = [row(1, 0, 1, None, "root", None, "root")]
    rows += [row(i, 1, i, None, f"T{i}", "x", "sp.", parent_id=p) for i, p in links.items()]
    return rows


def test_prune_like_repeated_deletion(spark, skew):
    rows = _tree(
        spark,
        {
            **{12: 1, 13: 12, 14: 13, 15: 14, 16: 15},  # connected chain
            **{22: 99, 23: 22, 24: 23, 25: 24, 26: 1},  # chain below a missing row
            **{32: None, 33: 32, 34: 33, 35: 1},  # chain below a row without parent
            **{42: 43, 43: 42, 44: 43, 45: 44, 46: None, 47: 46},  # a cycle and what hangs on it stays
            **{52: 52, 53: 52, 54: 1},  # its own parent
        },
    )
    got = sorted(r.id for r in h.prune_unconnected(frame(spark, rows), BINARY).collect())
    assert got == sorted(r["id"] for r in brute.prune(rows)) and len(got) < len(rows)


def test_orphans(spark):
    rows = _tree(spark, {2: 1, 3: 99, 4: 3})
    assert [r.id for r in h.orphans(frame(spark, rows), BINARY).collect()] == [3]
