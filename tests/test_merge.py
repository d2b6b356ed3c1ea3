import random

import pytest

from cladeweave.model import RANK_CODES
from cladeweave.operators import doubles, hierarchy, parents, repair, spelling
from cladeweave.plans import merge
from cladeweave.plans.merge import merge_taxonomy
from cladeweave.runtime import BINARY

from tests import brute
from tests.trees import frame, random_taxa, roots, row


def merged_like_brute_force(spark, rows):
    got = {r.id: (r.parent_id, r.rank, r.rank_code, r.familyCache, r.author) for r in merge_taxonomy(frame(spark, rows), collation=BINARY).collect()}
    want = {r["id"]: (r["parent_id"], r["rank"], r["rank_code"], r["familyCache"], r["author"]) for r in brute.merge(rows, RANK_CODES)}
    assert got == want
    return got


@pytest.mark.parametrize("seed", [10, 11])
def test_random_trees(spark, skew, seed):
    assert len(merged_like_brute_force(spark, random_taxa(seed, size=150))) > 20


def test_input_partitioning_does_not_matter(spark):
    taxa = frame(spark, random_taxa(20, size=40, forks=False))
    one = sorted(map(tuple, merge_taxonomy(taxa.coalesce(1), collation=BINARY).collect()))
    many = sorted(map(tuple, merge_taxonomy(taxa.repartition(7), collation=BINARY).collect()))
    assert [r[:3] for r in one] == [r[:3] for r in many] and len(one) == len(many)


BANDED = "id long, band string, taxon string, family string, depth long"


def kept_ids(spark, *rows, **options):
    """Ids that survive among (id, band, taxon, family, depth)."""
    frame_ = spark.createDataFrame(list(rows), BANDED).coalesce(2)
    return sorted(r.id for r in doubles.surviving_ids(frame_, **{"collation": BINARY, **options}).collect())


def test_deeper_copy_wins_then_lowest_id(spark, skew):
    assert kept_ids(spark, (6, "family", "F", None, 1), (9, "family", "F", None, 2)) == [9]
    assert kept_ids(spark, (6, "family", "F", None, 2), (9, "family", "F", None, 2), (8, "genus", "F", "F", 9)) == [6, 8]


def test_homonyms_in_two_families(spark):
    """Single copies per family all stay; with doubles one row over all families does."""
    once = [(7, "genus", "G", "A", 2), (9, "genus", "G", "B", 2)]
    assert kept_ids(spark, *once) == [7, 9]
    twice = once + [(22, "genus", "G", "A", 2), (24, "genus", "G", "B", 3), (25, "genus", "G", "C", 9)]
    assert kept_ids(spark, *twice) == [24, 25]
    assert kept_ids(spark, *twice, winner_scope="taxon_family") == [7, 24, 25]


def test_copies_of_depth_zero_all_go(spark):
    assert kept_ids(spark, (5, "family", "F", None, 0), (6, "family", "F", None, 0), (7, "family", "E", None, 0)) == [7]


def test_rows_without_family_lose_against_any_copy(spark):
    assert kept_ids(spark, (7, "genus", "G", "A", 1), (30, "genus", "G", None, 5)) == [7]
    assert kept_ids(spark, (30, "genus", "G", None, 5), (31, "species", "G", None, 0)) == [30, 31]
    assert kept_ids(spark, (30, "genus", "G", None, 5), (31, "genus", "G", None, 0)) == []


def test_case_and_accents(spark):
    rows = [(5, "genus", "\u00c1a", "Fam", 1), (6, "genus", "AA", "FAM", 1)]
    assert kept_ids(spark, *rows) == [5, 6]
    assert kept_ids(spark, *rows, collation="UNICODE_CI_AI") == [5]


def test_one_name_with_very_many_copies(spark, skew):
    rows = [(i, "genus", "G", "A", 1 + (i + 1) % 3) for i in range(5, 305)] + [(i, "genus", f"H{i}", "A", 1) for i in range(305, 605)]
    assert kept_ids(spark, *rows) == [7] + list(range(305, 605))


def test_bands_and_parent_names(spark):
    rows = [
        row(5, 1, 1, None, "V", "X", "var."),
        row(6, 1, 2, None, "D", "X", "dom."),
        row(7, 1, 3, None, "U", "X", "unknown"),
        row(8, 1, 4, None, "F", None, "fam."),
        row(9, 1, 5, 4, "G", "F", "gen."),
        row(10, 2, 5, None, "G", "F", "gen."),
    ]
    taxa = frame(spark, rows)
    line = hierarchy.lineage(taxa, collation=BINARY)
    banded = doubles.with_lineage(doubles.with_band(taxa), line)
    # the family row without parent name leaves, yet gives its name to the genus below
    assert sorted((r.id, r.band, r.family, r.depth) for r in banded.collect()) == [
        (9, "genus", "F", 1),
        (10, "genus", None, 0),
    ]


def test_merge_ignores_case_by_default(spark):
    rows = [
        row(5, 1, 1, None, "ANIMALIA", "root", "reg."),
        row(6, 1, 2, 1, "F\u00e1m", "Animalia", "fam."),
        row(7, 2, 1, None, "Animalia", "ROOT", "reg."),
        row(8, 2, 2, 1, "FAM", "animalia", "fam."),
        row(9, 2, 3, 2, "Gen", "FAM", "gen."),
    ]
    merged = merge_taxonomy(frame(spark, roots() + rows))
    assert all("collate" not in f.dataType.simpleString() for f in merged.schema.fields)
    # all kingdom rows have depth below 1 or lose to the generated one
    assert {r.id: r.parent_id for r in merged.collect()} == {1: None, 2: 1, 3: 1, 4: 1, 6: 2, 9: 6}


def survivors_frame(spark, rows):
    from pyspark.sql import functions as F

    return frame(spark, rows).withColumn("familyCache", F.when(F.col("rank_code") < 340, "Fam"))


def test_parent_rules_in_order(spark, skew):
    rows = [
        row(1, 0, 1, None, "root", None, "root"),
        row(2, 0, 2, 1, "Animalia", "root", "reg.", parent_id=1),
        row(5, 1, 10, 1, "O", "Animalia", "ord."),  # third rule: name, any family
        row(6, 1, 11, 10, "F", "O", "fam."),  # first rule
        row(7, 2, 12, 77, "G", "F", "gen."),  # third rule
        row(8, 2, 13, 12, "H", "G", "gen."),  # equal rank: first rule fails, last one holds
        row(9, 2, 14, 78, "s", "G", "sp."),  # second rule: same family
        row(10, 2, 15, 78, "same", "same", "gen."),  # its own name on its own rank
    ]
    got = {r.id: r.parent_id for r in parents.link_parents(survivors_frame(spark, rows), BINARY).collect()}
    assert got == {1: None, 2: 1, 5: 2, 6: 5, 7: 6, 8: 7, 9: 7, 10: None}


def test_lowest_id_among_several_parents(spark):
    rows = [row(5, 1, 1, None, "F", "x", "fam."), row(6, 2, 1, None, "F", "x", "fam."), row(7, 2, 9, 8, "G", "F", "gen.")]
    got = {r.id: r.parent_id for r in parents.link_parents(survivors_frame(spark, rows), BINARY).collect()}
    assert got[7] == 5


CHAINS = [
    ("ord.", "ord.", "fam."),
    ("ord.", "ord.", "ord.", "fam."),
    ("ord.", "ord.", "subord."),
    ("cl.", "supercl.", "supercl.", "ord."),
    ("subreg.", "subreg.", "phyl./div."),
    ("gen.", "gen.", "sp."),
    ("ord.", "ord."),
    ("ord.", "superord.", "superord.", "superord.", "ord.", "fam."),
    ("trib.", "trib.", "trib.", "trib.", "gen."),
]


def test_rank_repair(spark, skew):
    rows = [row(1, 0, 1, None, "root", None, "root"), row(2, 0, 2, 1, "Animalia", "root", "reg.", parent_id=1)]
    for c, ranks in enumerate(CHAINS, start=1):
        for n, rank in enumerate(ranks):
            i = 10 * c + n
            rows.append(row(i, 1, i, None, f"T{i}", "x", rank, parent_id=i - 1 if n else 2))
    got = {r.id: (r.rank, r.rank_code) for r in repair.repair_ranks(frame(spark, rows)).collect()}
    assert got == {r["id"]: (r["rank"], r["rank_code"]) for r in brute.repair(rows, RANK_CODES)}
    assert (got[10][0], got[11][0]) == ("superord.", "subord.")


def test_default_collation_does_not_sort_names(spark, monkeypatch):
    """Names get one spelling first; the merge of any spelling equals that of plain names."""
    rng = random.Random(11)
    plain = [{**r, "taxon": f"Ab{r['taxon']}" if r["id"] > 4 else r["taxon"]} for r in random_taxa(12, size=120)]
    known = {r["taxon"][2:] for r in plain if r["id"] > 4}
    plain = [{**r, "parent_taxon": f"Ab{r['parent_taxon']}" if r["id"] > 4 and r["parent_taxon"] in known else r["parent_taxon"]} for r in plain]
    ways = [str, str.upper, str.lower, lambda name: name.replace("A", "Á"), lambda name: name.replace("b", "B")]
    respell = lambda r, name: r[name] and (rng.choice(ways)(r[name]) if r["id"] > 4 else r[name])
    other = [{**r, "taxon": respell(r, "taxon"), "parent_taxon": respell(r, "parent_taxon")} for r in plain]
    want = merge_taxonomy(frame(spark, plain), collation=BINARY).collect()

    plans = []
    for module in (doubles, parents, merge):

        def noted(df, name, keep=False, real=module.materialize):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return real(df, name, keep)

        monkeypatch.setattr(module, "materialize", noted)
    got = merge_taxonomy(frame(spark, other))
    place = lambda rows: sorted((r.id, r.parent_id, r.rank_code) for r in rows)
    rows = got.collect()
    assert place(rows) == place(want) and len(rows) > 20
    sorting = [line for p in plans for line in p.splitlines() if "SortAggregate" in line]
    assert len(plans) >= 4 and sorting == []
    assert not [c for c in got.columns if c.startswith("_")]
    spelled = {r["id"]: (r["taxon"], r["parent_taxon"]) for r in other}
    assert all((r.taxon, r.parent_taxon) == spelled[r.id] for r in rows)


def test_many_variants_are_joined_without_broadcast(spark, monkeypatch):
    names = spark.createDataFrame([(1, "Ab"), (2, "ab"), (3, "Áb"), (4, None), (5, "c"), (6, "ROOT"), (7, "root")], "id int, n string")
    keys = []
    for limit in (spelling.BROADCAST_ROWS, 0):
        monkeypatch.setattr(spelling, "BROADCAST_ROWS", limit)
        found = spelling.Spelling("UNICODE_CI_AI", (names, "n")).with_keys(names, ["n"], ["id"])
        keys.append({r.id: r._key_n for r in found.collect()})
    assert keys[0] == keys[1] == {1: "Ab", 2: "Ab", 3: "Ab", 4: None, 5: "c", 6: "root", 7: "root"}
    assert spelling.Spelling(BINARY, (names, "n")).with_keys(names, ["n"], ["id"]) is names
