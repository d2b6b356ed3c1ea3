import pytest
from pyspark.sql import functions as F

from cladeweave import Backbone, SourceSpec, extract_all, merge_all, model, read_run
from cladeweave.operators import links
from cladeweave.runtime import BINARY
from cladeweave.sources import backbone, checklist, publish

from tests.trees import frame, row


def write(spark, path, tables):
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}")


NAMES = (
    "NameID long, GenusOrSupragenericName string, SpeciesEpithet string, InfraspecificEpithet string, "
    "NomenclaturalCode int, BasionymAuthors string, CombiningAuthors string, SanctioningAuthor string, "
    "BasionymAuthorsYear int, YearOfPubl int, IsRecombination int, NonNomenclaturalNameSuffix string, "
    "TaxonomicRank string, TaxonNameCache string"
)
MEMBER = "NameID long, ProjectID int"


def name(i, genus, species, rank, author=None):
    return (i, genus, species, None, 3, author, None, None, None, 1758, 0, None, rank, f"cache {i}")


def tables(names, parents, accepted, synonyms=(), common=(), project=85, ignored=()):
    members = [(n[0], project) for n in names]
    return {
        "TaxonName": (NAMES, names),
        "TaxonNameProject": (MEMBER, members),
        "TaxonHierarchy": ("NameID long, NameParentID long, ProjectID int", [(c, p, project) for c, p in parents]),
        "TaxonNameTaxonomicRank_Enum": ("Code string, DisplayOrder int", model.RANK_CODES),
        "TaxonAcceptedName": (
            MEMBER + ", IgnoreButKeepForReference int",
            [(i, project, 0) for i in accepted] + [(i, project, 1) for i in ignored],
        ),
        "TaxonSynonymy": ("NameID long, SynNameID long", list(synonyms)),
        "TaxonCommonName": ("NameID long, CommonName string, LanguageCode string", list(common)),
        "TaxonNameList": (MEMBER, [(3, 925), (3, 1)]),
        "TaxonNameListReference": (MEMBER + ", TaxonNameListRefText string", [(3, 925, "Ref"), (3, 1, "Ref")]),
        "TaxonNameListAnalysis": (
            MEMBER + ", AnalysisID int, AnalysisValue string",
            [(3, 925, 1, "2"), (3, 925, 2, "x"), (3, 1, 1, "outside")],
        ),
        "TaxonNameListAnalysisCategory": (
            "AnalysisID int, DisplayText string",
            [(1, "RoteListe_D_2009_RL-Kategorie"), (2, "SomethingElse")],
        ),
    }


def test_whole_run(spark, tmp_path):
    first = tables(
        [
            name(1, "ANIMALIA", None, "reg."),
            name(2, "FAMILIDAE", None, "fam."),
            name(3, "GENUS", None, "gen."),
            name(4, "GENUS", "alba", "sp.", "L."),
            name(5, "GENUS", "nigra", "sp.", "L."),
            name(6, "GENUS", "rubra", "sp.", "L."),
        ],
        [(2, 1), (3, 2), (4, 3), (5, 3), (6, 3)],
        accepted=[1, 2, 3, 4],
        ignored=[6],
        synonyms=[(5, 4), (6, 4), (4, 3)],
        common=[(4, "Weisse Gattung", "deu"), (4, "Weisse Gattung", "de"), (99, "unknown", "de")],
    )
    second = tables(
        [
            name(1, "ANIMALIA", None, "reg."),
            name(7, "ORDO", None, "ord."),
            name(2, "FAMILIDAE", None, "fam."),
            name(3, "GENUS", None, "gen."),
            name(4, "GENUS", "alba", "sp.", "L."),
        ],
        [(7, 1), (2, 7), (3, 2), (4, 3)],
        accepted=[1, 2, 3, 4, 7],
    )
    write(spark, tmp_path / "one", first)
    write(spark, tmp_path / "two", second)
    flat = [
        (1, None, None, "Animalia", None, None, "kingdom", None, "doubtful", "Animalia"),
        (2, 1, None, "Familidae", None, "Animalia", "family", None, "accepted", "Animalia"),
        (3, 2, None, "Genus", None, "Familidae", "genus", None, "accepted", "Animalia"),
        (4, 3, None, "Genus viridis", "Auth.", "Genus", "species", None, "accepted", "Animalia"),
        (5, 3, 4, "Genus virens", None, "Genus", "species", None, "synonym", "Animalia"),
        (6, 3, None, "Planta", None, "Genus", "species", None, "accepted", "Plantae"),
    ]
    schema = ", ".join(f"{c} {'long' if c.endswith('ID') else 'string'}" for c in backbone.COLUMNS)
    spark.createDataFrame(flat, schema).coalesce(1).write.csv(str(tmp_path / "flat"), sep="\t", header=True)

    specs = [
        SourceSpec("first", "Vertebrata", str(tmp_path / "one"), (85,)),
        SourceSpec("second", "Vertebrata", str(tmp_path / "two"), (85,)),
    ]
    staged = extract_all(spark, specs, Backbone("flat", str(tmp_path / "flat"), "csv"))
    assert [tuple(r) for r in staged.sources.collect()] == [(1, "first"), (2, "second"), (3, "flat")]
    assert staged.taxa.groupBy(model.SOURCE).count().orderBy(model.SOURCE).collect() == [(0, 4), (1, 4), (2, 5), (3, 4)]

    result = merge_all(staged)
    assert result.write(str(tmp_path / "out")) == 1
    out = read_run(spark, str(tmp_path / "out"))
    taxa = {r.id: r for r in out["taxa"].collect()}
    by_name = {r.taxon: r for r in taxa.values()}

    # exactly one root, every parent exists, ids are unique, one row per name here
    assert [r.taxon for r in taxa.values() if r.parent_id is None] == ["root"]
    assert all(r.parent_id in taxa for r in taxa.values() if r.taxon != "root")
    assert len(by_name) == len(taxa)
    # the deeper second source wins below the order; the flat one adds its species
    assert {n: by_name[n].TaxonomySourceID for n in ("Ordo", "Familidae", "Genus", "Genus alba", "Genus viridis")} == {
        "Ordo": 2,
        "Familidae": 2,
        "Genus": 2,
        "Genus alba": 2,
        "Genus viridis": 3,
    }
    assert taxa[by_name["Genus viridis"].parent_id].taxon == "Genus"
    assert by_name["Genus alba"].author == "L., 1758" and by_name["Genus alba"].familyCache == "Familidae"
    assert "Planta" not in by_name

    synonyms = {r.taxon: r for r in out["synonyms"].collect()}
    # an ignored acceptance does not count as accepted
    assert set(synonyms) == {"Genus nigra", "Genus rubra", "Genus virens"}
    assert synonyms["Genus nigra"].syn_taxon_id == by_name["Genus alba"].id  # by name and family
    assert synonyms["Genus virens"].syn_taxon_id == by_name["Genus viridis"].id  # by key

    common = out["common_names"].collect()
    assert [(r.name, r.code, r.db_name) for r in common] == [("Weisse Gattung", "de", "Vertebrata")]
    redlist = out["redlist"].collect()
    # name 3 has the value in both databases
    assert sorted((r.TaxonomySourceID, r.term, r.value, r.reference, r.taxon_id) for r in redlist) == [
        (s, "RL-Kategorie", "2", "Ref", by_name["Genus"].id) for s in (1, 2)
    ]


def test_redlist_per_project(spark, tmp_path):
    write(spark, tmp_path, tables([name(3, "G", None, "gen.")], [], [3]))
    t = checklist.read_checklist(spark, SourceSpec("s", "Vertebrata", str(tmp_path), (85, 930)))
    each = checklist.extract_redlist(t, 1, [85, 930], "Vertebrata")
    assert sorted(r.SourceProjectID for r in each.collect()) == [85, 930]


def test_texts_are_made_once_and_for_the_projects_only(spark, tmp_path, skew):
    names = [name(1, "A", None, "fam."), name(2, "B", None, "gen."), name(3, "C", None, "gen."), name(4, "D", None, "gen.")]
    write(spark, tmp_path, tables(names, [(2, 1), (2, None)], [2, 3]))
    t = checklist.read_checklist(spark, SourceSpec("s", "x", str(tmp_path), (85,)))
    members = spark.createDataFrame([(2, 85), (3, 85), (4, 86)], "NameID long, ProjectID long")
    t["TaxonNameProject"] = members
    texts = checklist.name_texts(t, [85])
    # the members 2 and 3, and the parent 1, which is no member
    assert sorted(r.NameID for r in texts.collect()) == [1, 2, 3]
    whole = checklist.with_authorship(checklist.with_canonical_name(t["TaxonName"], t)).select(*texts.columns)
    for extract in (checklist.extract_taxa, checklist.extract_synonyms):
        given = extract(t, 1, [85], texts)
        rows = sorted(map(repr, given.collect()))
        assert rows == sorted(map(repr, extract(t, 1, [85]).collect())) == sorted(map(repr, extract(t, 1, [85], whole).collect()))
        assert "TaxonName]" not in given._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.SourceTaxonID, r.parentCanonicalName) for r in checklist.extract_taxa(t, 1, [85], texts).collect() if r.parentCanonicalName) == [(2, "A")]


def test_several_parents_give_several_rows(spark, tmp_path, skew):
    names = [name(1, "A", None, "fam."), name(2, "B", None, "fam."), name(3, "G", None, "gen.")]
    write(spark, tmp_path, tables(names, [(3, 1), (3, 2), (3, 77)], [1, 2, 3]))
    t = checklist.read_checklist(spark, SourceSpec("s", "x", str(tmp_path), (85,)))
    got = sorted(
        (r.SourceTaxonID, r.SourceParentTaxonID or 0, r.parentCanonicalName or "") for r in checklist.extract_taxa(t, 1, [85]).collect()
    )
    assert got == [(1, 0, ""), (2, 0, ""), (3, 1, "A"), (3, 2, "B"), (3, 77, "")]


def test_backbone_filter_admits_the_kingdom_row_only(spark):
    rows = [("Animalia", None, "doubtful", None), ("A", "P", "accepted", "Animalia"), ("B", "P", "accepted", "Plantae")]
    rows += [("C", " ", "accepted", "Animalia"), ("", "P", "accepted", "Animalia"), ("D", "P", "synonym", "Animalia"), (None, "P", "accepted", "Animalia")]
    df = spark.createDataFrame(rows, "canonicalName string, parentCanonicalName string, taxonomicStatus string, kingdom string")
    assert sorted(r.canonicalName for r in backbone.backbone_accepted(df).collect()) == ["A", "Animalia"]


def test_links_prefer_the_key(spark, skew):
    merged = frame(
        spark,
        [row(5, 1, 10, None, "G", "F", "gen."), row(6, 2, 10, None, "H", "F", "gen."), row(7, 2, 11, None, "G", "F", "gen.")],
    ).withColumn("familyCache", F.lit("F"))
    dependents = spark.createDataFrame(
        [
            (1, 1, 1, 10, "H", "F"),  # by key, although the name fits another row
            (2, 1, 1, 99, "G", "F"),  # by name and family, lowest id
            (3, 1, 1, 99, "G", None),
            (4, 1, 1, 99, None, "F"),
            (5, 1, 2, 10, "H", "F"),  # other project
        ],
        "SourceTaxonID long, TaxonomySourceID long, SourceProjectID long, SourceAcceptedTaxonID long, accepted_taxon string, familyCache string",
    ).coalesce(2)
    got = {r.SourceTaxonID: r.syn_taxon_id for r in links.relink_synonyms(dependents, merged, BINARY).collect()}
    assert got == {1: 5, 2: 5, 3: None, 4: None, 5: 6}


def test_run_appears_as_a_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "runs")
    one, two = (spark.range(n).withColumn("part", F.col("id") % 2) for n in (5, 7))
    tables = lambda df: {"a": (df, ["part"]), "b": (df, None), "c": (df, None), "none": (df.filter("false"), ["part"])}
    count = lambda **which: {name: df.count() for name, df in publish.read_run(spark, root, **which).items()}
    with pytest.raises(FileNotFoundError):
        publish.read_run(spark, root)
    assert publish.publish(spark, root, tables(one)) == 1 and count() == {"a": 5, "b": 5, "c": 5, "none": 0}

    real, written = publish.staging.write_table, []

    def failing(df, path, *args, **kwargs):
        written.append(path)
        if len(written) == 2:
            raise OSError("lost")
        real(df, path, *args, **kwargs)

    monkeypatch.setattr(publish.staging, "write_table", failing)
    with pytest.raises(OSError):
        publish.publish(spark, root, tables(two))
    assert publish.versions(spark, root) == [1] and count() == {"a": 5, "b": 5, "c": 5, "none": 0}
    monkeypatch.setattr(publish.staging, "write_table", real)

    assert publish.publish(spark, root, tables(two)) == 2
    assert count() == {"a": 7, "b": 7, "c": 7, "none": 0} and count(version=1) == {"a": 5, "b": 5, "c": 5, "none": 0}
    # the next run may be made from the last one, and a number is given once
    last = publish.read_run(spark, root)["a"].select("id", "part")
    monkeypatch.setattr(publish, "versions", lambda *_: [1])
    with pytest.raises(publish.PublishError):
        publish.publish(spark, root, tables(last))
    monkeypatch.undo()
    assert publish.versions(spark, root) == [1, 2]
    assert publish.publish(spark, root, tables(last)) == 3 and count()["b"] == 7
