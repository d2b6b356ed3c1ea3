import pytest
from pyspark.sql import functions as F

from cladeweave.functions import names, ranks
from cladeweave.model import RANK_CODES, REDLIST_LABELS, REDLIST_TERMS
from cladeweave.runtime import BINARY
from cladeweave.sources import checklist


def texts(spark, schema, rows, column):
    numbered = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(numbered, f"i int, {schema}").coalesce(1)
    return [r.x for r in df.select("i", column.alias("x")).orderBy("i").collect()]


def test_canonical_name(spark):
    cases = [
        (("ABIES", "alba", None, 170), "Abies alba"),
        (("ABIES", "alba", "", 170), "Abies alba"),
        (("ABIES", "alba", "minor", 160), "Abies alba minor"),
        (("ABIES", None, "minor", 160), "Abies minor"),
        (("ABIES", "alba", "minor", 179), "Abies alba minor"),
        (("ABIES", "alba", "minor", 180), "Abies"),
        (("ABIES", "alba", None, None), "Abies"),
        (("aBIES  ", "alba  ", None, 170), "abies alba"),
        (("X", None, None, 340), "X"),
        ((None, "alba", None, 170), None),
    ]
    got = texts(
        spark,
        "g string, s string, f string, o int",
        [c for c, _ in cases],
        names.canonical_name(F.col("g"), F.col("s"), F.col("f"), F.col("o")),
    )
    assert got == [w for _, w in cases]


def test_zoological_authorship(spark):
    cases = [
        (("L.", 1758, 1766, 0, None), "L., 1766"),
        (("L. ", 1758, 1766, 1, None), "(L., 1758)"),
        (("L.", None, 1766, 1, None), "(L.)"),
        (("L.", 1758, None, 0, None), "L."),
        (("L.", 1758, 1766, None, None), "L."),
        (("L.", 1758, 1766, 0, "s.l. "), "L., 1766 s.l."),
        (("", 1758, 1766, 1, None), ""),
        (("  ", 1758, 1766, 1, "x"), " x"),
        ((None, 1758, 1766, 1, None), ""),
        (("L.", 1758, 1766, 0, ""), "L., 1766 "),
    ]
    got = texts(
        spark,
        "a string, b int, p int, r int, x string",
        [c for c, _ in cases],
        names.zoo_authorship(*[F.col(c) for c in "abprx"]),
    )
    assert got == [w for _, w in cases]


def test_botanical_authorship(spark):
    cases = [
        (("L.", None, None, "alba", None, "sp.", None), " L."),
        (("L.", "", "", "alba", "", "sp.", None), " L."),
        (("L.", "Mill.", None, "alba", None, "sp.", None), " (L.) Mill."),
        (("L. ", "Mill. ", "Fr. ", "alba", None, "sp.", None), " (L. : Fr.) Mill."),
        (("Pers.", None, "Fr.", "alba", None, "sp.", None), " Pers. : Fr."),
        ((None, "Mill.", "Fr.", "alba", None, "sp.", None), "Mill."),
        ((None, None, None, "alba", "alba", "var.", None), " var. alba"),
        (("L.", None, None, "alba ", "alba", "var.", "s.l."), " L. var. alba s.l."),
        ((None, None, None, "alba", "alba", "", None), " alba"),
        ((None, None, None, "alba", "alba", None, None), " alba"),
        ((None, None, None, "alba", "minor", "var.", None), ""),
        ((None, None, None, None, "minor", "var.", None), ""),
        ((None, None, None, "", "", "var.", None), ""),
    ]
    got = texts(
        spark,
        "a string, b string, c string, d string, e string, f string, g string",
        [c for c, _ in cases],
        names.botanical_authorship(*[F.col(c) for c in "abcdefg"]),
    )
    assert got == [w for _, w in cases]


def test_authorship_by_code(spark):
    got = texts(
        spark,
        "c int, o int",
        [(3, 170), (1, 170), (None, 170), (3, 180), (3, None)],
        names.authorship(F.col("c"), F.col("o"), F.lit("zoo"), F.lit("bot")),
    )
    assert got == ["zoo", "bot", "bot", None, None]


def test_small_texts(spark):
    assert texts(spark, "a string", [(None,), ("",), ("  ",), (" x",)], names.is_blank(F.col("a"))) == [True, True, True, False]
    assert texts(spark, "a int", [(1758,), (None,)], names.year_text(F.col("a"))) == [", 1758", ""]
    assert texts(spark, "a string", [("é" * 300,), (None,)], names.truncated(F.col("a"), 255)) == ["é" * 255, None]
    stripped = texts(spark, "a string", [(label,) for label in REDLIST_LABELS], names.redlist_term(F.col("a")))
    assert set(stripped) == {t for _, t, _, _ in REDLIST_TERMS}


def test_rank_labels_and_codes(spark):
    labels = ["species", "variety", "subspecies", "phylum", "family", "order", "class", "form", "genus", "kingdom", "infraorder"]
    labels += ["fam.", "subfam.", "SPECIES", "Fam.", "nonsense", "root"]
    df = spark.createDataFrame([(x,) for x in labels], "rank string").withColumn("label", F.col("rank"))
    loose = {r.label: (r.rank, r.rank_code) for r in ranks.normalize_ranks(df).collect()}
    strict = {r.label: (r.rank, r.rank_code) for r in ranks.normalize_ranks(df, BINARY).collect()}
    assert loose["species"] == ("sp.", 170) and loose["kingdom"] == ("reg.", 500) and loose["subfam."] == ("subfam.", 330)
    assert loose["SPECIES"] == ("sp.", 170) and loose["Fam."] == ("fam.", 340)
    assert strict["SPECIES"] == ("SPECIES", 0) and strict["Fam."] == ("Fam.", 0)
    assert loose["nonsense"] == ("nonsense", 0) and loose["root"] == ("root", 0)
    assert {k: v for k, v in strict.items() if k not in ("SPECIES", "Fam.")} == {
        k: v for k, v in loose.items() if k not in ("SPECIES", "Fam.")
    }


def test_vocabulary_is_complete():
    assert len(RANK_CODES) == len(dict(RANK_CODES)) == len({c for _, c in RANK_CODES}) == 55
    assert len(set(REDLIST_LABELS)) == 26
    assert [sum(str(y) in label for label in REDLIST_LABELS) for y in (2009, 2011, 2016)] == [9, 8, 9]


@pytest.mark.parametrize("db_name, kept", [("Animalia", [381, 881]), ("Vertebrata", [923, 927]), ("Other", [380, 381, 881, 882, 923, 927, 928])])
def test_redlist_projects(spark, db_name, kept):
    df = spark.createDataFrame([(p,) for p in [380, 381, 881, 882, 923, 927, 928]], "ProjectID int").coalesce(1)
    assert sorted(r.ProjectID for r in checklist.redlist_projects(df, db_name).collect()) == kept
