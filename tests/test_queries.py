"""All registered queries against their SQL on the smallest data, and known counts."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from workload.oracle import oracle_queries
from workload.queries import all_queries
from workload.stages import stages

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(smallest):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{smallest}/{name}.parquet'")
    return con


def rows(df: pd.DataFrame):
    df = df[sorted(df.columns)].astype(object)
    plain = [
        tuple(None if pd.isna(v) else int(v) if isinstance(v, float) else v for v in r)
        for r in df.itertuples(index=False, name=None)
    ]
    return sorted(plain, key=lambda r: [(v is not None, str(v)) for v in r])


def test_every_query_has_sql():
    assert set(all_queries()) == set(oracle_queries())
    assert set(all_queries()) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, duck, smallest, name):
    got = entry_module.queries()[name](spark, smallest).toPandas()
    want = duck.execute(entry_module.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_known_counts(spark, smallest):
    """Counts of an independent simulation of the rules, see FIXTURES.md."""
    s = stages(spark, smallest)
    count = lambda df, *by: {tuple(r)[:-1]: r["count"] for r in df.groupBy(*by).count().collect()}
    assert s.taxa.count() == 867
    assert count(s.closure, "PathLength") == {(0,): 867, (1,): 839, (2,): 626, (3,): 576, (4,): 442, (5,): 237, (6,): 27}
    assert count(s.banded, "band") == {("family",): 219, ("genus",): 235, ("species",): 404}
    assert s.survivors.count() == 3 + 102 + 37 + 143 + 29 + 323 + 32 + 1
    assert s.linked.filter("parent_id IS NULL").count() == 26
    assert count(s.merged, "TaxonomySourceID") == {(0,): 4, (1,): 343, (2,): 98}
    moved = s.repaired.join(s.linked.select("id", F.col("rank_code").alias("old")), "id").filter("old != rank_code")
    assert count(moved, "old", "rank_code") == {(380, 390): 7, (380, 370): 6}


def test_familyless_doubles_have_whole_names(spark, smallest):
    found = all_queries()["doubles_without_family"](spark, smallest)
    known = stages(spark, smallest).banded.select("taxon").distinct()
    assert found.filter("taxon LIKE '% %'").count() > 0
    assert found.join(known, "taxon", "left_anti").count() == 0


def test_whole_run_merges(spark, smallest):
    """The run of two checklists and a backbone keeps, merges and links most of its rows."""
    run = stages(spark, smallest).full_run
    n = lambda df: df.count()
    taxa = run.taxa.cache()
    names = taxa.filter("TaxonomySourceID > 0").groupBy("TaxonomySourceID", "SourceProjectID").count().collect()
    assert n(taxa) > 100 and len(names) >= 2
    assert n(taxa.filter("parent_id > 4")) > 50 and n(taxa.filter("familyCache IS NOT NULL")) > 50
    for dependents, link in ((run.synonyms, "syn_taxon_id"), (run.redlist, "taxon_id")):
        assert 2 * n(dependents.filter(f"{link} IS NOT NULL")) > n(dependents) or n(dependents) == 0
    found = run.synonyms.join(taxa.select(F.col("id").alias("syn_taxon_id"), F.col("SourceTaxonID").alias("t"), F.col("TaxonomySourceID").alias("ts")), "syn_taxon_id")
    by_name = found.filter("ts != TaxonomySourceID OR t != SourceAcceptedTaxonID")
    assert n(by_name) > 0 and n(found) > n(by_name)
