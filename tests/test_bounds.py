"""Sizes that nothing may cap, cycles without a depth limit, and reader options."""

import duckdb
import pytest
from pyspark.sql import functions as F

from cladeweave.model import SourceSpec
from cladeweave.operators import doubles, hierarchy as h
from cladeweave.runtime import BINARY
from cladeweave.sources import checklist

from tests.trees import frame, roots, row

KEYS = ("TaxonomySourceID", "SourceProjectID", "SourceTaxonID")


def test_long_chain_without_limit(spark):
    rows = [row(5 + n, 1, n, n - 1 if n else None, f"T{n}", None, "sp.") for n in range(300)]
    taxa = frame(spark, rows)
    assert {r.SourceTaxonID: r.depth for r in h.lineage(taxa).collect()} == {n: n for n in range(300)}
    assert h.closure(taxa).count() == 300 * 301 // 2


@pytest.mark.parametrize("forked", [False, True])
def test_cycles_without_limit(spark, forked):
    rows = [row(5, 1, 1, 2, "A", "B", "sp."), row(6, 1, 2, 1, "B", "A", "sp."), row(7, 1, 3, 2, "C", "B", "sp.")]
    rows += [row(20 + n, 1, 10 + n, 9 + n if n else None, f"T{n}", None, "sp.") for n in range(12)]
    if forked:
        rows += [row(8, 1, 1, 21, "A", "T11", "sp."), row(9, 1, 2, 15, "B", "T5", "sp.")]
    taxa = frame(spark, roots() + rows)
    for build in (h.lineage, h.closure):
        with pytest.raises(h.HierarchyError, match="cycle") as error:
            build(taxa)
        bad = {tuple(r[k] for k in KEYS) for r in spark.read.parquet(error.value.path).collect()}
        assert bad <= {(1, 1, 1), (1, 1, 2), (1, 1, 3)} and (1, 1, 2) in bad


def test_ways_are_expanded_in_parts(spark, monkeypatch):
    monkeypatch.setattr(h, "_WAYS", 3)
    counts = h._repeated(spark.createDataFrame([(1, 1), (2, 3), (3, 10)], "id long, n long")).groupBy("id").count()
    assert {r["id"]: r["count"] for r in counts.collect()} == {1: 1, 2: 3, 3: 10}


@pytest.mark.parametrize("collation", [BINARY, "UNICODE_CI_AI"])
def test_winner_of_any_depth_and_id(spark, collation):
    big = (1 << 62) + 5
    rows = [(big, "A", 20_000), (7, "A", 3), (8, "A", 19_999), (big + 1, "B", 1 << 40), (big + 2, "B", 1 << 40), (3, "B", 0)]
    banded = spark.createDataFrame(rows, "id long, taxon string, depth long").withColumns(
        {"band": F.lit("species"), "family": F.lit("F")}
    )
    assert {r.id for r in doubles.pick_winners(banded, collation).collect()} == {big, big + 1}
    assert {r.id for r in doubles.surviving_ids(banded, collation).collect()} == {big, big + 1}


def test_row_without_name_is_no_root_and_stays(spark):
    taxa = frame(spark, roots() + [row(9, 1, 1, None, None, "root", "sp.", parent_id=1)])
    assert {r.id for r in h.prune_unconnected(taxa).collect()} >= {1, 9}


def test_jdbc_ranges_hold_as_many_rows():
    """The SQL that goes to the database, on ids with gaps, repeats and nulls."""
    spec = SourceSpec("s", "db", "jdbc:x", (1,), fmt="jdbc", options={"user": "u", "numPartitions": "4"})
    assert checklist.jdbc_options(spec) == {"user": "u", "url": "jdbc:x"}
    db = duckdb.connect()
    for ids in ([*range(1000), 10**12, 10**12 + 5, None], [7] * 50 + [None] * 3, [], [None], [5] * 300 + list(range(-100, 0))):
        db.execute("CREATE OR REPLACE TABLE T (NameID BIGINT)")
        if ids:
            db.executemany("INSERT INTO T VALUES (?)", [(i,) for i in ids])
        lows = [r[0] for r in db.execute(checklist.jdbc_quantiles(spec, "T")).fetchall()]
        sizes = [db.execute(f"SELECT count(*) FROM T WHERE {p}").fetchone()[0] for p in checklist.jdbc_predicates(lows)]
        assert sum(sizes) == len(ids) and len(sizes) <= 4
        most = max((ids.count(i) for i in set(ids)), default=0)
        assert all(n <= len(ids) // 4 + 1 + most + ids.count(None) for n in sizes)
    plain = SourceSpec("s", "db", "jdbc:x", (1,), fmt="jdbc")
    assert f"NTILE({checklist.JDBC_PARTITIONS})" in checklist.jdbc_quantiles(plain, "T")

