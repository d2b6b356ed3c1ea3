import random
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from cladeweave import model
from cladeweave.operators import checks, ids
from cladeweave.operators.skew import MOST_ROWS, SkewSettings, balanced_join, balanced_outer, dimension_join, hot_keys
from cladeweave.runtime import BINARY, materialize, scratch_root
from cladeweave.sources import staging

FORCED = SkewSettings(rows=100)


def skewed(spark, n=600, seed=0):
    """A third of the rows under one key, another third without key."""
    rng = random.Random(seed)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{rng.randrange(90)}") for i in range(n)]
    return spark.createDataFrame(rows, "i long, k string").coalesce(3)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_balanced_join_equals_join(spark, how):
    left = skewed(spark)
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), (None, 5)], "k string, v int")
    plain = sorted(map(str, left.join(right, "k", how).collect()))
    assert sorted(map(str, balanced_join(left, right, ["k"], how, ["i"], settings=FORCED).collect())) == plain
    nulls_only = SkewSettings(rows=399)
    counted = left.filter("k != 'hot'")
    heavy = balanced_join(left, right, ["k"], how, ["i"], hot_in=counted, null_heavy=True, settings=nulls_only)
    assert sorted(map(str, heavy.collect())) == plain


def test_hot_rows_are_spread(spark):
    left = skewed(spark, n=3000)
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        largest = [
            max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
            for df in (
                left.join(right, "k", "left"),
                balanced_join(left, right, ["k"], "left", ["i"], settings=SkewSettings(rows=200)),
            )
        ]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert largest[0] >= 1000 and largest[1] <= 200


def test_hot_keys_by_rows(spark):
    left = skewed(spark)
    hot = hot_keys(left.select("k"), ["k"], 600, FORCED)
    (known,) = spark.createDataFrame([("hot",)], "k string").select(F.xxhash64("k").alias("h")).collect()
    assert [(r._key_hash, r._salts) for r in hot.collect()] == [(known.h, 32)]
    assert hot_keys(left.select("k"), ["k"], 600, SkewSettings(rows=3200)) is None
    assert SkewSettings(rows=10).bound(10 * 10**9) == -(-10 * 10**9 // MOST_ROWS)


def test_many_keys_below_a_share_of_all_rows_stay_below_the_bound(spark):
    """More than a thousand hot keys, none but one with a thousandth of all rows."""
    keys, each, giant, bound = 1200, 40, 9000, 600
    name = F.when(F.col("id") < giant, "giant").otherwise(F.concat(F.lit("k"), F.col("id") % keys))
    left = materialize(spark.range(keys * each + giant).select("id", name.alias("k")), "many")
    right = left.select("k", F.xxhash64("k").alias("v")).distinct()
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        met = balanced_join(left, right, ["k"], "inner", ["id"], settings=SkewSettings(rows=bound))
        loads = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k in off:
            spark.conf.unset(k)
    hot = hot_keys(left.select("k"), ["k"], keys * each + giant, SkewSettings(rows=bound))
    assert hot.count() > 1000 and sum(loads) == keys * each + giant and max(loads) <= bound


def test_balanced_outer_splits_the_right_side(spark):
    left = spark.createDataFrame([("hot", 1), ("k1", 2), ("none", 3)], "k string, v int")
    right = skewed(spark)
    want = sorted(map(str, left.join(right, "k", "left").select("k", "v", "i").collect()))
    assert sorted(map(str, balanced_outer(left, right, ["k"], ["i"]).select("k", "v", "i").collect())) == want
    spark.conf.set("spark.cladeweave.skew.rows", "100")
    try:
        got = balanced_outer(left, right, ["k"], ["i"]).select("k", "v", "i")
    finally:
        spark.conf.unset("spark.cladeweave.skew.rows")
    assert sorted(map(str, got.collect())) == want


def test_large_dimension_is_not_broadcast_by_hint(spark):
    left = skewed(spark)
    dim = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, v int")
    both = [dimension_join(left, dim, ["k"], "left", ["i"], limit=n) for n in (1, 2)]
    hinted = ["strategy=broadcast" in df._jdf.queryExecution().optimizedPlan().toString() for df in both]
    assert hinted == [False, True]
    rows = [sorted(map(str, df.collect())) for df in both]
    assert rows[0] == rows[1]


def test_ordered_ids_are_dense_and_in_order(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(40), rng.choice([None, *range(50)])) for _ in range(900)]
    rows = sorted(set(rows), key=lambda r: (r[0], r[1] is not None, r[1] or 0))
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "a int, b int").repartition(5)
    got = sorted((r.id, r.a, r.b) for r in ids.ordered_ids(df, ["a", "b"], start=5).collect())
    assert got == [(i, *r) for i, r in enumerate(rows, start=5)]


def test_ordered_ids_of_nothing(spark):
    assert ids.ordered_ids(spark.createDataFrame([], "a int"), ["a"]).count() == 0


def test_duplicates_and_one_per_key(spark):
    rows = [(1, 1, "b"), (1, 1, "a"), (1, None, "x"), (1, None, "y"), (2, 1, "c")]
    df = spark.createDataFrame(rows, "a int, b int, v string")
    assert [tuple(r) for r in ids.duplicates(df, ["a", "b"]).collect()] == [(1, 1, 2)]
    kept = sorted((r.a, r.b, r.v) for r in ids.one_per_key(df, ["a", "b"]).fillna(-1).collect())
    assert kept == [(1, -1, "x"), (1, -1, "y"), (1, 1, "a"), (2, 1, "c")]


def test_violations(spark):
    df = spark.createDataFrame([(1, None, "ok"), (2, "n" * 256, "deu"), (3, "n", "de")], "i int, name string, code string")
    rules = [("name", False, 255), ("code", False, 2)]
    got = sorted(tuple(r) for r in checks.violations(df, rules, ["i"]).collect())
    assert got == [(1, "name", "null"), (2, "code", "length"), (2, "name", "length")]


def test_numbering_follows_sources_and_projects(spark):
    def staged(source, project, taxon_id, parent, taxon):
        return (source, taxon_id, parent, project, taxon, None, "P", "species", None)

    rows = [
        staged(2, 7, 1, None, "e"),
        staged(1, 9, 2, None, "a"),
        staged(1, 9, 3, 5, "c"),
        staged(1, 9, 3, None, "b"),
        staged(1, 3, 1, None, "d"),
        staged(1, 9, 3, 5, "c2"),
    ]
    taxa = staging.number_taxa(spark.createDataFrame(rows, model.TAXA_SCHEMA), {1: [9, 3], 2: [7]}, BINARY)
    got = sorted((r.id, r.taxon, r.rank, r.rank_code, r.parent_id) for r in taxa.collect())
    assert got[:4] == [
        (1, "root", "root", 0, None),
        (2, "Animalia", "reg.", 500, 1),
        (3, "Plantae", "reg.", 500, 1),
        (4, "Fungi", "reg.", 500, 1),
    ]
    # one row per origin key, the lowest one
    assert [r[:2] for r in got[4:]] == [(5, "a"), (6, "b"), (7, "c"), (8, "d"), (9, "e")]


def test_source_registry(spark):
    assert [tuple(r) for r in staging.source_registry(spark, ["x", "y"]).collect()] == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        staging.source_registry(spark, ["x", "x"])


def test_write_table_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 2):
        staging.write_table(spark.range(n).withColumn("s", F.col("id") % 2), path, ["s"])
    assert spark.read.parquet(path).count() == 2


def test_intermediate_tables_lie_in_the_shared_folder(spark):
    df = materialize(spark.range(3), "probe")
    where = urlparse(df.inputFiles()[0]).path
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert where.startswith(urlparse(scratch_root(spark)).path)
    assert base is None or where.startswith(urlparse(base).path)
