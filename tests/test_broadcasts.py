"""What passes through the driver: nothing that grows with the tables."""

import pytest
from pyspark.sql import functions as F

from cladeweave.operators import skew
from cladeweave.runtime import BINARY, materialize, shuffled
from cladeweave.sources import checklist
from workload import fixtures


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_no_table_is_broadcast_for_its_small_files(spark, how):
    left = materialize(spark.range(3000).select((F.col("id") % 50).alias("k"), "id"), "left")
    right = materialize(spark.range(40).select(F.col("id").alias("k"), F.lit(1).alias("v")), "right")
    joined = skew.balanced_join(left, right, ["k"], how, ["id"])
    assert "Broadcast" not in _plan(joined)
    want = {"inner": 2400, "left": 3000, "left_semi": 2400, "left_anti": 600}
    assert joined.count() == want[how]


def test_dimensions_are_broadcast_up_to_their_limit(spark):
    left = materialize(spark.range(300).select((F.col("id") % 50).alias("k"), "id"), "left")
    right = materialize(spark.range(40).select(F.col("id").alias("k")), "right")
    small, large = (skew.dimension_join(left, right, ["k"], "left", ["id"], limit) for limit in (40, 39))
    assert "BroadcastHashJoin" in _plan(small) and "BroadcastHashJoin" not in _plan(large)


def test_extractions_broadcast_vocabularies_only(spark, smallest):
    t = {name: materialize(df, name) for name, df in fixtures.checklist(spark, smallest).items()}
    texts = checklist.name_texts(t, fixtures.PROJECTS)
    for df in (
        checklist.extract_taxa(t, 1, fixtures.PROJECTS, texts),
        checklist.extract_synonyms(t, 1, fixtures.PROJECTS, texts),
        checklist.extract_common_names(t, 1, fixtures.PROJECTS, fixtures.SPECIES_LIST_DB),
    ):
        assert "Broadcast" not in _plan(df)
    # the labels, which are counted
    values = checklist.redlist_values(t, fixtures.SPECIES_LIST_DB, BINARY)
    assert _plan(values).count("BroadcastHashJoin") <= 2  # in the final and the initial plan


def test_shuffled_sides_keep_their_rows(spark):
    a, b = spark.range(5), spark.range(3, 8)
    assert sorted(r.id for r in a.join(shuffled(b), "id").collect()) == [3, 4]
