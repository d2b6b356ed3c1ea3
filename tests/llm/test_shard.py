from collections import Counter

import pytest
from pyspark.sql import functions as F

from cladeweave.llm import shard


def test_fill_is_even_and_full():
    slots = shard.fill(shard.shard_names(7), 211)
    assert set(Counter(slots).values()) <= {30, 31} and len(slots) == 211


def test_few_slots_move():
    names = shard.shard_names(10)
    before, after = shard.fill(names, 2039), shard.fill(names[:-1], 2039)
    moved = sum(a != b for a, b in zip(before, after) if a != 9)
    assert moved < 0.1 * 2039


@pytest.mark.parametrize("names, size", [([], 7), (["a", "a"], 7), (["a", "b"], 9), (["a", "b", "c"], 2)])
def test_fill_refuses(names, size):
    with pytest.raises(ValueError):
        shard.fill(names, size)


def test_place(spark, tmp_path):
    rows = [(1, "a", 5), (None, "b", 6), (1, "c", 7), (None, None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    placed = shard.place(df, "doc_id", shard.shard_names(5), 53)
    got = placed.collect()
    assert len(got) == 4 and set(placed.columns) == {"doc_id", "text", "slot", "shard"}
    assert len({(r.slot, r.shard) for r in got if r.doc_id == 1}) == 1
    assert len({r.slot for r in got if r.doc_id is None}) == 1
    slots = shard.fill(shard.shard_names(5), 53)
    assert all(slots[r.slot] == r.shard for r in got)
    assert shard.place(df.filter("false"), "doc_id", ["x"], 2).count() == 0
    shard.write_shards(placed, f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted((r.text or "", r.shard) for r in back.collect()) == sorted((r.text or "", r.shard) for r in got)


def test_shares_are_even(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    counts = shard.place(df, "doc_id", shard.shard_names(16), 2039).groupBy("shard").count()
    low, high = counts.agg(F.min("count"), F.max("count")).first()
    assert 1000 < low and high < 1500


def test_plan_is_native(spark):
    plan = shard.place(spark.range(9).withColumnRenamed("id", "doc_id"), "doc_id", ["a", "b"], 7)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in text and "Python" not in text and "Existing" not in text
