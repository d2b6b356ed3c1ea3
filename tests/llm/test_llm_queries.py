"""The registered queries against their SQL, and the pipeline stage by stage."""

import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline
from cladeweave.llm import decontaminate, ngram_join, secrets, toxicity
from cladeweave.llm.common import table
from cladeweave.llm.oracle import all_sql
from cladeweave.llm.queries import all_queries

from .test_decontaminate import brute as brute_hits
from .test_ngram_join import brute as brute_groups


def rows(df):
    names = sorted(df.columns)
    return sorted(map(str, df[names].astype(object).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_equals_sql(spark, smallest, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{smallest}/{t}.parquet'")
    got = all_queries()[name](spark, smallest).toPandas()
    want = con.execute(all_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_pipeline(spark, smallest):
    docs = table(spark, smallest, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "decontaminate", "secrets", "best_fit"]

    machine = toxicity.fit(docs, table(spark, smallest, "labels"))
    clean = stages["toxicity"](spark, docs, smallest)
    bad = {r.doc_id for r in toxicity.score(docs, machine).filter("score >= 0.5").collect()}
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert set(texts) == {r.doc_id for r in docs.collect()} - bad

    one = stages["ngram_join"](spark, clean, smallest)
    kept = {r.doc_id for r in one.collect()}
    assert kept == {d for d, _, c in brute_groups(list(texts.items())) if d == c}

    free = stages["decontaminate"](spark, one, smallest)
    items = [(r.item_id, r.text) for r in table(spark, smallest, "benchmark").collect()]
    free_ids = {r.doc_id for r in free.collect()}
    assert free_ids == {d for d in kept if not brute_hits(texts[d], items, decontaminate.WINDOW)[1]}

    masked = stages["secrets"](spark, free, smallest)
    assert {r.doc_id for r in masked.collect()} == free_ids
    for df in (clean, one, free, masked):
        assert df.schema == docs.schema
    packed = corpus_pipeline.run(spark, smallest).collect()
    assert {r.doc_id for r in packed} == free_ids


CLASHING = ["_id", "_hash", "_spans", "row", "found", "spans", "node", "_ID2", "a.b", "`q`"]


def clashing(df):
    for i, name in enumerate(CLASHING):
        df = df.withColumn(name, F.concat(F.lit(f"mine {i} "), F.col("source")))
    return df


SIMILAR = " ".join(f"word{i}" for i in range(60))
ODD_ROWS = [
    (1, SIMILAR), (2, SIMILAR + " more"), (2, SIMILAR + " more"), (None, SIMILAR), (None, None), (None, None), (3, ""),
    (4, 'password = "hunter22xyz" ' + "b " * 30), (None, "token: abcdef123456 " + "c " * 40), (5, None),
    (6, "long text " * 20_000), (7, "x"), (7, "y"),
]


def test_operators_leave_columns_of_clashing_names(spark, docs_of):
    docs = clashing(docs_of(ODD_ROWS))
    one, masked = ngram_join.keep_one(docs), secrets.mask(docs)
    assert one.schema == docs.schema and masked.schema == docs.schema
    assert masked.count() == len(ODD_ROWS)
    for r in [*one.collect(), *masked.collect()]:
        assert [r[n] for n in CLASHING] == [f"mine {i} src" for i in range(len(CLASHING))]
    texts = [r["text"] for r in masked.collect() if r["text"]]
    assert not any("hunter22xyz" in t or "abcdef123456" in t for t in texts)
    assert sum("[SECRET]" in t for t in texts) == 2
    # copies with and without id are one group, of which the least id stays
    assert sorted(r["doc_id"] for r in one.collect() if r["text"] and r["text"].startswith("word0")) == [1]


def test_rows_without_id_meet_their_own_set_only(spark, docs_of):
    """Near copies without doc_id: every text is fetched for its own node."""
    rows = [(None, SIMILAR + f" w{i}") for i in range(40)] + [(9, SIMILAR)]
    docs = docs_of(rows).select(F.col("doc_id"), ngram_join.identity()[1].alias("row"), "text")
    nodes = docs.select(F.monotonically_increasing_id().alias("node"), "doc_id", "row", F.lit(0).alias("hi"), F.lit(0).alias("lo"))
    met = docs.join(nodes.select(F.col("doc_id").alias("d"), F.col("row").alias("r")), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")))
    assert met.count() == len(rows)
    found = ngram_join.ngram_join(docs_of(rows)).collect()
    assert len(found) == len(rows) and {r.component_id for r in found} == {9}


@pytest.mark.parametrize("rows", [ODD_ROWS, []], ids=["odd", "empty"])
def test_pipeline_on_odd_documents(spark, smallest, docs_of, tmp_path, rows):
    clashing(docs_of(rows)).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        table(spark, smallest, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = table(spark, str(tmp_path), "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == [*docs_of([]).columns, *CLASHING]
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # 4 (3 with empty or no text, each ending in one id) + the others, each once
    ids = [r.doc_id for r in packed if r.piece == 0]
    assert sorted(str(i) for i in ids) == (sorted("1 3 4 5 6 7 7 None None".split()) if rows else [])
