"""From raw documents to packed sequences: five stages, each stored before the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep
the columns of ``documents``. Rows without doc_id or text pass through like others; the
operators' docstrings say how they treat them. Columns that the stages need for
themselves are named with a leading underscore and removed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cladeweave.llm import decontaminate, ngram_join, pack, secrets, toxicity
from cladeweave.llm.common import table
from cladeweave.llm.queries import tokenizer_path
from cladeweave.runtime import materialize

#: SQL cannot express a learned score or a tokenizer
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    machine = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, machine)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, that of the least doc_id."""
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the values of secrets masked in their texts."""
    return secrets.mask(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents packed into sequences."""
    return pack.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_similar),
    ("decontaminate", drop_contaminated),
    ("secrets", mask_secrets),
    ("best_fit", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again as the documents of the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
