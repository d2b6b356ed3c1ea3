"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import materialize, scratch_root
from . import (
    align,
    chat,
    decontaminate,
    ngram_join,
    pack,
    repair,
    secrets,
    shard,
    token_count,
    token_file,
    toxicity,
    transducer,
)
from .common import table
from .near_vectors import near_vectors

Query = Callable[[SparkSession, str], DataFrame]
TOKEN_LIMIT = 1024
#: a conversation whose texts hold what looks like control strings
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op3_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = [f"SELECT -7L, {i}, '{role}'" for i, role in enumerate(("user", "assistant"))]
    control = spark.sql(" UNION ALL ".join(added)).toDF("conv_id", "turn", "role").withColumn("text", F.lit(CONTROL_TEXT))
    messages = texts.unionByName(control).withColumn("parts", chat.text_parts(F.col("text")))
    turns = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return (
        chat.format_chat(messages)
        .select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                chat.read_loss(F.col("formatted"), F.col("mask")).alias("loss"))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(turns, 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def _spans_of_kind(kind: int) -> Column:
    # the function may have no second parameter: it would be given the index of the span
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != secrets.KINDS.index(secrets.LOOSE))
    counts = [_spans_of_kind(k).alias(f"n_{secrets.KINDS[k]}") for k in range(3)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text("spans").alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard.place(table(spark, sf_dir, "documents"), "doc_id", shard.shard_names(shard.SHARDS), shard.SIZE)
    return placed.select("doc_id", "slot", "shard")


def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_root(spark)}/token-file-{uuid.uuid4().hex}"
    token_file.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_file.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").cast("long").alias("ids_crc32")
    )


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = repair.damage(table(spark, sf_dir, "conversations"))
    return repair.digests(damaged, materialize(repair.audits(damaged), "audits"))


def op12_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.digest(table(spark, sf_dir, "documents"), tokenizer_path())


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, other = table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model")
    return align.align(docs, tokenizer_path(), other, hashed=True).withColumnRenamed("groups", "groups_sha256")


def all_queries() -> dict[str, Query]:
    found = [
        op1_decontaminate,
        op2_ngram_join,
        op3_token_count,
        op4_toxicity,
        op5_chat_format,
        op6_near_vectors,
        op7_secrets,
        op8_shard,
        op9_token_file,
        op10_best_fit,
        op11_repair,
        op12_transducer,
        op13_align,
    ]
    return {f.__name__: f for f in found}
