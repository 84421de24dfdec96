"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm import (
    centroids,
    chat,
    exact_dedup,
    language,
    mixing,
    nearest,
    packing,
    pipeline,
    pivot_index,
    prefix_trie,
    secret_scan,
    simhash,
    token_files,
    urls,
)
from chronofold.sources.staging import staging_root

Query = Callable[[SparkSession, str], DataFrame]

# The rules of the URL query.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark, d):
    """Where each document stands in the mixture of all sources."""
    return mixing.mix(_table(spark, d, "documents").select("doc_id", "source", "text")).drop("text")


def op2_simhash(spark, d):
    return simhash.near_duplicates(_table(spark, d, "documents"))


def op3_urls(spark, d):
    return urls.judge_urls(_table(spark, d, "pages"), urls.rule_table(spark, URL_RULES))


def op4_packing(spark, d):
    return packing.pack_documents(_table(spark, d, "documents"), _tokenizer("word_bpe_49k.json"))


def op5_language(spark, d):
    docs = _table(spark, d, "documents")
    held = language.held_out(F.col("doc_id"))
    profiles = language.train_profiles(docs.where(~held))
    found = language.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op6_token_files(spark, d):
    folder = f"{staging_root(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_token_files(_table(spark, d, "documents"), folder, _tokenizer("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, folder)


def op7_exact_dedup(spark, d):
    return exact_dedup.duplicate_groups(_table(spark, d, "documents"))


def op8_nearest(spark, d):
    return nearest.nearest(_table(spark, d, "embeddings"))


def op9_chat(spark, d):
    """All conversations as rows of turns, and one as a record of messages."""
    message = "struct<role:string,content:string>"
    said = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(1).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.array(*[F.struct(F.lit(r).alias("role"), said.alias("content")) for r in ("user", "assistant")]).cast(f"array<{message}>").alias("messages"),
    )
    records = _table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra, allowMissingColumns=True)
    formatted = chat.format_turns(chat.canonical_turns(records))
    whole = formatted.select("conv_id", F.length("formatted").cast("bigint").alias("formatted_chars"), "formatted", "loss_mask")
    back = chat.read_back(whole, keep=("conv_id", "formatted_chars"))
    learnt = F.array_join("learnt", "")
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(learnt).cast("bigint").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_secrets(spark, d):
    return secret_scan.scan_secrets(_table(spark, d, "documents"))


def op11_pivot_index(spark, d):
    return pivot_index.near_copies(_table(spark, d, "embeddings"))


def op12_centroids(spark, d):
    return centroids.cluster_vectors(_table(spark, d, "embeddings"))


def op13_prefix_trie(spark, d):
    return prefix_trie.prefix_trie(_table(spark, d, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_simhash, op3_urls, op4_packing, op5_language, op6_token_files, op7_exact_dedup, op8_nearest,
        op9_chat, op10_secrets, op11_pivot_index, op12_centroids, op13_prefix_trie,
    )
} | {"pipeline": pipeline.run}
