"""A corpus from raw documents to packed sequences, in stages that each write what they keep."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm import exact_dedup, language, mixing, packing, simhash
from chronofold.sources.staging import staging_root

TOKENIZER = "word_bpe_49k.json"
CACHED_PIECES = 100_000  # about 20 MB per Python worker: earlier stages have filled the executors' heaps


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in a language that the labelled ones teach: see ``language.accepted``, which states what goes.

    Profiles are learnt from the rows with a lang outside the held-out quarter; a table without such rows is kept whole.
    """
    profiles = language.train_profiles(docs.where(~language.held_out(F.col("doc_id"))))
    return language.accepted(docs, profiles)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without white space: the longest, of these the one of the smallest id.

    Null counts as empty; empty texts are one group. Rows that are equal in all of this leave one.
    """
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the SimHash operator finds, with its own shingle length and radius: the one of the smallest id.

    See ``simhash.one_of_each`` for null ids, repeated ids and empty texts.
    """
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, laid out in the order of the mixture, which the packing stage numbers its sequences in."""
    return mixing.in_mixture_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences numbered in the order of the mixture, which the names of the files carry."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), cached_pieces=CACHED_PIECES, by_file=True)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

ORACLE_SQL = None  # language profiles, components and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again.

    Null, empty and repeated rows fare as the stages say; an empty table gives no row. The written stages stay until the staging folder is cleared.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{staging_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
