"""Texts that are no valid UTF-8: every operator that reads them in Python takes them as if the bad bytes were U+FFFD."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from chronofold.llm import language, packing, secret_scan, simhash, token_files


@pytest.fixture(scope="module")
def pair(spark):
    """The same texts with bad bytes and with U+FFFD."""
    bad = spark.sql("SELECT id AS doc_id, cast(concat(cast('the red password = abcdefgh ' AS binary), x'ff', cast(id AS string), x'c3') AS string) AS text, 'en' AS lang, 'a' AS source FROM range(5)")
    good = bad.withColumn("text", F.concat(F.lit("the red password = abcdefgh \ufffd"), F.col("doc_id").cast("string"), F.lit("\ufffd")))
    return bad, good


def same(pair, run):
    found = [sorted(map(tuple, run(docs).collect()), key=str) for docs in pair]
    assert found[0] == found[1] and len(found[0]) == 5


def test_fingerprints(pair):
    same(pair, simhash.near_duplicates)


def test_packing(pair):
    path = public_tokenizers.path("word_bpe_49k.json")
    same(pair, lambda d: packing.pack_documents(d.coalesce(1), path).groupBy("doc_id").agg(F.sum("length"), F.max("doc_tokens")))


def test_language(pair):
    def run(docs):
        return language.identify(docs.select("doc_id", "text"), language.train_profiles(docs))

    same(pair, run)


def test_token_files(pair, spark, tmp_path):
    folders = iter("ab")

    def run(docs):
        folder = str(tmp_path / next(folders))
        token_files.write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
        return token_files.read_token_files(spark, folder)

    same(pair, run)


def test_secrets(pair):
    same(pair, secret_scan.scan_secrets)
