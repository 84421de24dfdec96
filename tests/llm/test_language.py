import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronofold.llm import language
from tests.llm.cases import documents, empty


def test_grams():
    assert language.grams(None).size == language.grams("12 --!").size == 0
    a, gap = 1, 0
    code = lambda x, y, z: (x * language.SYMBOLS + y) * language.SYMBOLS + z
    assert language.grams("A").tolist() == [code(gap, a, gap)]
    assert language.grams("  a, 1 a ").tolist() == [code(gap, a, gap), code(a, gap, a), code(gap, a, gap)]
    assert language.grams("é").size == 1


def test_a_bundle_is_the_sum_of_bound_letters():
    letters = language.letter_vectors()
    codes = language.grams("some words, some words")
    by_hand = sum(
        letters[0, c // language.SYMBOLS**2].astype(int)
        * letters[1, c // language.SYMBOLS % language.SYMBOLS]
        * letters[2, c % language.SYMBOLS]
        for c in codes.tolist()
    )
    assert (language.bundle(*np.unique(codes, return_counts=True), letters) == by_hand).all()


def test_held_out(spark):
    rows = spark.range(50).select("id", language.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def test_accuracy_on_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = language.held_out(F.col("doc_id"))
    found = language.identify(docs.where(held), language.train_profiles(docs.where(~held)))
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 30 and right > 0.9


def test_profiles_do_not_depend_on_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one, many = language.train_profiles(docs.coalesce(1)), language.train_profiles(docs.repartition(7))
    assert list(one) == list(many) and all((one[k] == many[k]).all() for k in one)


def test_awkward_rows(spark):
    docs = documents(spark, clashes=True)
    profiles = language.train_profiles(docs)
    found = language.identify(docs, profiles)
    assert found.columns == [c for c in docs.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    assert {r["lang_pred"] for r in language.identify(docs, {}).collect()} == {"und"}
    assert language.train_profiles(empty(spark)) == {}
    assert language.identify(empty(spark), profiles).count() == 0
    assert profiles["xx"] == pytest.approx(0)
