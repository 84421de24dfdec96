import random
import re

from chronofold.llm import language, mixing, pipeline, simhash
from pyspark.sql import functions as F
from tests.llm.cases import documents, empty
from tests.llm.test_simhash import by_hand, classes
from tests.llm.test_tokens import check_packed


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept = dict(rows)
    for name, stage in pipeline.STAGES[:-1]:
        before = spark.createDataFrame(list(kept.values()), docs.schema)
        made = stage(spark, before, sf_dir)
        assert made.columns == docs.columns
        after = {r["doc_id"]: r for r in made.collect()}
        assert all(rows[k] == r for k, r in after.items())
        if name == "language":
            assert set(kept) - set(after) == {k for k, r in kept.items() if not any(c.isalpha() for c in r["text"] or "")}
        if name == "exact_dedup":
            key = {k: re.sub(r"[\x20\x09-\x0d]+", "", r["text"]) for k, r in kept.items()}
            assert len(after) == len(set(key.values())) == len({key[k] for k in after})
        if name == "near_dedup":
            prints = [by_hand(r["text"]) for r in kept.values()]
            roots = classes(prints, lambda a, b: (a ^ b).bit_count() <= 4)
            assert set(after) == {min(k for k, q in zip(kept, roots, strict=True) if q == root) for root in set(roots)}
        if name == "mixing":
            assert set(after) == set(kept)
        kept = after
    packed = pipeline.STAGES[-1][1](spark, spark.createDataFrame(list(kept.values()), docs.schema), sf_dir).collect()
    check_packed(packed, [(r["doc_id"], r["text"]) for r in kept.values()], pipeline.TOKENIZER)


def test_run(spark, sf_dir):
    found = pipeline.run(spark, sf_dir)
    assert found.agg(F.countDistinct("doc_id")).first()[0] > 0


def test_empty_documents(spark):
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty(spark), "").count() == 0


def test_awkward_documents(spark):
    docs = documents(spark, clashes=True)
    for _, stage in pipeline.STAGES[:-1]:
        made = stage(spark, docs, "")
        assert made.columns == docs.columns
        docs = spark.createDataFrame(made.collect(), docs.schema)
    ids = {r["doc_id"] for r in docs.collect()}
    assert {0, 5, 7, 101, None} <= ids and not {1, 2, 3, 4, 8, 100} & ids
    assert pipeline.pack(spark, docs, "").count() > 0


def test_unlabelled_documents_all_stay(spark):
    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert pipeline.identify_language(spark, docs, "").count() == docs.count()


def test_other_languages_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = language.train_profiles(docs)
    kept = language.accepted(docs, profiles, ["de", "fr"]).collect()
    assert {r["lang"] for r in kept} >= {"de", "fr"} and sum(r["lang"] in ("de", "fr") for r in kept) > 0.95 * len(kept)
    chance = "".join(chr(0x4E00 + i * 7919 % 20_000) for i in range(400))
    odd = documents(spark, [(1, chance, None, "a"), (2, "der", None, "a"), (3, None, None, "a"), (4, "12", "de", "a")])
    assert [r["doc_id"] for r in language.accepted(odd, profiles).collect()] == [2]


def test_near_copies_of_one_id(spark):
    a, b = "the red house by the sea " * 9, "sky river stone tree green blue red on tion er thing of and"
    docs = documents(spark, [(5, a, "en", "a"), (8, a + "end", "en", "a"), (8, b, "en", "a"), (9, b, "en", "a"), (None, b, "en", "a")])
    assert sorted(r["doc_id"] or 0 for r in simhash.one_of_each(docs).collect()) in ([0, 5, 8, 8], [0, 5, 8])


def test_constants():
    assert [n for n, _ in pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert (simhash.SHINGLE_WORDS, simhash.RADIUS, language.UNKNOWN) == (4, 4, "und")


def test_packed_sequences_follow_the_mixture(spark, tmp_path):
    rng = random.Random(15)
    # Source b ends half-way and packs small on disk, so the late files are the largest and are read first.
    rows = [(k, " ".join(f"w{rng.randrange(10**9)}" for _ in range(1000)), "en", "a") for k in range(600)]
    rows += [(1000 + k, "the red house " * 700, "en", "b") for k in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = mixing.in_mixture_order(documents(spark, rows), weights={"a": 0.5, "b": 0.5}, block_chars=50_000)
        laid.write.parquet(str(tmp_path / "mixed"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    docs = spark.read.parquet(str(tmp_path / "mixed"))
    file_of = {r["doc_id"]: r["file_name"] for r in docs.select("doc_id", "_metadata.file_name").collect()}
    assert len(set(file_of.values())) > 2
    packed = pipeline.pack(spark, docs, "").collect()
    check_packed(packed, [(i, t) for i, t, *_ in rows], pipeline.TOKENIZER)
    packed.sort(key=lambda r: (r["sequence_id"], r["offset"]))
    names = [file_of[r["doc_id"]] for r in packed]
    assert names == sorted(names)
    chars = {i: len(t) for i, t, *_ in rows}
    texts = {i: s for i, _, _, s in rows}
    whole = sum(chars.values())
    done, at_b = 0.0, 0.0
    for r in packed:  # while both sources last, half of each prefix is of b
        n = chars[r["doc_id"]] * r["length"] / r["doc_tokens"]
        done, at_b = done + n, at_b + (n if texts[r["doc_id"]] == "b" else 0)
        if 0.3 * whole < done < 0.5 * whole:
            assert 0.3 < at_b / done < 0.7
