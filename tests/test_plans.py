import json

import pytest
from pyspark.sql import functions as F

from chronofold.operators import audit, samples, store
from chronofold.plans import adapters as ad
from chronofold.plans import catalog
from chronofold.plans.build import build_samples, check_samples, read_samples
from chronofold.plans.extract_dataset import extract_dataset
from chronofold.plans.profile_values import profile_values
from chronofold.sources import readers, writers
from tests.helpers import events_df, labels_df, rows_of


@pytest.fixture(scope="module")
def built(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("built"))
    return build_samples(
        ad.stream_events(spark, sf_dir), ad.stream_labels(spark, sf_dir), ad.small_vocab(spark), root,
        codes_metadata=ad.stream_codes(spark), birth_code=ad.STREAM_BIRTH, max_length=16,
        events_per_shard=300, if_exists="rebase", expanded=("sample_events", "nested_samples"),
    )


def test_built_samples_equal_the_queries(spark, sf_dir, built):
    stored = spark.read.parquet(built.sample_events)
    assert rows_of(stored, "sample_id", "seq", "minute") == rows_of(
        catalog.QUERIES["sample_events"](spark, sf_dir), "sample_id", "seq", "minute"
    )
    checked = check_samples(spark, built)
    assert checked.where("not ok").count() == 0 and checked.count() > 3


def test_built_encoding_has_one_row_per_event(spark, built):
    encoded = spark.read.parquet(built.encoded_events)
    assert encoded.where("size(input_ids) <> 16 or size(type_ids) <> 16 or size(place_ids) <> 16").count() == 0
    seqs = spark.read.parquet(built.sample_events).select("seq").distinct()
    assert seqs.join(encoded, "seq", "left_anti").count() == 0


def test_built_nested_samples(spark, built):
    expected = {r.sample_id: (r.n_events, r.label) for r in spark.read.parquet(built.samples).collect()}
    total = {}
    for r in spark.read.parquet(built.nested_samples).collect():
        assert len(r.hi) == len(r.time) == r.n_events and len(r.hi[0]) == 3
        total[r.sample_id] = (total.get(r.sample_id, (0, 0))[0] + r.n_events, r.label)
    assert total == expected


def test_manifest_headers_name_directories(spark, built):
    lines = [r.value for r in spark.read.text(built.manifest).collect()]
    headers = [line for line in lines if "\t" not in line]
    assert headers and all(readers.path_exists(spark, h) for h in headers)


def test_check_sees_missing_blocks(spark, built):
    headers, blocks = spark.read.parquet(built.samples), writers.read_event_blocks(spark, built.event_blocks)
    gone = blocks.orderBy("subject_id").first().subject_id
    found = store.stored_counts(headers, blocks.where(blocks.subject_id != gone))
    bad = audit.audit_counts(found, headers).where("not ok").collect()
    hit = headers.where(headers.subject_id == gone).select("split", "shard").distinct().collect()
    assert hit and {(r.split, r.shard) for r in bad} == {(r.split, r.shard) for r in hit}


def test_audit_sees_a_missing_shard(spark, built):
    rows = spark.read.parquet(built.sample_events)
    gone = rows.select("split", "shard").first()
    kept = rows.where((F.col("split") != gone.split) | (F.col("shard") != gone.shard))
    bad = audit.audit_output(kept, spark.read.parquet(built.samples)).where("not ok").collect()
    assert [(r.split, r.shard) for r in bad] == [(gone.split, gone.shard)]


def test_minutes_start_at_zero_and_never_fall(spark, built):
    rows = spark.read.parquet(built.sample_events)
    assert rows.groupBy("sample_id").agg(F.min("minute").alias("m")).where("m <> 0").count() == 0


def test_existing_output(spark, sf_dir, built):
    args = (ad.stream_events(spark, sf_dir), ad.stream_labels(spark, sf_dir), ad.small_vocab(spark), built.root)
    assert build_samples(*args, if_exists="skip") == built
    with pytest.raises(Exception, match="exist"):
        build_samples(*args)


def test_splits_from_the_input_are_kept(spark, tmp_path):
    events = events_df(spark, [(s, m, "A", 1.0, s * 10 + m, "tuning" if s == 1 else "train") for s in (1, 2) for m in (0, 1)], ", split string")
    labels = labels_df(spark, [(1, 9, True, "tuning"), (2, 9, False, "train"), (2, 8, True, "tuning")], ", split string")
    out = build_samples(events, labels, ad.small_vocab(spark), str(tmp_path / "out"), max_length=8, events_per_shard=1)
    got = rows_of(spark.read.parquet(out.samples), "sample_id", "split", "n_events", "label")
    assert got == [("1_1", "tuning", 2, 1), ("2_1", "train", 2, 0)]
    assert check_samples(spark, out).where("not ok").count() == 0
    assert sorted((r.sample_id, r.part, r.n_events, r.time) for r in read_samples(spark, out).collect()) == [("1_1", 0, 2, [0, 1]), ("2_1", 0, 2, [0, 1])]
    assert not readers.path_exists(spark, out.sample_events) and not readers.path_exists(spark, out.nested_samples)


def test_nested_form(spark, sf_dir, built):
    events, labels = catalog._clean(spark, sf_dir), catalog._labels(spark, sf_dir)
    placed = samples.sample_positions(events, catalog._numbered(spark, sf_dir), labels)
    nested = samples.nested_samples(placed, spark.read.parquet(built.encoded_events), 64)
    expected = {r.sample_id: r.n_events for r in spark.read.parquet(built.samples).collect()}
    total = {}
    for r in nested.collect():
        assert len(r.hi) == len(r.time) == r.n_events <= 64
        assert len(r.hi[0]) == 3 and len(r.hi[0][0]) == 16
        total[r.sample_id] = total.get(r.sample_id, 0) + r.n_events
    assert total == expected


def test_extraction_writes_data_and_metadata(spark, sf_dir, tmp_path):
    root = str(tmp_path / "out")
    config = {"orders": {"subject_id_col": "o_custkey", "placed": {"code": ["ORDER", "col(o_orderpriority)"], "time": "col(o_orderdate)", "numeric_value": "col(o_totalprice)"}}}
    orders = ad.table(spark, sf_dir, "orders")
    extract_dataset({"orders": orders}, config, root, "SYNTHETIC", "1.0", n_shards=2, raw_rows_per_file=400, subject_buckets=3)
    assert writers.read_bucketed(spark, f"{root}/by_subject/orders").count() == orders.count()
    assert len(spark.read.parquet(f"{root}/raw/orders").inputFiles()) > 1
    data = spark.read.parquet(f"{root}/data")
    assert data.columns == ["subject_id", "time", "code", "numeric_value", "split", "shard"]
    assert data.count() == orders.count()
    splits = spark.read.parquet(f"{root}/metadata/subject_splits.parquet")
    assert splits.count() == orders.select("o_custkey").distinct().count()
    shards = spark.read.parquet(f"{root}/metadata/subject_shards.parquet")
    assert shards.count() == splits.count()
    assert data.join(shards, ["subject_id", "split", "shard"], "left_anti").count() == 0
    codes = spark.read.parquet(f"{root}/metadata/codes.parquet")
    assert codes.count() == 0 and codes.columns == ["code", "description", "parent_codes"]
    described = readers.read_dataset_metadata(spark, f"{root}/metadata/dataset.json").first()
    assert json.loads(described.asDict()["dataset_version"]) == 1.0
    # The written data set is itself readable as events.
    back = readers.read_events(spark, f"{root}/data")
    assert back.count() == data.count() and back.select("seq").distinct().count() == data.count()


def test_profile_reports(spark, sf_dir, tmp_path):
    paths = profile_values(ad.result_values(spark, sf_dir), str(tmp_path / "profile"))
    summary = spark.read.option("header", True).csv(paths["category_summary"])
    assert summary.columns == ["category", "total_rows", "unique_values", "examples_joined"]
    rows = summary.agg(F.sum(F.col("total_rows").cast("bigint"))).first()[0]
    assert rows == ad.table(spark, sf_dir, "lineitem").count()
    assert set(paths) == {"category_summary", "category_examples", "top_values", "bucket_summary", "bucket_examples", "bucket_top_values"}


def test_order_events_are_made_before_the_join(spark, sf_dir):
    rows = ad.order_events(spark, sf_dir).select("subject_id", "time", "code", "seq")
    above, below = rows._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")
    assert "l_partkey" in below and "l_partkey" not in above
