from datetime import datetime

import pytest

from pyspark.sql import functions as F

from chronofold.operators import extract
from chronofold.sources import writers
from chronofold.schema import CODES_SCHEMA, conform, rendered_columns
from chronofold.sources.readers import load_event_config
from tests.helpers import events_df, rows_of

CONFIG = """subject_id_col: subject_id
synthetic:
  event:
    code: col(code)
    time: col(time)
    numeric_value: col(numeric_value)
  seen:
    code: [SEEN, col(code)]
    time: null
"""


def test_configured_mappings(spark, tmp_path):
    (tmp_path / "events.yaml").write_text(CONFIG)
    config = load_event_config(str(tmp_path / "events.yaml"))
    raw = events_df(spark, [(1, 0, "A", 2.0, 1)])
    got = extract.extract_events({"synthetic": raw}, config)
    assert got.columns == ["subject_id", "time", "code", "numeric_value"]
    assert got.schema["numeric_value"].dataType.simpleString() == "float"
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == [
        (1, datetime(2024, 1, 1), "A", 2.0),
        (1, None, "SEEN//A", None),
    ]


def test_literals_and_errors(spark):
    raw = events_df(spark, [(1, 0, "A", 2.0, 1)])
    got = extract.map_events(raw, {"code": "FIXED", "numeric_value": 3})
    assert rows_of(got, "code", "numeric_value") == [("FIXED", 3)]
    with pytest.raises(ValueError, match="code"):
        extract.map_events(raw, {"time": "col(time)"})
    with pytest.raises(ValueError, match="no event"):
        extract.extract_events({}, {"subject_id_col": "x"})


def test_merge_removes_duplicates(spark):
    a = events_df(spark, [(1, 0, "A", 2.0, 1), (1, 0, "A", 2.0, 1)]).drop("seq")
    merged = extract.merge_cohort([a, a], 3)
    assert merged.count() == 1 and merged.columns[-2:] == ["split", "shard"]


def test_rows_move_once(spark, tmp_path):
    rows = [(s, m, "AB"[m % 2], float(m % 3), 0) for s in range(50) for m in range(40)]
    path = str(tmp_path / "events")
    events_df(spark, rows).drop("seq").union(events_df(spark, rows[::3]).drop("seq")).write.parquet(path)
    source = spark.read.parquet(path)
    final = extract.finalize_events(extract.merge_cohort([source, source], 3)).sortWithinPartitions("split", "shard", "subject_id", "time")
    plan = final._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("Exchange rangepartitioning") == 1
    assert final.count() == len(rows)


def test_ranges_of_a_merge_hold_a_bounded_number_of_rows(spark, tmp_path):
    rows = [(s, m, "A", float(m), 0) for s in range(40) for m in range(50)]
    path = str(tmp_path / "events")
    events_df(spark, rows).drop("seq").write.parquet(path)
    source = spark.read.parquet(path)
    assert extract.range_count(source, 200) == 10 and extract.range_count(source.limit(0)) == 1
    merged = extract.merge_cohort([source, source], 3, extract.range_count(source.union(source), 200))
    sizes = [r["count"] for r in merged.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == len(rows) and len(sizes) > 10 and max(sizes) <= 300


def test_rows_by_subject_do_not_move(spark, tmp_path):
    left, right = (str(tmp_path / n) for n in ("labs", "visits"))
    lab = spark.range(3000).select((F.col("id") % 101).alias("patient"), "id")
    writers.write_by_subject(lab, left, "patient", 4)
    writers.write_by_subject(spark.range(101).select(F.col("id").alias("patient"), (F.col("id") * 2).alias("ward")), right, "patient", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = writers.read_bucketed(spark, left).join(writers.read_bucketed(spark, right), "patient")
        counted = joined.groupBy("patient").agg(F.count(F.lit(1)).alias("n"))
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 3000 and joined.where("ward <> 2 * patient").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_code_metadata_is_typed_and_empty_without_sources(spark):
    events = events_df(spark, [(1, 0, "A", 2.0, 1)])
    empty = extract.code_metadata(events)
    assert empty.count() == 0 and empty.schema == CODES_SCHEMA
    source = spark.createDataFrame([("A", "Alpha"), ("Z", "unused")], "code string, description string")
    assert rows_of(extract.code_metadata(events, [source]), "code", "description") == [("A", "Alpha")]


def test_conform_orders_types_and_keeps_extras(spark):
    df = spark.createDataFrame([("note", 5, "A")], "text string, subject_id int, code string")
    out = conform(df)
    assert out.columns == ["subject_id", "time", "code", "numeric_value", "text"]
    assert out.first().numeric_value is None


def test_rendered_columns_skip_names_with_id(spark):
    df = spark.createDataFrame([(1, "A", 1.0, 2, 3, "x", 1)], "subject_id int, code string, numeric_value double, hadm_id int, width int, text string, seq int")
    assert rendered_columns(df) == ["code", "numeric_value", "text"]
    assert rendered_columns(df, skip=["hadm_id"]) == ["code", "numeric_value", "width", "text"]


def test_null_code_parts_keep_their_place(spark):
    raw = spark.createDataFrame([(1, "a", None), (1, None, "a"), (1, None, None)], "subject_id bigint, x string, y string")
    mapped = extract.map_events(raw, {"code": ["L", "col(x)", "col(y)"]})
    assert sorted(r.code for r in mapped.collect()) == ["L//UNK//UNK", "L//UNK//a", "L//a//UNK"]


def test_code_metadata_has_one_row_per_code(spark):
    events = spark.createDataFrame([("A",), ("A",), ("B",)], "code string")
    two = [spark.createDataFrame([("A", d)], "code string, description string") for d in ("one", "two")]
    assert sorted(map(tuple, extract.code_metadata(events, two).select("code", "description").collect())) == [("A", "two"), ("B", None)]
