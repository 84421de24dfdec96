import gzip

import pytest
from pyspark.sql import functions as F

from chronofold.operators import audit, extract
from chronofold.sources import readers, staging, writers
from tests.helpers import at, events_df, rows_of


@pytest.fixture
def dataset(spark, tmp_path):
    """Parquet event files in two split directories."""
    root = tmp_path / "data"
    for split, subject in (("train", 1), ("tuning", 2)):
        df = events_df(spark, [(subject, m, f"C{m}", 1.5, 0) for m in range(4)]).drop("seq")
        df.coalesce(1).write.parquet(str(root / split))
    return str(root)


def test_parquet_directory_with_split_and_seq(spark, dataset):
    df = readers.read_events(spark, dataset)
    assert rows_of(df.groupBy("split").agg(F.countDistinct("seq").alias("n")), "split", "n") == [("train", 4), ("tuning", 4)]
    assert df.select("seq").distinct().count() == 8
    first = df.where("split = 'train'").orderBy("seq").select("code").collect()
    assert [r.code for r in first] == ["C0", "C1", "C2", "C3"]


def test_csv_wins_over_parquet(spark, dataset, tmp_path):
    (tmp_path / "data" / "more").mkdir()
    (tmp_path / "data" / "more" / "x.csv").write_text("subject_id,time,code,numeric_value\n5,2024-01-01 00:00:07.5,A,\n")
    assert readers.discover_format(spark, dataset) == "csv"
    row = readers.read_events(spark, dataset).first()
    assert (row.subject_id, row.code, row.numeric_value, row.split) == (5, "A", None, "more")
    assert row.time.microsecond == 500000


def test_unsupported_and_missing_inputs(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    for path in (tmp_path, tmp_path / "a.txt", tmp_path / "none"):
        with pytest.raises(ValueError):
            readers.discover_format(spark, str(path))


def test_single_file_is_named_after_itself(spark, tmp_path):
    path = tmp_path / "part0.csv"
    path.write_text("subject_id,time,code,numeric_value\n5,2024-01-01 00:00:00,A,1\n")
    assert readers.read_events(spark, str(path)).first().split == "part0"


def test_labels_from_csv(spark, tmp_path):
    (tmp_path / "train").mkdir()
    (tmp_path / "train" / "0.csv").write_text(
        "subject_id,prediction_time,boolean_value\n1,2024-01-02 03:04:05,true\n1,2024-01-03 00:00:00,\n"
    )
    df = readers.read_labels(spark, str(tmp_path))
    assert df.schema["prediction_time"].dataType.simpleString() == "timestamp_ntz"
    assert df.schema["boolean_value"].dataType.simpleString() == "boolean"
    assert {r.split for r in df.collect()} == {"train"}


def test_last_code_row_counts(spark, tmp_path):
    path = str(tmp_path / "codes.parquet")
    spark.createDataFrame([("A", "old"), ("B", "b"), ("A", "new")], "code string, description string").coalesce(1).write.parquet(path)
    assert rows_of(readers.read_codes(spark, path), "code", "description") == [("A", "new"), ("B", "b")]


def test_item_dictionaries(spark, tmp_path):
    for folder, name in (("icu", "d_items"), ("hosp", "d_labitems")):
        (tmp_path / folder).mkdir()
        with gzip.open(tmp_path / folder / f"{name}.csv.gz", "wt") as f:
            f.write("itemid,label,unit\n007,Seven,x\n8,Old,x\n8,\"New, better\",x\n")
    items, lab = readers.read_item_dictionaries(spark, str(tmp_path))
    assert rows_of(items, "itemid", "label") == rows_of(lab, "itemid", "label") == [("7", "Seven"), ("8", "New, better")]


def test_rows_and_preview_per_file(spark, dataset):
    df = spark.read.option("recursiveFileLookup", True).parquet(dataset)
    assert sorted(r.n_rows for r in audit.rows_per_file(df).collect()) == [4, 4]
    preview = readers.file_preview(df, 3)
    assert preview.count() == 6 and "code" in preview.columns
    plan = preview._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_differing_columns_are_joined_by_name(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, "x")], "k int, a string").write.parquet(a)
    spark.createDataFrame([(2, "y")], "k int, b string").write.parquet(b)
    assert rows_of(readers.read_diagonal(spark, [a, b]).na.fill("-"), "k", "a", "b") == [(1, "x", "-"), (2, "-", "y")]


def test_work_units_of_both_layouts(spark):
    one = spark.createDataFrame([("A",), (None,), ("B",)], "code string")
    many = spark.createDataFrame([(["A", "B"],), ([],), (["C"],)], "code array<string>")
    assert audit.work_units(one).first().n == 2
    assert audit.work_units(many).first().n == 3


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = spark.range(1), spark.range(2)
    writers.write_table(one, path)
    with pytest.raises(Exception, match="exists"):
        writers.write_table(two, path)
    writers.write_table(two, path, if_exists="skip")
    assert spark.read.parquet(path).count() == 1 and writers.is_complete(spark, path)
    writers.write_table(two, path, if_exists="rebase")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        writers.write_mode("overwrite")


def test_rows_per_file_limit(spark, tmp_path):
    path = str(tmp_path / "raw")
    writers.shard_raw(spark.range(0, 100, 1, 1), path, 30)
    assert len(spark.read.parquet(path).inputFiles()) == 4


def test_event_shards_are_sorted(spark, tmp_path):
    path = str(tmp_path / "events")
    df = extract.subject_sharded(events_df(spark, [(s, -m, "A", 1.0, m) for s in range(20) for m in range(5)]), 2)
    writers.write_event_shards(df, path)
    back = spark.read.parquet(path)
    assert back.count() == 100
    order = back.select("_metadata.file_path", "_metadata.row_index", "subject_id", "time").orderBy("file_path", "row_index").collect()
    by_file = {}
    for r in order:
        by_file.setdefault(r.file_path, []).append((r.subject_id, r.time))
    assert all(rows == sorted(rows) for rows in by_file.values())


def test_manifest_layout(spark, tmp_path):
    path = str(tmp_path / "manifest")
    manifest = spark.createDataFrame([("1_1", 3, "train", "b"), ("2_1", 4, "train", "a"), ("3_1", 5, "tuning", "a")],
                                     "sample_id string, n_events bigint, split string, shard string")
    writers.write_manifest(manifest, path, "/out/")
    lines = [line for f in sorted((tmp_path / "manifest" / "split=train").glob("*.txt")) for line in f.read_text().splitlines()]
    assert lines == ["/out/train", "2_1\t4\ta", "1_1\t3\tb"]


def test_staging_uses_the_folder_named_by_the_session(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert staging.staging_root(spark) == root
    got = staging.staged(spark.range(3), "ids")
    assert got.count() == 3
    assert all(f"{root}/ids-" in f for f in got.inputFiles())


def test_event_time_of_string_columns(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_text("subject_id,time,code,numeric_value\n1,2024-01-01T00:05:00,A,2\n")
    row = readers.read_events(spark, str(path), "subject_id bigint, time string, code string, numeric_value double").first()
    assert row.time == at(5)


def test_suffixes_in_upper_case_are_read(spark, tmp_path):
    (tmp_path / "X.CSV").write_text("subject_id,code\n1,A\n2,B\n")
    assert readers.discover_format(spark, str(tmp_path)) == "csv"
    assert readers.read_table(spark, str(tmp_path)).count() == 2
    assert readers.read_table(spark, str(tmp_path / "X.CSV")).count() == 2


def test_a_job_clears_what_it_staged(spark):
    seen = []

    @staging.clears_staging
    def job(df):
        seen.extend(staging.staged(df, "part").inputFiles())
        return df.count()

    assert job(spark.range(3)) == 3
    assert seen and not any(readers.path_exists(spark, f) for f in seen)
    assert "/job-" not in staging.staged(spark.range(1), "part").inputFiles()[0]


def seqs(spark, path, split_bytes, **options):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = readers.read_table(spark, path, "k int, text string", True, **options)
        found = sorted((r.seq, r.k) for r in readers.with_seq(rows).collect())
        return found, rows.rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_rows_are_numbered_alike_however_files_are_split(spark, tmp_path):
    for name, first in (("b.csv", 1000), ("a.csv", 0)):
        lines = "".join(f"{first + k},{'x' * (k % 90)}\n" for k in range(800))
        (tmp_path / name).write_text("k,text\n" + lines)
    found, many = seqs(spark, str(tmp_path), 3000)
    whole, few = seqs(spark, str(tmp_path), 10**9)
    assert many > few and found == whole
    assert [s & ((1 << readers.FILE_BITS) - 1) for s, _ in whole] == [*range(800), *range(800)]
    assert [k for _, k in whole] == [*range(800), *range(1000, 1800)]


def test_csv_rows_with_quoted_line_ends(spark, tmp_path):
    lines = "".join(f'{k},"one\ntwo, {k}\n"\n' for k in range(500))
    (tmp_path / "a.csv").write_text("k,text\n" + lines)
    found, _ = seqs(spark, str(tmp_path), 1000, multi_line=True)
    assert found == seqs(spark, str(tmp_path), 10**9, multi_line=True)[0] == [(k, k) for k in range(500)]


def test_rows_of_all_files(spark, tmp_path):
    root = tmp_path / "files"
    spark.range(7).coalesce(1).write.parquet(str(root / "seven"))
    spark.range(0).coalesce(1).write.parquet(str(root / "none"))
    (root / "bad.parquet").write_bytes(b"PAR1 not a file PAR1")
    (root / "a.csv").write_text("k\n1\n2\n3")
    (root / "head.csv").write_text("k\n")
    (root / "b.CSV").write_text("k\n1\n")
    found = {r.file.removeprefix(f"file:{root}/"): (r.format, r.n_rows, r.readable) for r in audit.file_rows(spark, str(root)).collect()}
    by_folder = {k.split("/")[0]: v for k, v in found.items()}
    assert by_folder == {
        "seven": ("parquet", 7, True), "none": ("parquet", 0, True), "bad.parquet": ("parquet", None, False),
        "a.csv": ("csv", 3, True), "head.csv": ("csv", 0, True), "b.CSV": ("csv", 1, True),
    }
    assert len(found) == 6


def test_footers_alone_are_read(spark, dataset):
    counted = audit.rows_per_file(spark.read.schema("_none int").option("recursiveFileLookup", True).parquet(dataset))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan

