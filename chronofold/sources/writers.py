"""Sample, event and manifest tables to files."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.operators.store import BLOCK
from chronofold.schema import SUBJECT, TIME
from chronofold.sources.readers import path_exists

ROWS_PER_FILE = 5_000_000
BUCKET_LAYOUT = "n_buckets int, keys array<string>, order array<string>"
# What to do when the output exists: stop, rewrite, or keep it.
MODES = {"error": "errorifexists", "rebase": "overwrite", "skip": "ignore"}


def write_mode(if_exists: str) -> str:
    if if_exists not in MODES:
        raise ValueError(f"if_exists is one of {sorted(MODES)}, not {if_exists!r}")
    return MODES[if_exists]


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once a write to ``path`` has committed."""
    return path_exists(spark, f"{path}/_SUCCESS")


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    if_exists: str = "error",
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    writer = df.write.mode(write_mode(if_exists)).option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_event_shards(events: DataFrame, path: str, if_exists: str = "error", in_ranges: bool = False) -> None:
    """Events under split=/shard= directories, sorted by subject and time.

    Range partitioning by the same order splits a shard, or a single subject, over as many tasks and
    files as its share of the rows asks for. ``in_ranges``: the events lie so already, as ``merge_cohort`` leaves them.
    """
    order = ["split", "shard", SUBJECT, TIME]
    rows = events if in_ranges else events.repartitionByRange(*order)
    write_table(rows.sortWithinPartitions(*order), path, ["split", "shard"], if_exists)


def shard_raw(df: DataFrame, path: str, rows_per_file: int, if_exists: str = "error") -> None:
    """Raw rows as Parquet files of at most ``rows_per_file`` rows; no shuffle."""
    write_table(df, path, None, if_exists, rows_per_file)


def write_samples(sample_rows: DataFrame, path: str, if_exists: str = "error") -> None:
    """Long sample rows under split=/shard= directories, each sample in order.

    A shard is one task's work, as its size is bounded by the event budget. A single sample above
    the budget is spread by ``n_slices``, the number of budgets it fills.
    """
    order = ["split", "shard", "sample_id", "event_time", "copy_no", "seq"]
    slice_no = F.pmod(F.xxhash64("seq", "copy_no"), F.col("n_slices"))
    rows = (
        sample_rows.repartition(F.col("split"), F.col("shard"), slice_no)
        .drop("n_slices")
        .sortWithinPartitions(*order)
    )
    write_table(rows, path, ["split", "shard"], if_exists)


def _bucket_table(path: str) -> str:
    """A name for the table at ``path`` in the session's catalog, which alone keeps the layout of its files."""
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()[:16]}"


def write_bucketed(
    df: DataFrame, path: str, keys: list[str], n_buckets: int, order: list[str] | None = None, if_exists: str = "error"
) -> None:
    """``df`` in ``n_buckets`` files by ``keys``, sorted by these and ``order``, and the layout beside them.

    Tables of one number of buckets are joined by their keys bucket by bucket.
    """
    spark, mode, table = df.sparkSession, write_mode(if_exists), _bucket_table(path)
    if path_exists(spark, path) and mode != "overwrite":
        if mode == "ignore":
            return
        raise FileExistsError(f"{path} exists already")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (
        df.repartition(n_buckets, *keys)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(n_buckets, *keys)
        .sortBy(*keys, *(order or []))
        .saveAsTable(table)
    )
    layout = spark.createDataFrame([(n_buckets, keys, order or [])], BUCKET_LAYOUT)
    layout.coalesce(1).write.mode("overwrite").json(f"{path}_layout")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_bucketed`` wrote, as it lies: joins and groups by its keys do not move it.

    Works in a session that did not write it: the layout is declared anew over the files.
    """
    table, layout = _bucket_table(path), spark.read.schema(BUCKET_LAYOUT).json(f"{path}_layout").first()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    keys, order = ([f"`{c}`" for c in names] for names in (layout["keys"], [*layout["keys"], *layout["order"]]))
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({', '.join(keys)}) "
        f"SORTED BY ({', '.join(order)}) INTO {layout['n_buckets']} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def write_event_blocks(blocks: DataFrame, path: str, n_buckets: int, if_exists: str = "error") -> None:
    """Event blocks by subject and block."""
    write_bucketed(blocks, path, [SUBJECT, BLOCK], n_buckets, None, if_exists)


def read_event_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Event blocks as they lie, read row by row.

    A batch of the columnar reader is 4,096 rows, each of which holds the ids of a whole block here: gigabytes per task. So nested columns are
    read by row for the rest of the session.
    """
    spark.conf.set("spark.sql.parquet.enableNestedColumnVectorizedReader", "false")
    return read_bucketed(spark, path)


def write_by_subject(rows: DataFrame, path: str, subject: str, n_buckets: int, if_exists: str = "error") -> None:
    """Raw rows of each subject together: later stages join such tables, and count or number by subject, without moving them."""
    write_bucketed(rows, path, [subject], n_buckets, None, if_exists)


def write_manifest(manifest: DataFrame, path: str, prefix: str, if_exists: str = "error") -> None:
    """Tab-separated manifest: per split a header line with its directory, then one line a sample.

    ``prefix`` and the name of a split make the path of its directory.

    Range-partitioned by split, shard and sample, so the part files in name order are the manifest
    in order and no task holds all of it.
    """
    lines = manifest.select(
        "split",
        F.lit(1).alias("_kind"),
        "shard",
        "sample_id",
        F.concat_ws("\t", "sample_id", F.col("n_events").cast("string"), F.col("shard").cast("string")).alias("value"),
    )
    headers = manifest.select("split").distinct().select(
        "split",
        F.lit(0).alias("_kind"),
        F.lit("").alias("shard"),
        F.lit("").alias("sample_id"),
        F.concat(F.lit(prefix), F.col("split")).alias("value"),
    )
    order = ["split", "_kind", "shard", "sample_id"]
    (
        lines.withColumn("shard", F.col("shard").cast("string"))
        .unionByName(headers)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("split", "value")
        .write.mode(write_mode(if_exists))
        .partitionBy("split")
        .text(path)
    )


def write_dataset_metadata(metadata: DataFrame, path: str, if_exists: str = "error") -> None:
    metadata.write.mode(write_mode(if_exists)).json(path)
