"""Counts that check inputs and outputs."""

from __future__ import annotations

import io

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.schema import CODE
from chronofold.sources.readers import any_case, list_files
from chronofold.sources.staging import staged

EMPTY_BYTES = 16 * 1024 * 1024


def rows_per_file(df: DataFrame) -> DataFrame:
    """Row count of every input file that holds rows. ``df`` must come straight from a reader."""
    return (
        df.select(F.col("_metadata.file_path").alias("file"))
        .groupBy("file")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def file_rows(spark: SparkSession, root: str) -> DataFrame:
    """``file``, ``format``, ``bytes``, ``n_rows`` and ``readable`` of every Parquet and CSV file below ``root``, those without rows included (but not files of no byte, which Spark does not list).

    Parquet rows are counted by a scan without columns, which reads footers and no data page; lines of CSV by a scan of
    text, less the header. A Parquet file that yields no row is looked at once more: if its footer says so it is empty, else it is unreadable
    and ``n_rows`` is null. A file that holds no rows is small: one beyond ``EMPTY_BYTES`` that yields none counts as unreadable unopened.
    """
    counted = {
        "parquet": spark.read.schema("_none int").option("ignoreCorruptFiles", True),
        "csv": spark.read.schema("value string"),
    }
    found = []
    for kind, reader in counted.items():
        files = list_files(spark, root, kind).withColumn("format", F.lit(kind))
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", any_case(kind))
        rows = rows_per_file(reader.parquet(root) if kind == "parquet" else reader.text(root))
        less = 0 if kind == "parquet" else 1
        found.append(files.join(rows.withColumn("n_rows", F.greatest(F.col("n_rows") - less, F.lit(0))), "file", "left"))
    parquet, csv = found
    empty = parquet.where(F.col("n_rows").isNull() & (F.col("bytes") <= EMPTY_BYTES)).select("file")
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", any_case("parquet"))
    small = content.load(root).where(F.col("length") <= EMPTY_BYTES).select(F.col("path").alias("file"), "content")
    checked = small.join(staged(empty, "empty"), "file").select("file", _says_empty("content").alias("_empty"))
    parquet = parquet.join(checked, "file", "left").withColumn(
        "n_rows", F.when(F.col("n_rows").isNull() & F.coalesce("_empty", F.lit(False)), 0).otherwise(F.col("n_rows"))
    )
    every = parquet.drop("_empty").unionByName(csv.withColumn("n_rows", F.coalesce("n_rows", F.lit(0))))
    return every.select("file", "format", "bytes", F.col("n_rows").cast("bigint").alias("n_rows"), F.col("n_rows").isNotNull().alias("readable"))


@F.pandas_udf(T.BooleanType())
def _says_empty(content: pd.Series) -> pd.Series:
    """Whether bytes are a Parquet file whose footer counts no row."""

    def empty(file: bytes) -> bool:
        try:
            return pq.ParquetFile(io.BytesIO(file)).metadata.num_rows == 0
        except (pa.ArrowInvalid, OSError):
            return False

    return content.map(empty)


def work_units(events: DataFrame) -> DataFrame:
    """Number of codes: list lengths summed, or non-null codes in the one-code-per-row layout."""
    if isinstance(events.schema[CODE].dataType, T.ArrayType):
        units = F.sum(F.size(CODE))
    else:
        units = F.count(CODE)
    return events.agg(F.coalesce(units, F.lit(0)).cast("bigint").alias("n"))


def shard_counts(sample_rows: DataFrame) -> DataFrame:
    """Samples and events actually stored per split and shard."""
    return (
        sample_rows.groupBy("split", "shard", "sample_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("split", "shard")
        .agg(F.count(F.lit(1)).alias("samples"), F.sum("n").alias("events"))
    )


def audit_output(sample_rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Stored rows against the manifest per split and shard; ``ok`` when both counts agree."""
    return audit_counts(shard_counts(sample_rows), manifest)


def audit_counts(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """Samples and events found per split and shard against the manifest's."""
    promised = manifest.groupBy("split", "shard").agg(
        F.count(F.lit(1)).alias("manifest_samples"), F.sum("n_events").alias("manifest_events")
    )
    return (
        found.join(promised, ["split", "shard"], "full")
        .na.fill(0)
        .withColumn(
            "ok",
            (F.col("samples") == F.col("manifest_samples"))
            & (F.col("events") == F.col("manifest_events")),
        )
    )


def splits_with_output(audit: DataFrame) -> DataFrame:
    """Shards, samples and events per split."""
    return audit.groupBy("split").agg(
        F.count(F.lit(1)).alias("shards"),
        F.sum("samples").alias("samples"),
        F.sum("events").alias("events"),
        F.min("ok").alias("ok"),
    )
