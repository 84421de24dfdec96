"""Event, label, code and dictionary tables from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.operators.extract import union_all
from chronofold.operators.running import range_totals, ranged
from chronofold.schema import CODE, SEQ, SUBJECT, TIME, VALUE
from chronofold.sources.staging import staged

FORMATS = ("csv", "parquet")
FILE_BITS = 36  # rows of one file that a seq value can tell apart: 2^36


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return bool(fs.exists(hadoop_path))


def list_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """``file`` and ``bytes`` of all files with the suffix below ``root``; Spark lists directories in parallel and opens no file."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", any_case(suffix))
    return reader.load(root).select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def any_case(suffix: str) -> str:
    """File-name pattern for a suffix in upper or lower case."""
    return "*." + "".join(f"[{c}{c.upper()}]" for c in suffix)


def discover_format(spark: SparkSession, root: str) -> str:
    """``csv`` or ``parquet``: a directory with any CSV file below it counts as CSV only."""
    if not path_exists(spark, root):
        raise ValueError(f"no such path: {root}")
    hadoop_path, fs = _path(spark, root)
    if fs.getFileStatus(hadoop_path).isFile():
        suffix = root.rsplit(".", 1)[-1].lower()
        if suffix not in FORMATS:
            raise ValueError(f"unsupported file format: .{suffix}")
        return suffix
    for suffix in FORMATS:
        if not list_files(spark, root, suffix).isEmpty():
            return suffix
    raise ValueError(f"{root} holds no .csv or .parquet file")


def read_table(
    spark: SparkSession,
    root: str,
    schema: T.StructType | str | None = None,
    with_origin: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """A CSV or Parquet file, or all such files below a directory, sub-directories included.

    Without ``schema`` CSV types are inferred, which costs a pass over the data, and the footers of all Parquet files are read, whose
    columns may differ; give one for large inputs. ``multi_line`` lets quoted CSV values hold line ends; each file is then one task. ``with_origin`` adds
    ``_file`` and, for Parquet, ``_row`` (place within the file), for CSV ``_block`` and ``_scan`` (where its block of the file starts, and a number that grows within the block).
    """
    kind = discover_format(spark, root)
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", any_case(kind))
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        reader = reader.option("header", True).option("multiLine", multi_line)
        if schema is None:
            reader = reader.option("inferSchema", True).option("preferDate", False).option(
                "timestampType", "TIMESTAMP_NTZ"
            )
        df = reader.csv(root)
    else:
        df = reader.option("mergeSchema", True).parquet(root)
    if not with_origin:
        return df
    origin = [F.col("_metadata.file_path").alias("_file")]
    if kind == "parquet":
        origin.append(F.col("_metadata.row_index").alias("_row"))
    else:
        origin += [F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_scan")]
    return df.select("*", *origin)


def with_row(rows: DataFrame) -> DataFrame:
    """CSV rows from ``read_table(..., with_origin=True)`` with ``_row``, the place within the file, however files are split.

    A scan meets the rows of a block of a file in order, so a row's place in its block is its distance from the block's first
    row. A first pass counts the rows of each block; the blocks before it, a few thousand in the largest file, then say where it starts.
    """
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("_file", "_block").agg(F.min("_scan").alias("_first"), F.count(F.lit(1)).alias("_n"))
    starts = blocks.select(
        "_file", "_block", (F.col("_first") - F.coalesce(F.sum("_n").over(earlier), F.lit(0))).alias("_zero")
    )
    kept = [c for c in rows.columns if c not in ("_block", "_scan")]
    return rows.join(staged(starts, "blocks"), ["_file", "_block"]).select(*kept, (F.col("_scan") - F.col("_zero")).alias("_row"))


def with_seq(events: DataFrame) -> DataFrame:
    """Number rows in input order: files by path, rows by place in the file; the same on every run.

    ``events`` must come from ``read_table(..., with_origin=True)``. File names are sorted and numbered as a table.
    """
    rows = events if "_row" in events.columns else with_row(events)
    files = range_totals(ranged(rows.select("_file").distinct(), ["_file"]).withColumn("_file_no", F.lit(1)), [], ["_file_no"])
    ordinal = files.select("_file", F.col("_file_no_before").alias("_file_no"))
    return (
        rows.join(ordinal, "_file")
        .withColumn(SEQ, F.shiftleft("_file_no", FILE_BITS) + F.col("_row"))
        .drop("_file", "_file_no", "_row")
    )


def split_from_path(root: str, file: Column) -> Column:
    """Output name of a file: its sub-directory below ``root``, else its name without suffix."""
    base = root.rstrip("/").rsplit("/", 1)[-1]
    below = F.regexp_extract(file, rf"/{_quoted(base)}/(.*)$", 1)
    directory = F.regexp_extract(below, r"^(.*)/[^/]+$", 1)
    stem = F.regexp_extract(file, r"([^/]+?)(?:\.[^./]+)?$", 1)
    return F.when(directory != "", directory).otherwise(stem)


def _quoted(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != "_" else c for c in text)


def read_events(
    spark: SparkSession, root: str, schema: T.StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """Event files with ``split`` from their place below ``root`` and ``seq`` from the input order.

    String times, as inferred from some CSV files, are parsed.
    """
    df = with_origin_columns(read_table(spark, root, schema, True, multi_line), root)
    if isinstance(df.schema[TIME].dataType, T.StringType):
        df = df.withColumn(TIME, F.to_timestamp_ntz(TIME))
    elif not isinstance(df.schema[TIME].dataType, T.TimestampNTZType):
        df = df.withColumn(TIME, F.col(TIME).cast("timestamp_ntz"))
    if VALUE in df.columns:
        df = df.withColumn(VALUE, F.col(VALUE).cast("double"))
    return df.withColumn(SUBJECT, F.col(SUBJECT).cast("bigint"))


def with_origin_columns(df: DataFrame, root: str) -> DataFrame:
    return with_seq(df.withColumn("split", split_from_path(root, F.col("_file"))))


def read_labels(
    spark: SparkSession, root: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Label files, all below ``root``, with ``split`` from their place."""
    df = read_table(spark, root, schema, with_origin=True)
    df = df.withColumn("split", split_from_path(root, F.col("_file")))
    df = df.drop("_file", "_row", "_block", "_scan")
    if isinstance(df.schema["prediction_time"].dataType, T.StringType):
        df = df.withColumn("prediction_time", F.to_timestamp_ntz("prediction_time"))
    return df.withColumn("prediction_time", F.col("prediction_time").cast("timestamp_ntz"))


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """Code descriptions, one row per code; of repeated codes the last row counts."""
    df = spark.read.parquet(path)
    place = F.struct("_metadata.file_path", "_metadata.row_index")
    return (
        df.select(CODE, "description", place.alias("_place"))
        .groupBy(CODE)
        .agg(F.max_by("description", "_place").alias("description"))
    )


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Item dictionary from (gzip) CSV: ``itemid`` as text and ``label``, the last row per id."""
    df = spark.read.option("header", True).csv(path)
    return (
        df.select(
            F.col("itemid").try_cast("bigint").cast("string").alias("itemid"),
            "label",
            F.monotonically_increasing_id().alias("_place"),
        )
        .groupBy("itemid")
        .agg(F.max_by("label", "_place").alias("label"))
    )


def read_item_dictionaries(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The two item dictionaries below a clinical database directory."""
    return (
        read_items(spark, f"{root}/icu/d_items.csv.gz"),
        read_items(spark, f"{root}/hosp/d_labitems.csv.gz"),
    )


def read_dataset_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def read_diagonal(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several Parquet inputs with differing columns as one table."""
    return union_all([spark.read.parquet(p) for p in paths])


def file_preview(df: DataFrame, n: int = 6) -> DataFrame:
    """The first ``n`` rows of every Parquet file with its name. ``df`` comes straight from a reader.

    The place of a row is known to the scan, so this is a filter: no window, no shuffle.
    """
    return df.where(F.col("_metadata.row_index") < n).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row_no"),
        "*",
    )


def load_event_config(path: str) -> dict:
    """An event-mapping file in YAML."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)
