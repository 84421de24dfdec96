"""Raw tables to an event data set on disk: data, code metadata, splits and description."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.operators import extract, splits
from chronofold.schema import EVENT_SCHEMA, SPLITS_SCHEMA, SUBJECT
from chronofold.sources.writers import (
    read_bucketed,
    shard_raw,
    write_by_subject,
    write_dataset_metadata,
    write_event_shards,
    write_table,
)


def extract_dataset(
    sources: dict[str, DataFrame],
    config: dict[str, Any],
    root: str,
    name: str,
    version: str,
    n_shards: int = 1,
    code_sources: list[DataFrame] | None = None,
    if_exists: str = "error",
    raw_rows_per_file: int | None = None,
    subject_buckets: int | None = None,
) -> str:
    """Write ``data`` and ``metadata`` below ``root``.

    Mapping, merging, splitting and final typing are one lineage, written once; splits, the map of subjects to
    shards and codes are derived from what was written. With ``raw_rows_per_file`` the sources are first written below
    ``raw`` in files of that size and read from there, so that one large file becomes many tasks. With ``subject_buckets`` the sources are
    written below ``by_subject``, the rows of a subject together, and read from there; ``read_bucketed`` gives them to other jobs.
    """
    spark = next(iter(sources.values())).sparkSession
    default = config.get("subject_id_col", SUBJECT)
    subjects = {source: config[source].get("subject_id_col", default) for source in sources if source in config}
    if raw_rows_per_file is not None:
        for source, df in sources.items():
            shard_raw(df, f"{root}/raw/{source}", raw_rows_per_file, if_exists)
        sources = {source: spark.read.parquet(f"{root}/raw/{source}") for source in sources}
    if subject_buckets is not None:
        for source, subject in subjects.items():
            write_by_subject(sources[source], f"{root}/by_subject/{source}", subject, subject_buckets, if_exists)
            sources = sources | {source: read_bucketed(spark, f"{root}/by_subject/{source}")}
    mapped = extract.extract_events(sources, config)
    final = extract.finalize_events(extract.merge_cohort([mapped], n_shards), EVENT_SCHEMA)
    write_event_shards(final, f"{root}/data", if_exists, in_ranges=True)
    merged = spark.read.parquet(f"{root}/data")
    write_table(
        splits.subject_shards(merged, n_shards), f"{root}/metadata/subject_shards.parquet", None, if_exists
    )
    write_table(
        splits.subject_splits(merged).select(*[F.col(f.name).cast(f.dataType) for f in SPLITS_SCHEMA.fields]),
        f"{root}/metadata/subject_splits.parquet",
        None,
        if_exists,
    )
    write_table(
        extract.code_metadata(merged, code_sources), f"{root}/metadata/codes.parquet", None, if_exists
    )
    write_dataset_metadata(
        extract.dataset_metadata(spark, name, version), f"{root}/metadata/dataset.json", if_exists
    )
    return root
