"""Raw tables to the event table by declarative event mappings."""

from __future__ import annotations

import math
import re
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.operators.splits import shard_of, split_of
from chronofold.schema import (
    CODE,
    CODE_SEPARATOR,
    CODES_SCHEMA,
    EVENT_SCHEMA,
    SUBJECT,
    TIME,
    VALUE,
    conform,
    require,
)

MISSING_PART = "UNK"
ROWS_PER_RANGE = 500_000
_COLUMN = re.compile(r"^\s*col\(\s*(.+?)\s*\)\s*$")


def mapped_value(spec: Any) -> Column:
    """``col(x)`` is a column, a list is its parts joined by ``//``, anything else a literal.

    A null part of a list stands as ``MISSING_PART``, so that codes keep their number of parts. A code that
    is one null column stays null.
    """
    if isinstance(spec, (list, tuple)):
        parts = [F.coalesce(mapped_value(s).cast("string"), F.lit(MISSING_PART)) for s in spec]
        return F.concat_ws(CODE_SEPARATOR, *parts)
    named = _COLUMN.match(spec) if isinstance(spec, str) else None
    return F.col(named.group(1)) if named else F.lit(spec)


def map_events(raw: DataFrame, event: dict[str, Any], subject_column: str = SUBJECT) -> DataFrame:
    """One event mapping: ``code``, ``time``, ``numeric_value`` and any further fields."""
    require(raw, subject_column)
    if CODE not in event:
        raise ValueError("an event mapping needs a code")
    fields = {TIME: None, VALUE: None} | event
    return raw.select(
        F.col(subject_column).alias(SUBJECT), *[mapped_value(s).alias(n) for n, s in fields.items()]
    )


def extract_events(
    sources: dict[str, DataFrame], config: dict[str, Any], value_type: T.DataType = T.FloatType()
) -> DataFrame:
    """All event mappings of all sources by name; fields a mapping lacks are null.

    ``config`` is the content of an event-mapping file: an optional ``subject_id_col``, then per
    source table its named event mappings.
    """
    schema = T.StructType(
        [T.StructField(f.name, value_type) if f.name == VALUE else f for f in EVENT_SCHEMA.fields]
    )
    default_subject = config.get("subject_id_col", SUBJECT)
    parts = []
    for source, mappings in config.items():
        if source == "subject_id_col":
            continue
        subject = mappings.get("subject_id_col", default_subject)
        for name, event in mappings.items():
            if name == "subject_id_col":
                continue
            parts.append(conform(map_events(sources[source], event, subject), schema))
    if not parts:
        raise ValueError("the configuration maps no event")
    return union_all(parts)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union by column name; columns missing from a part are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def subject_sharded(df: DataFrame, n_shards: int) -> DataFrame:
    """Split and shard columns; the writer puts the rows of a subject together."""
    return df.withColumn("split", split_of(F.col(SUBJECT))).withColumn(
        "shard", shard_of(F.col(SUBJECT), n_shards)
    )


def range_count(rows: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> int:
    """Tasks that ``rows`` should be spread over, so that a task's memory does not grow with the table; counts them."""
    return max(1, math.ceil(rows.count() / rows_per_range))


def merge_cohort(parts: list[DataFrame], n_shards: int, n_ranges: int | None = None) -> DataFrame:
    """All sources together, duplicates removed, with split and shard, in ranges of these, subject and time.

    Rows meet once: ranges run over all columns, so equal rows share a range and are dropped there, and a subject or a time with many
    rows still spreads over ranges. The ranges are those that ``write_event_shards`` wants, which then only sorts. Without
    ``n_ranges`` rows are counted for their number first.
    """
    rows = subject_sharded(union_all(parts), n_shards)
    first = ["split", "shard", SUBJECT, TIME]
    n_ranges = range_count(rows) if n_ranges is None else n_ranges
    number = [n_ranges] if n_ranges > 1 else []
    return rows.repartitionByRange(*number, *first, *[c for c in rows.columns if c not in first]).dropDuplicates()


def code_metadata(events: DataFrame, sources: list[DataFrame] | None = None) -> DataFrame:
    """Code descriptions of the codes in use, one row per code; without metadata sources a typed, empty table."""
    if not sources:
        return events.sparkSession.createDataFrame([], CODES_SCHEMA)
    others = [c for c in CODES_SCHEMA.names if c != CODE]
    described = (
        conform(union_all(sources), CODES_SCHEMA, keep_extra=False)
        .groupBy(CODE)
        .agg(F.max(F.struct("description", *[c for c in others if c != "description"])).alias("_last"))
        .select(CODE, "_last.*")
    )
    used = events.select(CODE).where(F.col(CODE).isNotNull()).distinct()
    return used.join(described, CODE, "left").select(*CODES_SCHEMA.names)


def finalize_events(events: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Final column types and order."""
    return conform(events, schema)


def dataset_metadata(spark, name: str, version: str) -> DataFrame:
    return spark.createDataFrame(
        [(name, version)], "dataset_name string, dataset_version string"
    )
