"""Event codes to descriptions, worked out once per distinct code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.functions.text import ALL_DIGITS_PATTERN
from chronofold.operators.skew import lookup_join
from chronofold.schema import CODE, CODE_SEPARATOR


def code_segments(code: Column) -> Column:
    return F.split(code, CODE_SEPARATOR)


def first_numeric_index(segments: Column) -> Column:
    """1-based place of the first all-digit segment, 0 if there is none."""
    return F.array_position(
        F.transform(segments, lambda s: s.rlike(ALL_DIGITS_PATTERN)), F.lit(True)
    )


def replace_segment(segments: Column, index: Column, text: Column) -> Column:
    """Join the segments again with the one at ``index`` (1-based) replaced."""
    return F.array_join(
        F.transform(segments, lambda s, i: F.when(i + 1 == index, text).otherwise(s)),
        CODE_SEPARATOR,
    )


def one_per_key(table: DataFrame, key: str, value: str) -> DataFrame:
    """``key`` and ``value``, each key once, so that a join to it cannot multiply rows."""
    return table.groupBy(key).agg(F.max(value).alias(value))


def resolve_codes(
    codes: DataFrame,
    metadata: DataFrame | None = None,
    items: DataFrame | None = None,
    lab_items: DataFrame | None = None,
) -> DataFrame:
    """``code``, ``code_text`` and ``resolution`` for a table of distinct codes.

    A non-empty description replaces the code. Otherwise, if both item dictionaries are given, the
    first all-digit segment of ``a//123//b`` is replaced by its label, the first dictionary first.
    A key that comes twice in a table counts once, with the text that sorts last; give ``read_codes`` and
    ``read_items``, which know the order of the rows, where the last row shall count.
    ``resolution`` is description, items, lab_items, none (a numeric segment was not found) or
    plain (there is no numeric segment).
    """
    out = codes.select(CODE).withColumn("_segments", code_segments(F.col(CODE)))
    out = out.withColumn("_index", first_numeric_index(F.col("_segments")))
    out = out.withColumn(
        "_item", F.when(F.col("_index") > 0, F.get("_segments", (F.col("_index") - 1).cast("int")))
    )
    if metadata is not None:
        described = one_per_key(metadata.where("description <> ''"), CODE, "description")
        out = out.join(described, CODE, "left")
    else:
        out = out.withColumn("description", F.lit(None).cast("string"))
    if items is not None and lab_items is not None:
        for table, name in ((items, "_label"), (lab_items, "_lab_label")):
            labelled = one_per_key(table, "itemid", "label").withColumnsRenamed({"itemid": "_item", "label": name})
            out = out.join(labelled, "_item", "left")
    else:
        none = F.lit(None).cast("string")
        out = out.withColumn("_label", none).withColumn("_lab_label", none)
    label = F.coalesce("_label", "_lab_label")
    return out.select(
        CODE,
        F.coalesce(
            F.col("description"),
            F.when(label.isNotNull(), replace_segment(F.col("_segments"), F.col("_index"), label)),
            F.col(CODE),
        ).alias("code_text"),
        F.when(F.col("description").isNotNull(), "description")
        .when(F.col("_label").isNotNull(), "items")
        .when(F.col("_lab_label").isNotNull(), "lab_items")
        .when(F.col("_index") > 0, "none")
        .otherwise("plain")
        .alias("resolution"),
    )


def code_table(events: DataFrame) -> DataFrame:
    """Distinct non-null codes with their row counts."""
    return (
        events.where(F.col(CODE).isNotNull())
        .groupBy(CODE)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def unresolved_codes(
    events: DataFrame,
    metadata: DataFrame | None = None,
    items: DataFrame | None = None,
    lab_items: DataFrame | None = None,
) -> DataFrame:
    """Codes that have a numeric segment but no description and no dictionary entry, with counts."""
    counts = code_table(events)
    resolved = resolve_codes(counts, metadata, items, lab_items)
    return (
        counts.join(resolved.where("resolution = 'none'").select(CODE), CODE)
        .select(CODE, "n_rows")
    )


def describe_events(events: DataFrame, resolved: DataFrame) -> DataFrame:
    """Add the columns of ``resolved`` (one row per code) to the events."""
    return lookup_join(events, resolved, CODE)
