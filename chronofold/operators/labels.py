"""Label cleaning and sample numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.operators.running import running_totals
from chronofold.operators.skew import lookup_join
from chronofold.schema import LABEL_COLUMN, SUBJECT, TIME, require

PREDICTION_TIME = "prediction_time"
LABEL_PART = 1000


def clean_labels(
    labels: DataFrame, label_column: str = LABEL_COLUMN, dedupe: bool = False
) -> DataFrame:
    """One row per (subject, prediction time, label) with ``copies``.

    Rows without a label are dropped and full duplicates removed before the projection, so rows
    that differ only in an ignored column still count: ``copies`` is their number, and a sample
    repeats its events that often. ``dedupe`` gives every sample one copy. Rows without a subject
    or prediction time can match no event and go too.
    """
    require(labels, SUBJECT, PREDICTION_TIME, label_column)
    kept = labels.na.drop(subset=[label_column, SUBJECT, PREDICTION_TIME])
    if dedupe:
        kept = kept.select(SUBJECT, PREDICTION_TIME, label_column)
    return (
        kept.distinct()
        .groupBy(SUBJECT, PREDICTION_TIME, F.col(label_column).cast("int").alias("label"))
        .agg(F.count(F.lit(1)).cast("int").alias("copies"))
    )


def align_labels(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels whose split agrees with that of the subject's events.

    Stands for reading, for each event file, the label file at the same place: a subject lives in
    one split, and a label of that subject elsewhere is not used.
    """
    homes = events.groupBy(SUBJECT).agg(F.collect_set("split").alias("_splits"))
    return (
        lookup_join(labels, homes, SUBJECT)
        .where(F.array_contains("_splits", F.col("split")))
        .drop("_splits")
    )


def subject_label_lists(labels: DataFrame, part_size: int = LABEL_PART) -> DataFrame:
    """Prediction times and labels of a subject as two parallel lists, in order.

    Subjects with more than ``part_size`` labels come in several rows, numbered by ``part``.
    """
    numbered = running_totals(
        labels.withColumn("n", F.lit(1)), [SUBJECT], PREDICTION_TIME, ["n"], ["label"]
    )
    item = F.struct(PREDICTION_TIME, "label", "copies")
    return (
        numbered.withColumn("part", F.floor(F.col("n_before") / part_size).cast("bigint"))
        .groupBy(SUBJECT, "part")
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .select(
            SUBJECT,
            "part",
            F.col(f"items.{PREDICTION_TIME}").alias("cohort_end"),
            F.col("items.label").alias("cohort_label"),
        )
    )


def explode_label_lists(lists: DataFrame) -> DataFrame:
    """Both lists of ``subject_label_lists`` back to rows, element by element."""
    return lists.select(
        SUBJECT, F.inline(F.arrays_zip("cohort_end", "cohort_label"))
    )


def matched_labels(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels with at least one event, with ``first_time``, the subject's earliest event.

    A label has an event exactly if its prediction time is not before that earliest event.
    """
    first = events.groupBy(SUBJECT).agg(F.min(TIME).alias("first_time"))
    return lookup_join(labels, first, SUBJECT).where(
        F.col("first_time") <= F.col(PREDICTION_TIME)
    )


def _sample_id(number: Column) -> Column:
    return F.concat_ws("_", F.col(SUBJECT).cast("string"), number.cast("string")).alias("sample_id")


def number_samples(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Numbered samples without event counts: see ``sample_headers``.

    Needs of the events only each subject's earliest time, and sorts labels alone.
    """
    matched = matched_labels(events, labels).withColumn("samples", F.lit(1))
    numbered = running_totals(matched, [SUBJECT], PREDICTION_TIME, ["samples"], ["label"])
    number = F.col("samples_before") + 1
    return numbered.select(
        _sample_id(number),
        SUBJECT,
        number.alias("sample_no"),
        PREDICTION_TIME,
        "label",
        "copies",
        "first_time",
    )


def sample_headers(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Numbered samples: one per (subject, prediction time, label) with at least one event.

    ``events`` are clean events, ``labels`` come from ``clean_labels``. Events (as counts per time)
    and labels are laid out on one time line per subject, an event before a label of the same
    time. The number of events up to a prediction time and the number of earlier samples are then
    running totals, and no event-label pair is formed. Samples are numbered in prediction-time
    order, ties by label, after labels without events are gone.
    """
    matched = matched_labels(events, labels)
    kept = ["label", "copies", "first_time"]
    asked = matched.select(
        SUBJECT,
        F.col(PREDICTION_TIME).alias(TIME),
        F.lit(0).cast("bigint").alias("events"),
        F.lit(1).alias("samples"),
        *kept,
    )
    nothing = [F.lit(None).cast(matched.schema[c].dataType).alias(c) for c in kept]
    counted = events.groupBy(SUBJECT, TIME).agg(F.count(F.lit(1)).alias("events"))
    line = counted.select(SUBJECT, TIME, "events", F.lit(0).alias("samples"), *nothing).union(asked)
    totals = events.select(
        SUBJECT, TIME, F.lit(1).cast("bigint").alias("events"), F.lit(0).alias("samples")
    ).union(asked.drop(*kept))
    placed = running_totals(
        line, [SUBJECT], TIME, ["events", "samples"], ["samples", "label"], totals_from=totals
    )
    return (
        placed.where("samples = 1")
        .withColumn("sample_no", F.col("samples_before") + 1)
        .select(
            _sample_id(F.col("sample_no")),
            SUBJECT,
            "sample_no",
            F.col(TIME).alias(PREDICTION_TIME),
            *kept,
            F.col("events_before").alias("base_events"),
            (F.col("events_before") * F.col("copies")).alias("n_events"),
        )
    )
