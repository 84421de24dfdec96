"""Sample membership: which events belong to which sample, and in what order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofold.functions.clock import minutes_between
from chronofold.operators.events import number_events
from chronofold.operators.labels import PREDICTION_TIME
from chronofold.operators.skew import ROWS_PER_TASK, by_weight, grid_join, heavy_keys
from chronofold.schema import DEBUG_EVENTS, SEQ, SUBJECT, TIME

SEQUENCE_PART = 1024
TAILS_PER_SUBJECT = 64


def match_events(
    events: DataFrame,
    headers: DataFrame,
    labels: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
    counted_on: DataFrame | None = None,
) -> DataFrame:
    """Every event with every sample of its subject whose prediction time is not earlier.

    Only the columns of ``events`` passed in travel through the fan-out: give it the key and time,
    and attach wide columns afterwards. Heavy subjects are counted on ``labels``, which are cheaper to
    read than the headers made from them.
    """
    return grid_join(
        events,
        headers,
        SUBJECT,
        F.col(TIME) <= F.col(PREDICTION_TIME),
        F.xxhash64(SEQ),
        F.xxhash64("sample_id"),
        events if counted_on is None else counted_on,
        labels,
        rows_per_task,
    )


def sample_events(
    events: DataFrame,
    headers: DataFrame,
    labels: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
    carry: list[str] | None = None,
) -> DataFrame:
    """Long form of the samples: one row per sample and event, with the minute since its first event.

    All samples of a subject start at the subject's earliest event, so the minute needs no window
    over the matched rows. Read a sample in (event_time, copy_no, seq) order. ``carry`` names header
    columns to keep.
    """
    carry = carry or []
    slim = events.select(SUBJECT, TIME, SEQ)
    keys = headers.select(SUBJECT, "sample_id", PREDICTION_TIME, "copies", "first_time", *carry)
    return match_events(slim, keys, labels, rows_per_task).select(
        *carry,
        "sample_id",
        SUBJECT,
        SEQ,
        F.col(TIME).alias("event_time"),
        minutes_between(F.col("first_time"), F.col(TIME)).alias("minute"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no"),
    )


def sample_positions(
    events: DataFrame,
    headers: DataFrame,
    labels: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``sample_events`` plus ``pos``, the 1-based place of the row within its sample.

    A sample is a prefix of its subject's events, so the place follows from the event's ordinal in
    the subject: whole earlier times repeat per copy, then the copies of the event's own time.
    """
    numbered = number_events(events.select(SUBJECT, TIME, SEQ))
    keys = headers.select(SUBJECT, "sample_id", PREDICTION_TIME, "copies", "first_time")
    matched = match_events(numbered, keys, labels, rows_per_task, counted_on=events).select(
        "*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no")
    )
    return matched.select(
        "sample_id",
        SUBJECT,
        SEQ,
        F.col(TIME).alias("event_time"),
        minutes_between(F.col("first_time"), F.col(TIME)).alias("minute"),
        "copy_no",
        (
            F.col("group_start") * F.col("copies")
            + (F.col("copy_no") - 1) * F.col("group_size")
            + F.col("group_index")
        ).alias("pos"),
    )


def sample_sequences(positions: DataFrame, part_size: int = SEQUENCE_PART) -> DataFrame:
    """Minutes and event keys of a sample as parallel lists in sample order.

    A sample of up to ``part_size`` events is one row; a longer one continues in rows with
    ``part`` 1, 2, ... so that no row has to hold a whole history.
    """
    item = F.struct("pos", "minute", SEQ)
    return (
        positions.withColumn("part", F.floor((F.col("pos") - 1) / part_size).cast("bigint"))
        .groupBy("sample_id", "part")
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .select(
            "sample_id",
            "part",
            F.col("items.minute").alias("minutes"),
            F.col(f"items.{SEQ}").alias("event_keys"),
        )
    )


def sample_tail(
    events: DataFrame,
    headers: DataFrame,
    labels: DataFrame,
    n: int = DEBUG_EVENTS,
    rows_per_task: int = ROWS_PER_TASK,
    tails_per_subject: int = TAILS_PER_SUBJECT,
) -> DataFrame:
    """The last ``n`` rows of every sample, minutes counted from the first row kept (debug view).

    A sample's last rows come from its last ``n`` events. Subjects with up to ``tails_per_subject`` * ``n`` events are matched by
    subject, as they lie after numbering. Event ordinals of longer ones are cut into blocks of ``n``: the last events of a sample lie in
    two blocks, so a sample meets a bounded number of events instead of its whole history either way.
    """
    numbered = number_events(events.select(SUBJECT, TIME, SEQ))
    asked = headers.select(SUBJECT, "sample_id", "copies", "base_events", "n_events")
    heavy = heavy_keys(events, [SUBJECT], tails_per_subject * n)
    if heavy is None:
        return _tail_rows(_last_events(numbered, asked, events, labels, n, rows_per_task), n)
    (short, long), (few, many) = by_weight(numbered, heavy), by_weight(asked, heavy)
    matched = _last_events(short, few, by_weight(events, heavy)[0], labels, n, rows_per_task)
    return _tail_rows(matched, n).unionByName(_tail_rows(_last_blocks(long, many, labels, n, rows_per_task), n))


def _last_events(
    numbered: DataFrame, asked: DataFrame, events: DataFrame, labels: DataFrame, n: int, rows_per_task: int
) -> DataFrame:
    last = (F.col("event_no") <= F.col("base_events")) & (F.col("event_no") > F.col("base_events") - n)
    return grid_join(
        numbered, asked, SUBJECT, last, F.xxhash64(SEQ), F.xxhash64("sample_id"), events, labels, rows_per_task
    )


def _last_blocks(numbered: DataFrame, asked: DataFrame, labels: DataFrame, n: int, rows_per_task: int) -> DataFrame:
    blocks = numbered.withColumn("_block", F.floor((F.col("event_no") - 1) / n))
    last_block = F.floor((F.col("base_events") - 1) / n)
    wanted = asked.withColumn(
        "_wanted", F.explode(F.sequence(F.greatest(last_block - 1, F.lit(0)), last_block))
    )
    # A block has at most n events, so only the sample side can be heavy.
    return grid_join(
        blocks,
        wanted,
        SUBJECT,
        (F.col("_block") == F.col("_wanted")) & (F.col("event_no") <= F.col("base_events")),
        F.xxhash64(SEQ),
        F.xxhash64("sample_id"),
        None,
        labels,
        rows_per_task,
    )


def _tail_rows(matched: DataFrame, n: int) -> DataFrame:
    # Each copy of a time holds at least one row, so only the last n copies can reach the tail.
    copy_no = F.explode(
        F.sequence(F.greatest(F.col("copies") - (n - 1), F.lit(1)), F.col("copies"))
    )
    rows = (
        matched.select("*", copy_no.alias("copy_no"))
        .withColumn(
            "pos",
            F.col("group_start") * F.col("copies")
            + (F.col("copy_no") - 1) * F.col("group_size")
            + F.col("group_index"),
        )
        .where(F.col("pos") > F.col("n_events") - n)
    )
    # At most n rows per sample are left. Matched by subject alone, they lie together already.
    tail_start = F.min(TIME).over(Window.partitionBy(SUBJECT, "sample_id"))
    return rows.select(
        "sample_id", "pos", SEQ, "copy_no", minutes_between(tail_start, F.col(TIME)).alias("minute")
    )


def attach_encoded(rows: DataFrame, encoded: DataFrame) -> DataFrame:
    """Sample rows with the id lists of their events.

    Events are encoded once, before the fan-out; every sample row refers to them by ``seq``.
    """
    return rows.join(encoded, SEQ).select(*rows.columns, *[c for c in encoded.columns if c != SEQ])


def nested_samples(
    positions: DataFrame, encoded: DataFrame, part_size: int = SEQUENCE_PART
) -> DataFrame:
    """Per sample: ``hi`` as events x 3 x length, ``time`` and the number of events.

    Rows beyond ``part_size`` events continue in further parts, as in ``sample_sequences``. Events
    that were dropped for having no field to show are missing from all three columns.
    """
    item = F.struct("pos", "minute", F.array("input_ids", "type_ids", "place_ids").alias("ids"))
    return (
        attach_encoded(positions, encoded)
        .withColumn("part", F.floor((F.col("pos") - 1) / part_size).cast("bigint"))
        .groupBy("sample_id", "part")
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .select(
            "sample_id",
            "part",
            F.col("items.ids").alias("hi"),
            F.col("items.minute").alias("time"),
            F.size("items").alias("n_events"),
        )
    )
