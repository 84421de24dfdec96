"""Samples in compact form: every event once, in blocks per subject, and one header per sample.

A sample is a prefix of its subject's events, so its header says how many of them belong to it. Blocks hold a fixed
range of event numbers each; what is stored grows with events and labels, and samples are laid out only when they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.functions.clock import minutes_between
from chronofold.operators.events import number_events
from chronofold.schema import SEQ, SUBJECT, TIME

BLOCK_EVENTS = 256
BLOCK = "block"


def event_blocks(events: DataFrame, encoded: DataFrame, block_events: int = BLOCK_EVENTS) -> DataFrame:
    """``subject_id``, ``block`` and ``events``: up to ``block_events`` consecutive events in (time, seq) order, with their ids.

    Events without encoding (no field to show) keep their number but are not stored. A block is the largest group that meets in a task.
    """
    numbered = number_events(events.select(SUBJECT, TIME, SEQ))
    item = F.struct(
        "event_no", "group_start", "group_size", TIME, SEQ, F.array("input_ids", "type_ids", "place_ids").alias("ids")
    )
    return (
        numbered.join(encoded.select(SEQ, "input_ids", "type_ids", "place_ids"), SEQ)
        .groupBy(SUBJECT, F.floor((F.col("event_no") - 1) / block_events).cast("bigint").alias(BLOCK))
        .agg(F.array_sort(F.collect_list(item)).alias("events"))
    )


def _blocks_of(headers: DataFrame, block_events: int, *columns: str) -> DataFrame:
    """A row per sample and block that it reaches into."""
    last = F.floor((F.col("base_events") - 1) / block_events).cast("bigint")
    return headers.select(*columns, F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias(BLOCK))


def _reached(block_events: int) -> Column:
    """The events of a block that belong to the sample: all but in its last block."""
    whole = F.col("base_events") >= (F.col(BLOCK) + 1) * block_events
    return F.when(whole, F.col("events")).otherwise(F.filter("events", lambda e: e["event_no"] <= F.col("base_events")))


def expand_samples(headers: DataFrame, blocks: DataFrame, block_events: int = BLOCK_EVENTS) -> DataFrame:
    """sample_id, part, ``hi`` (events x 3 x length), ``time`` (minutes) and n_events: the form of ``nested_samples``.

    A part of a sample is a block of its subject, or the head of one, so a join by subject and block is all; blocks stored by these columns
    do not move. Only samples with copies, whose events repeat time by time, are put together event by event.
    """
    columns = (SUBJECT, "sample_id", "base_events", "copies", "first_time")
    single = _blocks_of(headers.where("copies = 1"), block_events, *columns)
    kept = blocks.join(single, [SUBJECT, BLOCK]).withColumn("events", _reached(block_events))
    minutes = F.transform("events", lambda e: minutes_between(F.col("first_time"), e[TIME]))
    plain = kept.select(
        "sample_id", F.col(BLOCK).alias("part"), F.col("events.ids").alias("hi"), minutes.alias("time"), F.size("events").alias("n_events")
    ).where("n_events > 0")

    several = _blocks_of(headers.where("copies > 1"), block_events, *columns)
    each = blocks.join(several, [SUBJECT, BLOCK]).select("*", F.explode(_reached(block_events)).alias("e"))
    copied = each.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no"))
    pos = (
        F.col("e.group_start") * F.col("copies")
        + (F.col("copy_no") - 1) * F.col("e.group_size")
        + F.col("e.event_no")
        - F.col("e.group_start")
    )
    item = F.struct(pos.alias("pos"), minutes_between(F.col("first_time"), F.col(f"e.{TIME}")).alias("minute"), F.col("e.ids").alias("ids"))
    woven = (
        copied.groupBy("sample_id", F.floor((pos - 1) / block_events).cast("bigint").alias("part"))
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .select("sample_id", "part", F.col("items.ids").alias("hi"), F.col("items.minute").alias("time"), F.size("items").alias("n_events"))
    )
    return plain.unionByName(woven)


def stored_counts(headers: DataFrame, blocks: DataFrame, block_events: int = BLOCK_EVENTS) -> DataFrame:
    """split, shard, samples, events: what ``expand_samples`` would yield, counted per block without laying it out."""
    wanted = _blocks_of(headers, block_events, SUBJECT, "sample_id", "base_events", "copies", "split", "shard")
    numbers = blocks.select(SUBJECT, BLOCK, F.transform("events", lambda e: F.struct(e["event_no"].alias("event_no"))).alias("events"))
    return (
        numbers.join(wanted, [SUBJECT, BLOCK])
        .groupBy("split", "shard", "sample_id")
        .agg(F.sum(F.size(_reached(block_events)) * F.col("copies")).alias("n"))
        .groupBy("split", "shard")
        .agg(F.count(F.lit(1)).alias("samples"), F.sum("n").alias("events"))
    )
