"""Output shards at sample grain: the greedy fill under an event budget, without walking through the samples.

A shard that starts at a sample ends where the budget is used up, which is a lookup in the running total of events. So
every sample knows where the next shard would start if one started here. Following these pointers from the first sample gives
all shards; each round follows the pointers of pointers, so rounds grow with the logarithm of the number of shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators.running import range_totals, ranged
from chronofold.schema import EVENTS_PER_SHARD, SUBJECT
from chronofold.sources.staging import staged


def next_starts(placed: DataFrame, budget: int) -> DataFrame:
    """``split``, ``place`` and ``next``, the place where the shard after one that starts here would start (null: none).

    ``placed`` has, per split, samples numbered from 0 (``place``), ``n_events`` of at least 1 and the events before them
    (``events_before``). The next start is the number of samples that end within the budget. Ends and limits are laid out in buckets of one budget, which
    hold at most ``budget`` of either, as every sample has an event; a table with a row per bucket counts the ends in earlier buckets.
    """
    limit = F.col("events_before") + budget
    ends = placed.select("split", F.lit(None).cast("bigint").alias("place"), (F.col("events_before") + F.col("n_events")).alias("value"))
    laid = ends.unionByName(placed.select("split", "place", limit.alias("value"))).select(
        "*", F.expr(f"value div {budget}").alias("bucket"), F.col("place").isNull().cast("bigint").alias("is_end")
    )
    up_to_here = Window.partitionBy("split", "bucket").orderBy("value", F.desc("is_end")).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("split").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = laid.groupBy("split", "bucket").agg(F.sum("is_end").alias("n"))
    buckets = buckets.select("split", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ends_before"))
    sizes = placed.groupBy("split").agg(F.count(F.lit(1)).alias("size"))
    found = (
        laid.withColumn("ends_here", F.sum("is_end").over(up_to_here)).where("place is not null")
        .join(buckets, ["split", "bucket"]).join(F.broadcast(sizes), "split")  # a row per split
        .withColumn("next", F.greatest(F.col("ends_before") + F.col("ends_here"), F.col("place") + 1))
    )
    return found.select("split", "place", F.when(F.col("next") < F.col("size"), F.col("next")).alias("next"))


def follow(pointers: DataFrame) -> DataFrame:
    """``split``, ``place`` and ``shard_seq`` of all places that are reached from place 0 by following ``next``.

    In round k the places reached so far are extended by jumps of 2 ** k, then jumps are joined to themselves. Pointers that lead nowhere drop out.
    """
    jumps = staged(pointers.where("next is not null"), "jumps")
    reached = pointers.where("place = 0").select("split", "place", F.lit(0).cast("bigint").alias("shard_seq"))
    step = 1
    while True:
        further = reached.join(jumps, ["split", "place"]).select(
            "split", F.col("next").alias("place"), (F.col("shard_seq") + step).alias("shard_seq")
        )
        further = staged(further, "further")
        if further.isEmpty():
            return reached
        reached = staged(reached.unionByName(further), "reached")
        onward = jumps.select("split", F.col("place").alias("next"), F.col("next").alias("after"))
        jumps = staged(jumps.join(onward, ["split", "next"]).select("split", "place", F.col("after").alias("next")), "jumps")
        step *= 2


def assign_shards(samples: DataFrame, budget: int = EVENTS_PER_SHARD) -> DataFrame:
    """sample_id, split, shard_seq, shard, n_events, shard_offset: shards of at most ``budget`` events, filled greedily per split.

    In the order of subject and sample number, a sample that would overflow the shard opens the next one; a sample above the budget has
    a shard to itself. ``n_events`` is at least 1, as in every sample. ``shard_offset`` counts the events of the shard before the sample. The result is that of filling
    one sample after the other, however the rows are split; no group of samples has to fit in a task.
    """
    rows = samples.select("split", SUBJECT, "sample_no", "sample_id", F.col("n_events").cast("bigint").alias("n_events"))
    numbered = range_totals(ranged(rows, ["split", SUBJECT, "sample_no"]).withColumn("one", F.lit(1)), ["split"], ["one", "n_events"])
    placed = staged(
        numbered.withColumnsRenamed({"one_before": "place", "n_events_before": "events_before"}).drop("one"), "placed"
    )
    starts = follow(next_starts(placed.select("split", "place", "events_before", "n_events"), budget))
    opened = placed.join(starts.select("split", "place", F.lit(1).alias("opens")), ["split", "place"], "left").na.fill(0, ["opens"])
    filled = range_totals(opened, ["split"], ["opens"]).withColumn("shard_seq", F.col("opens_before") + F.col("opens") - 1)
    bounds = placed.join(starts, ["split", "place"]).select("split", "shard_seq", F.col("events_before").alias("_shard_before"))
    return filled.join(bounds, ["split", "shard_seq"]).select(
        "sample_id",
        "split",
        F.col("shard_seq").cast("int").alias("shard_seq"),
        F.concat(F.lit("shard-"), _padded(F.col("shard_seq"), 4)).alias("shard"),
        "n_events",
        (F.col("events_before") - F.col("_shard_before")).alias("shard_offset"),
    )


def _padded(number: Column, width: int) -> Column:
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def shard_balance(assigned: DataFrame, budget: int) -> DataFrame:
    """Samples and events of each shard, and the share of the budget it uses."""
    return assigned.groupBy("split", "shard").agg(
        F.count(F.lit(1)).alias("samples"),
        F.sum("n_events").alias("events"),
        (F.sum("n_events") / budget).alias("fill"),
    )
