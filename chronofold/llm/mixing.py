"""Mixing sources to target weights by Pfair scheduling."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.sources.staging import staged

BLOCK_CHARS = 1_000_000
STREAMS: int | None = None  # a bound on the streams, if one is wanted; beyond it the smallest sources share the last one
CYCLE = 4_096
ALPHA = 0.5
UNIT, LEAST = 1 << 50, 1 << 20  # weights are whole numbers of about this sum; smaller ones, down to zero, count as the least


def target_weights(sizes: dict[str | None, int], alpha: float = ALPHA) -> dict[str | None, float]:
    """Weights in proportion to size ** alpha: below one, small sources get more than their share."""
    raised = {s: max(n, 1) ** alpha for s, n in sizes.items()}
    total = sum(raised.values())
    return {s: r / total for s, r in raised.items()}


def quotas(weights: list[float], cycle: int) -> list[int]:
    """Whole slots of a cycle for each stream, at least one, by largest remainder. ``mix`` does not round to a cycle."""
    total = sum(weights)
    exact = [w / total * (cycle - len(weights)) for w in weights]
    slots = [1 + int(x) for x in exact]
    order = sorted(range(len(weights)), key=lambda i: (int(exact[i]) - exact[i], i))
    for i in order[: cycle - sum(slots)]:
        slots[i] += 1
    return slots


def schedule(weights: list[int], blocks: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """(stream, k, release, deadline, slot) of all blocks, by slot; ``weights`` are shares of their sum.

    With weight w = share / sum, block k (from 0) of a stream may run from floor(k / w) and must have run by
    ceil((k + 1) / w), in whole numbers. In each slot the released block with the earliest deadline runs. The weights sum to
    one, so every deadline is met, and until it ends a stream has had at each time its weight's share of the slots within
    less than one block. Slots that an ended stream would have had stay empty if no other block is released. At most one
    block per stream is held.
    """
    whole = sum(weights)

    def window(i: int, k: int) -> tuple[int, int]:
        return k * whole // weights[i], -(-(k + 1) * whole // weights[i])

    released: list[tuple[int, int, int, int]] = []
    coming = [(0, i, 0) for i in range(len(weights)) if weights[i] and blocks[i]]
    heapq.heapify(coming)
    now = 0
    while coming or released:
        if not released:
            now = max(now, coming[0][0])
        while coming and coming[0][0] <= now:
            release, i, k = heapq.heappop(coming)
            heapq.heappush(released, (window(i, k)[1], i, k, release))
        deadline, i, k, release = heapq.heappop(released)
        yield i, k, release, deadline, now
        if k + 1 < blocks[i]:
            heapq.heappush(coming, (window(i, k + 1)[0], i, k + 1))
        now += 1


def pfair(slots: list[int]) -> list[tuple[int, int, int, int]]:
    """(stream, k, release, deadline) in each slot of one cycle of ``sum(slots)`` slots, in which every slot is used."""
    return [found[:4] for found in schedule(slots, slots)]


def _streams(sizes: DataFrame, weights: dict[str | None, float] | None, alpha: float, block_chars: int) -> tuple[DataFrame, DataFrame]:
    """The stream of each source (_source, _key) and of each stream its _key, name, share, characters, blocks and prefix bits."""
    spark = sizes.sparkSession
    if weights is None:
        shared = sizes.withColumn("_share", F.pow("_n", F.lit(alpha)))
    else:
        given = spark.createDataFrame([(_plain(s), float(w)) for s, w in weights.items()], "_source string, _given double")
        least = F.lit(float(min(weights.values(), default=1.0)))
        shared = sizes.join(given, "_source", "left").withColumn("_share", F.coalesce("_given", least)).drop("_given")
    own = F.lit(True)
    if STREAMS is not None:
        largest = sizes.orderBy(F.desc("_n"), "_source").limit(STREAMS - 1).select("_source", F.lit(True).alias("_own"))
        shared = shared.join(largest, "_source", "left")
        own = F.col("_own").isNotNull()
    named = F.when(F.col("_source") != "", F.substring("_source", 2, 2**31 - 1))
    shared = staged(
        shared.select("_source", "_n", "_share", F.when(own, F.col("_source")).otherwise(F.lit("+")).alias("_key"), F.when(own, named).otherwise(F.lit("(other)")).alias("_name")),
        "sources",
    )
    blocks = F.ceil(F.col("_n") / block_chars).cast("bigint")
    streams = shared.groupBy("_key").agg(F.first("_name").alias("_name"), F.sum("_share").alias("_share"), F.sum("_n").alias("_n"))
    bits = F.least(F.ceil(F.log2(blocks)), F.lit(40)).cast("int")
    streams = staged(streams.withColumns({"_blocks": blocks, "_bits": bits}), "streams")
    return shared.join(streams.select("_key", "_bits"), "_key").select("_source", "_key", "_bits"), streams


def _plain(source: str | None) -> str:
    """A name that is not null."""
    return "" if source is None else f"={source}"


def _slots(streams: DataFrame, batch_rows: int) -> DataFrame:
    """The schedule of all blocks of all streams. One task makes it, block by block, and holds one row per stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["_key"], r["_name"], r["_share"], r["_blocks"]) for batch in batches for r in batch.to_pylist())
        if not rows:
            return
        total = math.fsum(r[2] for r in rows)
        shares = [max(LEAST, round(UNIT * (r[2] / total))) if total else LEAST for r in rows]
        whole = sum(shares)
        plan = schedule(shares, [r[3] for r in rows])
        while some := list(islice(plan, batch_rows)):
            i, k, release, deadline, slot = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[x][0] for x in i], pa.string()), pa.array([rows[x][1] for x in i], pa.string()),
                    pa.array([shares[x] / whole for x in i], pa.float64()), *(pa.array(c, pa.int64()) for c in (k, release, deadline, slot)),
                ],
                ["_key", "mix_stream", "mix_weight", "mix_block", "mix_release", "mix_deadline", "mix_slot"],
            )

    narrow = streams.select("_key", F.coalesce("_name", F.lit("")).alias("_name"), "_share", "_blocks").repartition(1)
    made = narrow.mapInArrow(
        run,
        "_key string, mix_stream string, mix_weight double, mix_block bigint, mix_release bigint, mix_deadline bigint, mix_slot bigint",
    )
    return staged(made.withColumn("mix_stream", F.when(F.col("_key") != "", F.col("mix_stream"))), "slots")


def _prefix(order: str, bits: str) -> Column:
    """The first bits of a signed hash, in its order; zero for no bits."""
    from_least = F.col(order).bitwiseXOR(F.lit(-(2**63)))
    return F.call_function("shiftright", F.shiftrightunsigned(from_least, 1), F.lit(63) - F.col(bits))


def _cuts(keyed: DataFrame, block_chars: int) -> DataFrame:
    """Per stream and prefix of the hash, the block in which it begins (_base) and the hashes at which the block changes (_cuts).

    Blocks are runs of ``block_chars`` characters of a stream in the order of the hash. Totals of the prefixes are summed up
    first, then the hashes within a prefix, of which there are about as many as documents in a block. A row is in the
    block in which it starts; equal rows have one hash and go from the first's block to the last's (_from, _to).
    """
    hashes = staged(
        keyed.groupBy("_key", "_prefix", "mix_order").agg(F.sum("_chars").alias("_sum"), F.count(F.lit(1)).alias("_rows")), "hashes"
    )
    before = (Window.unboundedPreceding, -1)
    totals = hashes.groupBy("_key", "_prefix").agg(F.sum("_sum").alias("_total"))
    along = Window.partitionBy("_key").orderBy("_prefix").rowsBetween(*before)
    totals = totals.select("_key", "_prefix", F.coalesce(F.sum("_total").over(along), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_key", "_prefix").orderBy("mix_order")
    start = F.col("_start") + F.coalesce(F.sum("_sum").over(within.rowsBetween(*before)), F.lit(0))
    placed = (
        hashes.join(totals, ["_key", "_prefix"])
        .withColumn("_at", start)
        .withColumn("_from", F.expr(f"_at div {block_chars}"))
        .withColumn("_to", F.expr(f"(_at + _sum - _sum div _rows) div {block_chars}"))
        .withColumn("_last", F.lag("_to").over(within))
    )
    cut = (F.col("_last") != F.col("_from")) | (F.col("_from") != F.col("_to"))
    return staged(
        placed.groupBy("_key", "_prefix").agg(
            F.min("_from").alias("_base"),
            F.sort_array(F.collect_list(F.when(cut, F.struct("mix_order", "_from", "_to")))).alias("_cuts"),
        ),
        "cuts",
    )


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    alpha: float = ALPHA,
    block_chars: int = BLOCK_CHARS,
    cycle: int = CYCLE,
) -> DataFrame:
    """``docs`` with where each document stands in the mixture; all rows and columns stay.

    Added: mix_stream, mix_weight, mix_block (number in its stream), mix_release and mix_deadline (slots of the
    schedule, counted like mix_slot), mix_slot (the block's place in the mixture) and mix_order (the document's place in the
    block). Order by mix_slot, mix_order, doc_id. Columns of these names are replaced.

    A stream is a source; a null source is one too, and every source has its own weight. A stream's rows are ordered by a hash
    of doc_id and text and cut every ``block_chars`` characters (a text of null or no characters counts as one). A row's
    block is the one in which it starts, so a long row takes up several blocks, of which the later have no row. Equal
    rows are dealt to the blocks they fill in any order. Without ``weights`` they come from the sizes by
    ``target_weights``; a source without a weight there gets that of the least. No document is dropped or repeated: where a
    stream has ended its slots stay empty, and the others go on at the same rates. An empty table stays empty.

    Streams, blocks and schedule are tables joined to the documents, which do not shuffle while those tables can be broadcast;
    nothing is collected. The schedule is made in one task, one row per block, ``cycle`` blocks at a time. Its weights are
    whole numbers of about 2^50 in sum.
    """
    added = ["mix_stream", "mix_weight", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_order"]
    columns = [c for c in docs.columns if c not in added]
    source = F.col("source").cast("string")
    chars = F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1)).cast("bigint")

    # The row's columns travel under other names, so that none meets those made here and unused ones are not read.
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(columns)],
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("_source"),
        chars.alias("_chars"),
        F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.lit(1)).alias("mix_order"),
    )
    sources, streams = _streams(rows.groupBy("_source").agg(F.sum("_chars").alias("_n")), weights, alpha, block_chars)
    keyed = rows.join(sources, "_source").withColumn("_prefix", _prefix("mix_order", "_bits"))
    cuts = _cuts(keyed, block_chars)
    passed = F.filter("_cuts", lambda c: c["mix_order"] <= F.col("mix_order"))
    last = F.try_element_at("_passed", F.lit(-1))
    copies = last["_to"] - last["_from"] + 1
    among = last["_from"] + F.pmod(F.xxhash64(F.monotonically_increasing_id()), copies)
    block = F.when(last.isNull(), F.col("_base")).when(last["mix_order"] == F.col("mix_order"), among).otherwise(last["_to"])
    return (
        keyed.join(cuts, ["_key", "_prefix"])
        .withColumn("_passed", passed)
        .withColumn("mix_block", block)
        .join(_slots(streams, cycle), ["_key", "mix_block"])
        .select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(columns)], *added)
    )


def in_mixture_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` laid out in the order of the mixture, with their own columns only.

    Ranges of slots become partitions, each sorted, so the files written from the result hold the mixture in
    the order of their names. This is the one shuffle of whole rows.
    """
    order = ["mix_slot", "mix_order", "doc_id"]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole"), "doc_id", "source", "text")
    placed = mix(whole, **options).select("_whole", *order)
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select("_whole.*")
