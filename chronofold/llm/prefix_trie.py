"""The trie of all conversation prefixes, with totals per node, by recursion on half depths.

A trie of height h is cut at depth h / 2 into one upper trie and the lower forests that hang from its cut prefixes. All
sequences are cut at the same places, so every level of the recursion is one job over all tries of that height. Names of whole
segments are made from the bottom up; from the top down they give each lower forest the name of the prefix it
hangs from, until the tries have height 1. Totals travel the other way: at every level a lower forest is summed up as a whole and grafted on the cut
prefix's ancestors in its upper trie. Two nodes of which one is above the other part at exactly one level, so all levels add up to the totals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.batches import bounded_batches, frugal
from chronofold.sources.staging import staged

PREFIX_MODULUS = 100
PREFIX_TURNS = 6
CHUNK_BITS = 12  # a piece of a node's list spans 4,096 ids
RUN = 1_024  # ancestors that one row is spread to at once


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), token (a digest of role and text), chars: turns in order, null turns first.

    Ties are ordered by role and text. No conversation has to fit in a task: rows are sorted by ranges, and a place is counted from the first row
    of the conversation in its range.
    """
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    token = _named(F.octet_length("role").cast("string").cast("binary"), F.lit(b":"), F.col("role").cast("binary"), F.col("text").cast("binary"))
    numbered = staged(
        rows.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange(*order, F.col("_n")).sortWithinPartitions(*order)
        .select("conv_id", token.alias("token"), F.length("text").cast("bigint").alias("chars"), F.monotonically_increasing_id().alias("row")),
        "turns",
    ).withColumn("range", F.shiftright("row", 33))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        numbered.groupBy("conv_id", "range").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
        .select("conv_id", "range", (F.col("first") - F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("zero"))
    )
    return numbered.join(ranges, ["conv_id", "range"]).select("conv_id", (F.col("row") - F.col("zero") + 1).alias("pos"), "token", "chars")


def with_shared_prefixes(turns: DataFrame, modulus: int = PREFIX_MODULUS, most: int = PREFIX_TURNS) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns, and all conversations with their number of rebuilt turns (conv_id, size).

    A conversation takes the first h turns of the conversation whose id is its own rounded down to the modulus, then its own from
    h on; h is the crc32 of its decimal id modulo ``most``.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    convs = own.select("conv_id", "own", head.alias("head"), (F.col("conv_id") - F.col("conv_id") % modulus).alias("base"))
    bases = own.where(F.col("conv_id") % modulus == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("head", F.coalesce("base_own", F.lit(0))))
    convs = staged(
        convs.select("conv_id", "base", "head", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("size")), "convs"
    )
    heads = turns.where((F.col("conv_id") % modulus == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    taken = convs.where("taken > 0").join(heads, "base").where("pos <= taken").select("conv_id", "pos", "token", "chars")
    kept = turns.join(convs.select("conv_id", "head", "taken"), "conv_id").where("pos > head")
    kept = kept.select("conv_id", (F.col("pos") - F.col("head") + F.col("taken")).alias("pos"), "token", "chars")
    return taken.unionByName(kept), convs.select("conv_id", "size")


def _named(*parts: Column) -> Column:
    """128 bits of a digest."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def name_prefixes(turns: DataFrame, levels: int) -> DataFrame:
    """``turns`` with ``node``, equal for equal prefixes and different otherwise: all up to 2 ** ``levels`` places."""
    segments = [turns.select("conv_id", (F.col("pos") - 1).alias("segment"), F.col("token").alias("name"))]
    for k in range(1, levels):  # names of whole segments of 2 ** k turns
        half = [F.max(F.when(F.col("segment") % 2 == side, F.col("name"))) for side in (0, 1)]
        segments.append(
            staged(
                segments[-1].groupBy("conv_id", F.shiftright("segment", 1).alias("segment"))
                .agg(half[0].alias("left"), half[1].alias("right")).where("left is not null and right is not null")
                .select("conv_id", "segment", _named(F.col("left"), F.col("right")).alias("name")),
                "segments",
            )
        )
    start = F.unhex(F.lit("00" * 16))
    forests = turns.select("conv_id").distinct().select("conv_id", F.lit(0).cast("bigint").alias("segment"), start.alias("root"))
    for k in range(levels - 1, -1, -1):  # the upper halves keep their root, the lower ones hang from the cut prefix
        cut = segments[k].where(F.col("segment") % 2 == 0).select("conv_id", F.shiftright("segment", 1).alias("segment"), "name")
        both = forests.join(cut, ["conv_id", "segment"], "left")
        upper = both.select("conv_id", (F.col("segment") * 2).alias("segment"), "root")
        lower = both.where("name is not null").select(
            "conv_id", (F.col("segment") * 2 + 1).alias("segment"), _named(F.col("root"), F.col("name")).alias("root")
        )
        forests = staged(upper.unionByName(lower), "forests")
    here = forests.withColumn("pos", F.col("segment") + 1).select("conv_id", "pos", "root")
    return turns.join(here, ["conv_id", "pos"]).select("conv_id", "pos", "chars", _named(F.col("root"), F.col("token")).alias("node"))


def graft(nodes: DataFrame, paths: DataFrame, levels: int, weights: list[str]) -> DataFrame:
    """``node`` and the sums of ``weights`` over all nodes below it; nodes with nothing below them are left out.

    ``nodes`` has conv_id (a member), depth and the weights, ``paths`` the node of every conversation and place.
    """
    sums = [F.sum(w).alias(w) for w in weights]
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    apart = (
        nodes.where(reduce(lambda a, b: a | b, [F.col(w) != 0 for w in weights]))
        .select("conv_id", "depth", *weights, level)
        .where(F.expr("shiftright(depth - 1, level) % 2 = 1"))  # in a lower forest at that level
        .select("conv_id", "level", F.expr("shiftleft(shiftright(depth - 1, level), level)").alias("pos"), *weights)
        .groupBy("conv_id", "level", "pos").agg(*sums)
    )
    cuts = staged(
        apart.join(paths, ["conv_id", "pos"]).groupBy("node", "level", "pos")
        .agg(F.min("conv_id").alias("conv_id"), *sums).drop("node"),
        "cuts",
    )
    size = F.expr("shiftleft(1L, level)")
    runs = cuts.withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((size - 1) / RUN)))).repartition(
        "conv_id", "level", "pos", "run"
    )
    last = F.col("pos") - F.col("run") * RUN
    place = F.explode(F.sequence(F.greatest(last - RUN + 1, F.col("pos") - size + 1), last))
    above = runs.select("conv_id", place.alias("place"), *weights).withColumnRenamed("place", "pos")
    return above.groupBy("conv_id", "pos").agg(*sums).join(paths, ["conv_id", "pos"]).groupBy("node").agg(*sums)


def ends(members: DataFrame) -> DataFrame:
    """``node`` and ``ends_sha256``, the digest of the ids of its conversations (conv_id), ascending, joined by commas.

    Lists are made in pieces of neighbouring ids; a list of several pieces is digested piece by piece in one task, which holds one batch of them.
    """
    pieces = (
        members.groupBy("node", F.shiftright("conv_id", CHUNK_BITS).alias("piece"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != node:
                    if node is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = name, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield pa.RecordBatch.from_pydict({"node": [n for n, _ in done], "ends_sha256": [d for _, d in done]}, out)
        if node is not None:
            yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [digest.hexdigest()]}, out)

    out = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    bounded_batches(members.sparkSession)
    lines = pieces.repartition("node").sortWithinPartitions("node", "piece").select("node", "ids")
    return lines.mapInArrow(frugal(run), "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, modulus: int = PREFIX_MODULUS, most: int = PREFIX_TURNS) -> DataFrame:
    """One row per prefix of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by ``ordered_turns``, conversations rebuilt by ``with_shared_prefixes``. Null roles and texts are empty texts; empty texts are turns
    like any other. Rows with a null conv_id belong to no conversation and are left out. Repeated rows are turns each. Conversations without a rebuilt turn
    are members of the root. An empty table has no root and gives no row. Other columns are not read. Prefixes are told apart by 128 bits of SHA-256.

    Every shuffle is by a conversation and a place in it, or adds up a node's rows before it moves them; a conversation or a prefix may hold any share
    of the rows. Only totals of the whole table are collected.
    """
    turns, convs = with_shared_prefixes(ordered_turns(conversations), modulus, most)
    first, n_convs, longest = convs.agg(F.min("conv_id"), F.count(F.lit(1)), F.max("size")).first()
    root = F.unhex(F.lit("ff" * 16))
    levels = max(1, ((longest or 1) - 1).bit_length())
    paths = staged(name_prefixes(staged(turns, "rebuilt"), levels), "paths")
    nodes = staged(
        paths.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.min("pos").alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars")),
        "nodes",
    )
    places = paths.select("conv_id", "pos", "node")
    up = places.select("conv_id", (F.col("pos") + 1).alias("depth"), F.col("node").alias("parent"))
    linked = staged(
        nodes.join(up, ["conv_id", "depth"], "left").withColumn("parent", F.coalesce("parent", root)), "linked"
    )
    children = linked.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")).withColumnRenamed("parent", "node")
    weighed = staged(
        linked.join(children, "node", "left").select(
            "node", "conv_id", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        ),
        "weighed",
    )
    grafted = graft(weighed, places, levels, ["n_leaves", "saved_tokens"])
    below = grafted.select("node", F.col("n_leaves").alias("_leaves"), F.col("saved_tokens").alias("_saved"))
    totals = weighed.agg(F.count_if(F.col("depth") == 1), F.sum("n_leaves"), F.sum("saved_tokens")).first()
    n_children, n_leaves, saved = (n or 0 for n in totals)
    top = (
        conversations.sparkSession.range(min(n_convs, 1))
        .select(
            root.alias("node"), F.lit(first).cast("bigint").alias("conv_id"), F.lit(0).cast("bigint").alias("depth"),
            F.lit(None).cast("binary").alias("parent"), *[F.lit(n).cast("bigint").alias(c) for n, c in (
                (n_convs, "n_convs"), (n_children, "n_children"), (max(n_leaves, 1), "n_leaves"), (saved, "saved_tokens"))],
        )
    )
    summed = weighed.join(below, "node", "left").select(
        *weighed.columns[:-2],
        (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved_tokens") + F.coalesce("_saved", F.lit(0))).alias("saved_tokens"),
    )
    whole = staged(summed.select(*top.columns).unionByName(top), "trie")
    last = convs.withColumnRenamed("size", "pos").join(places, ["conv_id", "pos"], "left")
    digests = ends(last.select("conv_id", F.coalesce("node", root).alias("node")))
    parents = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        whole.join(parents, "parent", "left").join(digests, "node", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
        )
    )
