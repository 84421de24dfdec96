"""Joins that hold up when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.sources.staging import staged

ROWS_PER_TASK = 20_000_000  # pairs of one key that one task may compare
BUCKETS = 1 << 16


def heavy_keys(rows: DataFrame, keys: list[str], limit: int) -> DataFrame | None:
    """Keys with more than ``limit`` rows, written; None if there are none.

    Rows are counted by a hash of the keys first, which shuffles ``BUCKETS`` counts a task at most. Keys are counted in
    buckets beyond the limit alone, as no other can hold a heavy one.
    """
    n = F.count(F.lit(1)).alias("_n")
    hashed = rows.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("_bucket"))
    full = staged(hashed.groupBy("_bucket").agg(n).where(F.col("_n") > limit).select("_bucket"), "full-buckets")
    if full.isEmpty():
        return None
    counted = hashed.join(full, "_bucket", "left_semi").groupBy(*keys).agg(n)
    heavy = staged(counted.where(F.col("_n") > limit).select(*keys), "heavy-keys")
    return None if heavy.isEmpty() else heavy


def by_weight(rows: DataFrame, heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of other keys than the heavy ones, and rows of these."""
    return tuple(rows.join(heavy, heavy.columns, kind).select(*rows.columns) for kind in ("left_anti", "left_semi"))


def _grid(
    key: str, left_keys: DataFrame | None, right_keys: DataFrame | None, rows_per_task: int
) -> DataFrame:
    """Keys with more than ``rows_per_task`` pairs, with their numbers of left and right slices, ``_a`` and ``_b``.

    The work of a key is the product of its rows on both sides, so that is what is divided. A side
    that was not counted counts as one row.
    """
    parts = [
        df.select(key, F.lit(is_left).alias("_l"), F.lit(1 - is_left).alias("_r"))
        for df, is_left in ((left_keys, 1), (right_keys, 0))
        if df is not None
    ]
    rows = (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).groupBy(key).agg(
        F.greatest(F.sum("_l"), F.lit(1)).cast("double").alias("_l"),
        F.greatest(F.sum("_r"), F.lit(1)).cast("double").alias("_r"),
    )
    cells = F.col("_l") * F.col("_r") / rows_per_task
    # As square as both sides allow: each side is repeated once per slice of the other.
    left = F.greatest(F.least(F.ceil(F.sqrt(cells * F.col("_l") / F.col("_r"))), F.col("_l")), F.lit(1))
    return (
        rows.where(cells > 1)
        .withColumn("_a", left.cast("int"))
        .select(key, "_a", F.greatest(F.ceil(cells / F.col("_a")), F.lit(1)).cast("int").alias("_b"))
    )


def grid_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    condition: Column,
    slice_left: Column,
    slice_right: Column,
    left_keys: DataFrame | None,
    right_keys: DataFrame | None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Inner join on ``key`` and ``condition``, heavy keys spread over a grid of tasks.

    A key with ``a`` slices of left rows and ``b`` slices of right rows becomes ``a * b`` join keys:
    a left row goes to one of the ``a`` rows of the grid and is repeated for the ``b`` columns, a right
    row the other way round, so every pair meets exactly once. ``slice_left`` and ``slice_right`` are
    hashes that spread the rows of one key. ``left_keys`` and ``right_keys`` are the tables keys are
    counted on, as cheap as can be; None for a side that cannot be heavy. Columns other than ``key``
    must differ between the sides. The grid has a row for each key with too many pairs for one task. It is written first: without a
    row the join is by key alone, and sides that lie by key already do not move; else it is
    joined like any other table: adaptive execution broadcasts it where it is small.
    """
    grid = staged(_grid(key, left_keys, right_keys, rows_per_task), "grid")
    if grid.isEmpty():
        return left.join(right.withColumnRenamed(key, "_key"), (F.col(key) == F.col("_key")) & condition).drop("_key")

    def slice_of(hashed: Column, n: str) -> Column:
        return F.when(F.col(n).isNull(), F.lit(0)).otherwise(F.pmod(hashed, F.col(n)).cast("int"))

    def copies_of(n: str) -> Column:
        one = F.array(F.lit(0))
        return F.explode(
            F.when(F.col(n).isNull(), one).otherwise(F.sequence(F.lit(0), F.col(n) - 1))
        )

    spread_left = left.join(grid, key, "left").withColumn("_i", slice_of(slice_left, "_a"))
    spread_right = right.join(grid, key, "left").withColumn("_j", slice_of(slice_right, "_b"))
    # A side is repeated only if the other one can be heavy.
    repeat_left = copies_of("_b") if right_keys is not None else F.lit(0)
    repeat_right = copies_of("_a") if left_keys is not None else F.lit(0)
    spread_left = spread_left.withColumn("_j", repeat_left).drop("_a", "_b")
    spread_right = (
        spread_right.withColumn("_i", repeat_right)
        .drop("_a", "_b")
        .withColumnsRenamed({key: "_key", "_i": "_ri", "_j": "_rj"})
    )
    on = (
        (F.col(key) == F.col("_key"))
        & (F.col("_i") == F.col("_ri"))
        & (F.col("_j") == F.col("_rj"))
        & condition
    )
    return spread_left.join(spread_right, on).drop("_i", "_j", "_key", "_ri", "_rj")


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join of a large table to a lookup with one row per key.

    Adaptive execution sees the real size of the lookup: it broadcasts a small one, and otherwise
    splits the partitions of heavy keys.
    """
    values = [c for c in lookup.columns if c != key]
    return facts.join(lookup, key, "left").select(*facts.columns, *values)
