"""Running totals per key that never put a whole key into one task.

A window over ``partitionBy(subject)`` sorts all rows of a subject in one task, which will do for up to
a million. A running total of a longer key is the sum of two parts: earlier slots of the key, from a table with one row per slot, and
earlier rows of the same slot. A slot is an hour, and a part of an hour where one holds too many rows: its
quantiles, from a sketch of the times, cut it evenly however the rows lie in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.functions.clock import hour_number, micros_of_hour
from chronofold.operators.skew import by_weight, heavy_keys
from chronofold.sources.staging import staged

SLOT = "_slot"
SLOT_BITS = 20  # room for the parts of an hour in a slot number
ROWS_PER_SLOT = 1_000_000
PARTS = 1024  # of one hour at most
SKETCH_SIZE = 4096  # ranks are off by about a tenth of a part
_CUTS = "_cuts"


def running_totals(
    df: DataFrame,
    keys: list[str],
    time: str,
    measures: list[str],
    tie_break: list[str] | None = None,
    totals_from: DataFrame | None = None,
    rows_per_slot: int = ROWS_PER_SLOT,
) -> DataFrame:
    """Add ``{m}_before`` for each measure: its sum over earlier rows of the same key.

    Rows should already be few per (keys, time): a slot ends only between times. ``totals_from`` may give finer rows with the same
    sums: heavy keys are then found and slot totals taken from them in one small map-side aggregation instead of from
    the result of the shuffles that made ``df``. The slot number stays in the result as ``_slot``.
    Keys of up to ``rows_per_slot`` rows are one window, and come out hash-partitioned by keys if all are. Of longer keys
    totals per hour are written first; only if one of them counts more than ``rows_per_slot`` rows, the hours concerned are cut
    at quantiles of their times. Rows with a null key or time are left out.
    """
    finer = df if totals_from is None else totals_from
    heavy = heavy_keys(finer, keys, rows_per_slot)
    if heavy is None:
        return _in_one_window(df, keys, time, measures, tie_break)
    light, rest = by_weight(df, heavy)
    finer = rest if totals_from is None else by_weight(finer, heavy)[1]
    slotted = _over_slots(rest, keys, time, measures, tie_break, finer, rows_per_slot)
    return _in_one_window(light, keys, time, measures, tie_break).unionByName(slotted)


def _in_one_window(df: DataFrame, keys: list[str], time: str, measures: list[str], tie_break: list[str] | None) -> DataFrame:
    line = Window.partitionBy(*keys).orderBy(time, *(tie_break or [])).rowsBetween(Window.unboundedPreceding, -1)
    return df.na.drop(subset=[*keys, time]).select(
        *df.columns, _hour(time).alias(SLOT), *[_or_zero(F.sum(m).over(line)).alias(f"{m}_before") for m in measures]
    )


def _hour(time: str) -> Column:
    return F.shiftleft(hour_number(F.col(time)).cast("bigint"), SLOT_BITS)


def _over_slots(
    df: DataFrame,
    keys: list[str],
    time: str,
    measures: list[str],
    tie_break: list[str] | None,
    finer: DataFrame,
    rows_per_slot: int,
) -> DataFrame:
    earlier = (Window.unboundedPreceding, -1)
    totals = [F.sum(m).alias(m) for m in measures]
    hour = _hour(time)
    counted = staged(finer.groupBy(*keys, hour.alias(SLOT)).agg(*totals, F.count(F.lit(1)).alias("_n")), "slots")
    placed = df.withColumn(SLOT, hour)
    crowded = counted.where(F.col("_n") > rows_per_slot).select(*keys, SLOT, "_n")
    if not crowded.isEmpty():
        cuts = staged(_quantiles(finer.withColumn(SLOT, hour), crowded, keys, time, rows_per_slot), "cuts")
        placed = _cut(placed, cuts, keys, time)
        counted = _cut(finer.withColumn(SLOT, hour), cuts, keys, time).groupBy(*keys, SLOT).agg(*totals)
    over_slots = Window.partitionBy(*keys).orderBy(SLOT).rowsBetween(*earlier)
    slots = counted.select(*keys, SLOT, *[_or_zero(F.sum(m).over(over_slots)).alias(f"_{m}_slots") for m in measures])
    in_slot = Window.partitionBy(*keys, SLOT).orderBy(time, *(tie_break or [])).rowsBetween(*earlier)
    return (
        placed.select("*", *[_or_zero(F.sum(m).over(in_slot)).alias(f"_{m}_rows") for m in measures])
        .join(slots, [*keys, SLOT])
        .select(
            *df.columns,
            SLOT,
            *[(F.col(f"_{m}_slots") + F.col(f"_{m}_rows")).alias(f"{m}_before") for m in measures],
        )
    )


def _quantiles(rows: DataFrame, crowded: DataFrame, keys: list[str], time: str, rows_per_slot: int) -> DataFrame:
    """Per crowded hour the times, as microseconds of the hour, that part its rows evenly; sketches are merged, rows do not meet."""
    step = F.greatest(F.floor(F.lit(PARTS) / F.ceil(F.col("_n") / rows_per_slot)), F.lit(1))
    ranks = F.array(*[F.lit(k / PARTS) for k in range(1, PARTS)])
    return (
        rows.join(crowded, [*keys, SLOT])
        .groupBy(*keys, SLOT)
        .agg(F.max("_n").alias("_n"), F.kll_sketch_agg_bigint(micros_of_hour(F.col(time)), SKETCH_SIZE).alias("_sketch"))
        .withColumn(_CUTS, F.kll_sketch_get_quantile_bigint("_sketch", ranks))
        .select(*keys, SLOT, F.array_distinct(F.filter(_CUTS, lambda c, i: (i + 1) % step == 0)).alias(_CUTS))
    )


def _cut(rows: DataFrame, cuts: DataFrame, keys: list[str], time: str) -> DataFrame:
    """``rows`` with the part of the hour added to the slot number."""
    part = F.size(F.filter(F.coalesce(_CUTS, F.array().cast("array<bigint>")), lambda c: c < micros_of_hour(F.col(time))))
    return rows.join(cuts, [*keys, SLOT], "left").withColumn(SLOT, F.col(SLOT) + part).drop(_CUTS)


def _or_zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0))


def ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` sorted by ``order`` over all tasks and written: ``_row`` grows in that order, ``_range`` numbers the tasks.

    ``order`` should tell rows apart, so that ranges can be cut anywhere.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(rows.withColumn("_row", F.monotonically_increasing_id()), "ranged").withColumn("_range", F.shiftright("_row", 33))


def range_totals(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Add ``{m}_before`` for each measure: its sum over earlier rows of the same key, in the order of ``ranged``.

    A window runs over one range of a key; what came in earlier ranges is one row per key and range. Without keys all rows are one sequence.
    """
    earlier = (Window.unboundedPreceding, -1)
    here = Window.partitionBy(*keys, "_range").orderBy("_row").rowsBetween(*earlier)
    ranges = Window.partitionBy(*keys).orderBy("_range").rowsBetween(*earlier)
    totals = (
        rows.groupBy(*keys, "_range").agg(*[F.sum(m).alias(m) for m in measures])
        .select(*keys, "_range", *[_or_zero(F.sum(m).over(ranges)).alias(f"_{m}_ranges") for m in measures])
    )
    return (
        rows.select("*", *[_or_zero(F.sum(m).over(here)).alias(f"_{m}_rows") for m in measures])
        .join(totals, [*keys, "_range"])
        .select(*rows.columns, *[(F.col(f"_{m}_ranges") + F.col(f"_{m}_rows")).cast("bigint").alias(f"{m}_before") for m in measures])
    )
