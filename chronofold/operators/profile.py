"""Value counts, class summaries and examples of a result-value column."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP_VALUES = 50
TRACKED = 100_000  # counters of a summary
CANDIDATES = 20  # times as many values are counted again as are asked for
SUMMARY_ERROR = 3.5 * 0.75  # a frequent-items sketch of m slots holds 0.75 m counters and is off by at most 3.5 / m
EXAMPLES = 10
EXAMPLE_SEPARATOR = " | "


def value_counts(values: DataFrame, *columns: str) -> DataFrame:
    """Rows per distinct value (or value and metadata); null values are left out."""
    return values.where(F.col(columns[0]).isNotNull()).groupBy(*columns).agg(
        F.count(F.lit(1)).alias("count")
    )


def top_values(counts: DataFrame, *order: str, n: int = TOP_VALUES) -> DataFrame:
    """The most frequent values, ties by value."""
    return counts.orderBy(F.desc("count"), *order).limit(n)


def top_frequent(values: DataFrame, column: str, n: int = TOP_VALUES, tracked: int = TRACKED) -> DataFrame:
    """``column`` and ``count`` of the ``n`` most frequent values, exactly, ties by value; null values are left out.

    A summary of ``tracked`` counters per task, merged, names candidates; only their rows are counted again and shuffled, as one row per task and
    candidate. Counts of the summary are off by at most ``SUMMARY_ERROR`` / ``tracked`` of the rows, and a value that it does not name has no
    more rows than twice that, or than its last candidate and that. If the ``n``-th exact count is above what any value not counted again can have, the answer is proven; else (values that
    are all about as rare) all values are counted.
    """
    present = values.where(F.col(column).isNotNull()).select(column)
    asked = CANDIDATES * n
    found, rows = present.select(F.expr(f"approx_top_k(`{column}`, {asked}, {tracked})"), F.count(F.lit(1))).first()
    off = math.ceil(rows * SUMMARY_ERROR / tracked)
    if not found:  # no row, or no value that stands out
        return top_values(value_counts(present, column), column, n=n)
    candidates = values.sparkSession.createDataFrame([(r["item"],) for r in found], present.schema)
    exact = value_counts(present.join(F.broadcast(candidates), column, "left_semi"), column)  # ``asked`` values at most
    best = exact.orderBy(F.desc("count"), column).limit(n).collect()
    unseen = 2 * off + (found[-1]["count"] if len(found) == asked else 0)
    if len(best) == n and best[-1]["count"] > unseen:
        return values.sparkSession.createDataFrame([(r[column], r["count"]) for r in best], exact.schema)
    return top_values(value_counts(present, column), column, n=n)


def classify(counts: DataFrame, label: Column, name: str) -> DataFrame:
    """Classify distinct values rather than rows: the rules run once per value."""
    return counts.withColumn(name, label)


def class_examples(classified: DataFrame, name: str, *order: str, n: int = EXAMPLES) -> DataFrame:
    """The ``n`` most frequent values of every class with their rank.

    The rank filter becomes a group limit before the shuffle, so a class with many distinct values
    sends only its best ``n`` from each task.
    """
    window = Window.partitionBy(name).orderBy(F.desc("count"), *order)
    return classified.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def class_summary(
    classified: DataFrame, name: str, value: str, *order: str, n: int = EXAMPLES
) -> DataFrame:
    """Rows, distinct values and joined examples of every class, largest class first."""
    totals = (
        classified.groupBy(name, value)
        .agg(F.sum("count").alias("count"))
        .groupBy(name)
        .agg(F.sum("count").alias("total_rows"), F.count(F.lit(1)).alias("unique_values"))
    )
    examples = (
        class_examples(classified, name, *order, n=n)
        .groupBy(name)
        .agg(F.array_sort(F.collect_list(F.struct("rank", value))).alias("items"))
        .select(name, F.array_join(F.col(f"items.{value}"), EXAMPLE_SEPARATOR).alias("examples_joined"))
    )
    return totals.join(examples, name).orderBy(F.desc("total_rows"), name)
