"""Subjects to splits and shards by hash, the same on every run and machine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.schema import SPLIT_NAMES, SUBJECT

BUCKETS = 1000
SPLIT_LIMITS = (800, 900, 1000)


def subject_bucket(subject: Column, seed: str, buckets: int | None = None) -> Column:
    """A number from 0 that depends on the seed and subject only."""
    text = F.concat_ws("|", F.lit(seed), subject.cast("string"))
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return number if buckets is None else F.pmod(number, F.lit(buckets))


def split_of(subject: Column, seed: str = "split") -> Column:
    """train, tuning or held_out for 80, 10 and 10 per cent of the subjects, approximately."""
    bucket = subject_bucket(subject, seed, BUCKETS)
    train, tuning, _ = SPLIT_LIMITS
    return (
        F.when(bucket < train, SPLIT_NAMES[0])
        .when(bucket < tuning, SPLIT_NAMES[1])
        .otherwise(SPLIT_NAMES[2])
    )


def shard_of(subject: Column, n_shards: int, seed: str = "shard") -> Column:
    return F.pmod(subject_bucket(subject, seed), F.lit(n_shards)).cast("int")


def subject_splits(events: DataFrame) -> DataFrame:
    """Every subject once, with its split."""
    return (
        events.where(F.col(SUBJECT).isNotNull())
        .select(SUBJECT)
        .distinct()
        .select(SUBJECT, split_of(F.col(SUBJECT)).alias("split"))
    )


def subject_shards(events: DataFrame, n_shards: int) -> DataFrame:
    """Every subject once, with its split and shard."""
    return subject_splits(events).withColumn("shard", shard_of(F.col(SUBJECT), n_shards))


def add_split(df: DataFrame) -> DataFrame:
    """Split as a column expression: no join to the split table is needed."""
    return df.withColumn("split", split_of(F.col(SUBJECT)))


def split_sizes(splits: DataFrame) -> DataFrame:
    return splits.groupBy("split").agg(F.count(F.lit(1)).alias("subjects"))


def split_preview(splits: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` subjects of every split."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("split").orderBy(SUBJECT))
    return splits.withColumn("place", place).where(F.col("place") <= n)
