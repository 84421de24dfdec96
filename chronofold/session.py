"""Session defaults shared by the tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    checkpoint_dir: str | None = None,
) -> SparkSession:
    """A session with the settings the jobs rely on.

    On a cluster leave the arguments out: master, memory, partition count and
    ``spark.checkpoint.dir`` then come from spark-submit.
    """
    builder = (
        SparkSession.builder.appName("chronofold")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master is not None:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.bindAddress", "127.0.0.1")
            .config("spark.driver.memory", "12g")
        )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint_dir is not None:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return builder.getOrCreate()
