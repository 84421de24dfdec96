"""Written intermediate tables: they cut lineage and survive lost executors."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; on a local master without one, a folder of the warehouse."""
    context = spark.sparkContext
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"


_job: ContextVar[str | None] = ContextVar("_job", default=None)


def clears_staging(job: Callable) -> Callable:
    """For jobs that write all they return: what they stage goes to one folder, which is deleted at the end.

    The job's first argument is a DataFrame.
    """

    @wraps(job)
    def run(first: DataFrame, *args, **options):
        spark = first.sparkSession
        folder = f"{staging_root(spark)}/job-{uuid.uuid4().hex}"
        token = _job.set(folder)
        try:
            return job(first, *args, **options)
        finally:
            _job.reset(token)
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    return run


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the staging folder and read it back; ``compression`` names a Parquet codec other than the session's."""
    spark = df.sparkSession
    path = f"{_job.get() or staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
