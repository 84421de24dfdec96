"""Result values to class summaries, examples and top values, as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.functions.classify import bucket, category
from chronofold.operators import profile
from chronofold.sources.staging import clears_staging, staged
from chronofold.sources.writers import write_mode


@clears_staging
def profile_values(values: DataFrame, root: str, if_exists: str = "error") -> dict[str, str]:
    """Profile a ``raw`` column, and by (raw, meta) if there is a ``meta`` column.

    Counts are staged; all reports come from them. A report has at most ten rows per class or 50 in
    all, so each is one small file.
    """
    reports: dict[str, DataFrame] = {}
    counts = staged(profile.value_counts(values, "raw"), "counts")
    classed = profile.classify(counts, category(F.col("raw")), "category")
    reports["category_summary"] = profile.class_summary(classed, "category", "raw", "raw")
    reports["category_examples"] = _examples(classed, "category", "raw")
    reports["top_values"] = profile.top_values(counts, "raw")
    if "meta" in values.columns:
        fine = staged(profile.value_counts(values, "raw", "meta"), "meta_counts")
        bucketed = profile.classify(fine, bucket(F.col("raw")), "bucket")
        reports["bucket_summary"] = profile.class_summary(bucketed, "bucket", "raw", "raw", "meta")
        reports["bucket_examples"] = _examples(bucketed, "bucket", "raw", "meta")
        top = profile.top_values(counts, "raw").select(
            F.col("raw").alias("raw_value_exact"), bucket(F.col("raw")).alias("bucket"), "count"
        )
        reports["bucket_top_values"] = top
    paths = {}
    for name, report in reports.items():
        paths[name] = f"{root}/{name}"
        report.coalesce(1).write.mode(write_mode(if_exists)).option("header", True).csv(paths[name])
    return paths


def _examples(classified: DataFrame, name: str, *order: str) -> DataFrame:
    found = profile.class_examples(classified, name, *order)
    return found.orderBy(name, "rank").select(name, F.col("raw").alias("example"))
