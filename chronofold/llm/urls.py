"""URL rules by host-suffix and path-prefix expressions, matched on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_DIGITS = 8  # hex digits of the short hash that is joined on
BROADCAST_RULES = 100_000  # above, the rules are joined by shuffle
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT_VERDICT = "allow"


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """``rule`` (host and path prefix, as ``net/``) and ``verdict`` from (verdict, rule) pairs."""
    if not rules:
        return spark.range(0).select(F.lit("").alias("rule"), F.lit("").alias("verdict"))
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for v, r in rules])
    return spark.range(1).select(F.inline(rows))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL, both empty for null and where there is no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT_VERDICT, keep: tuple[str, ...] = ("page_id",)
) -> DataFrame:
    """One row per page: the ``keep`` columns, host, path, rule, verdict.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest fitting rule
    wins; of equally long ones the longer host, then block before allow. Without one the rule is null and the verdict is ``default``.
    Null and broken URLs have an empty host and path. Repeated rows and null ids are judged each; an empty
    table gives none; further columns are not read. Of equal rules a block counts.

    Each URL is expanded into the host suffixes and path prefixes of the lengths that occur among the rules, so the
    number of expressions does not grow with the length of a URL. The expressions meet the rules on the
    first digits of their SHA-256; the full digest decides. Rules are broadcast up to ``BROADCAST_RULES``,
    whose lengths, a few numbers, are collected.
    """
    rule_host = F.substring_index("rule", "/", 1)
    parts = rules.where("rule is not null").groupBy("rule").agg(F.max("verdict").alias("verdict")).select(
        F.sha2("rule", 256).alias("_digest"),
        F.col("rule").alias("_rule"),
        F.col("verdict").alias("_verdict"),
        F.length(rule_host).alias("_host_size"),
        F.size(F.split(rule_host, r"\.")).alias("_labels"),
    )
    sizes = parts.agg(
        F.collect_set("_labels").alias("labels"),
        F.collect_set(F.length("_rule") - F.col("_host_size")).alias("prefixes"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    labels = F.array(*[F.lit(x) for x in sorted(sizes["labels"])]).cast("array<int>")
    prefixes = F.array(*[F.lit(x) for x in sorted(sizes["prefixes"])]).cast("array<int>")
    keyed = parts.withColumn("_key", F.left("_digest", F.lit(PREFIX_DIGITS)))
    if sizes["n"] <= BROADCAST_RULES:
        keyed = F.broadcast(keyed)

    host, path = host_and_path(F.col(f"`{url}`"))
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], host.alias("host"), path.alias("path"))
    split = F.split("host", r"\.")
    # A negative start beyond the array gives none, so a suffix longer than the host is left out.
    suffixes = F.transform(F.filter(labels, lambda k: k <= F.size(split)), lambda k: F.array_join(F.slice(split, -k, k), "."))
    starts = F.transform(F.filter(prefixes, lambda n: n <= F.length("path")), lambda n: F.left("path", n))
    texts = F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))
    expanded = rows.withColumn("_row", F.monotonically_increasing_id()).select(
        "*", F.explode_outer(F.transform(texts, lambda t: F.sha2(t, 256))).alias("_hash")
    )
    met = expanded.join(keyed, F.left("_hash", F.lit(PREFIX_DIGITS)) == F.col("_key"), "left")
    confirmed = F.col("_hash") == F.col("_digest")  # not among the join's keys: the short hash alone brings them together
    rank = F.struct(F.length("_rule").alias("size"), "_host_size", "_verdict", F.col("_rule").alias("rule"))
    best = F.max(F.when(confirmed, rank)).alias("_best")
    # One task makes all expressions of a row, so all but one row of each are gone before the shuffle.
    return met.groupBy("_row", *keep, "host", "path").agg(best).select(
        *keep, "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best._verdict", F.lit(default)).alias("verdict")
    )
