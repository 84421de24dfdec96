import random

import pytest
from pyspark.sql import functions as F

from chronofold.operators import audit, shards, splits
from chronofold.operators.running import range_totals, ranged
from chronofold.plans import catalog


def by_hand(sizes, budget):
    numbers, shard, fill = [], 0, 0
    for n in sizes:
        if fill and (fill + n > budget or fill >= budget):
            shard, fill = shard + 1, 0
        numbers.append(shard)
        fill += n
    return numbers


def samples_df(spark, n=60):
    rows = [(i % 7, i // 7 + 1, f"{i % 7}_{i // 7 + 1}", (i * 13) % 50 + 1) for i in range(n)]
    return splits.add_split(
        spark.createDataFrame(rows, "subject_id bigint, sample_no bigint, sample_id string, n_events bigint")
    )


@pytest.mark.parametrize(("seed", "budget", "tasks"), [(1, 20, 1), (2, 100, 7), (3, 1, 3), (4, 5000, 7)])
def test_same_as_filling_one_after_the_other(spark, seed, budget, tasks):
    rng = random.Random(seed)
    rows = [(s, k + 1, f"{s}_{k + 1}", rng.choice([1, 1, 2, rng.randint(1, 40), rng.randint(1, 400)]), "ab"[s % 2])
            for s in range(12) for k in range(rng.randint(1, 60))]
    rows += [(99, k + 1, f"99_{k + 1}", 1, "c") for k in range(300)]
    samples = spark.createDataFrame(rows, "subject_id bigint, sample_no bigint, sample_id string, n_events bigint, split string")
    got = {r.sample_id: r for r in shards.assign_shards(samples.repartition(tasks), budget).collect()}
    assert len(got) == len(rows)
    for split in "abc":
        mine = [r for r in sorted(rows) if r[4] == split]
        numbers = by_hand([r[3] for r in mine], budget)
        assert [got[r[2]].shard_seq for r in mine] == numbers
        for i, r in enumerate(mine):
            assert got[r[2]].shard_offset == sum(x[3] for x, n in zip(mine[:i], numbers, strict=False) if n == numbers[i])
            assert got[r[2]].shard == f"shard-{numbers[i]:04d}"


def test_no_samples(spark):
    assert shards.assign_shards(samples_df(spark).limit(0), 5).count() == 0


def test_ranges_of_one_key(spark):
    df = spark.range(0, 5000, 1, 5).select((F.col("id") % 2).alias("k"), "id", F.lit(3).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = ranged(df, ["k", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows.select("_range").distinct().count() > 1
    got = range_totals(rows, ["k"], ["n"]).collect()
    assert len(got) == 5000 and all(r.n_before == r.id // 2 * 3 for r in got)


def test_shard_balance(spark):
    got = shards.shard_balance(shards.assign_shards(samples_df(spark), 40), 40)
    assert got.where("fill > 1 and samples > 1").count() == 0 and got.agg(F.sum("samples")).first()[0] == 60


def test_each_subject_has_one_split_and_shard(spark):
    events = spark.range(2000).select(F.floor(F.col("id") / 2).alias("subject_id"))
    got = splits.subject_shards(events, 4)
    assert got.count() == 1000 == got.select("subject_id").distinct().count()
    sizes = {r.split: r.subjects for r in splits.split_sizes(got).collect()}
    assert sizes["train"] > 700 and set(sizes) == {"train", "tuning", "held_out"}
    assert splits.split_preview(got, 2).count() == 6


def test_audit_finds_missing_rows(spark):
    manifest = spark.createDataFrame([("1_1", "train", "a", 2), ("2_1", "train", "b", 1)], "sample_id string, split string, shard string, n_events bigint")
    rows = spark.createDataFrame([("1_1", "train", "a")], "sample_id string, split string, shard string")
    got = {r.shard: r.ok for r in audit.audit_output(rows.union(rows), manifest).collect()}
    assert got == {"a": True, "b": False}


def test_audited_samples_are_placed_before_the_fan_out(spark, sf_dir, monkeypatch):
    plans = []

    def staged(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df

    monkeypatch.setattr(catalog, "staged", staged)
    catalog.audit_output(spark, sf_dir)
    assert "Generate explode(sequence(1, copies" in plans[-1][: plans[-1].index("Join")]
