import random

import pytest
from pyspark.sql import functions as F

from chronofold.operators import labels as lb
from chronofold.operators import samples, store
from chronofold.plans.catalog import QUERIES
from chronofold.sources import writers
from tests.helpers import events_df, labels_df


def made(spark, seed, n_subjects=6):
    """Events with shared times, labels of which some repeat (copies), and ids that name their event."""
    rng = random.Random(seed)
    rows = [(s, rng.randint(0, 40), "A", 1.0, 1000 * s + k) for s in range(n_subjects) for k in range(rng.randint(1, 60))]
    asked = [(s, rng.randint(0, 60), rng.random() < 0.5, k) for s in range(n_subjects + 1) for k in range(5) for _ in range(rng.randint(1, 2))]
    events = events_df(spark, rows)
    labels = lb.clean_labels(labels_df(spark, [(*r[:3], i) for i, r in enumerate(asked)] + [(0, 30, True, 900), (0, 30, True, 901)], ", note bigint"))
    ids = F.array(F.col("seq").cast("int"), F.lit(1))
    encoded = events.where("seq % 11 <> 0").select("seq", ids.alias("input_ids"), ids.alias("type_ids"), ids.alias("place_ids"))
    return events, labels, encoded


def plain(df):
    return sorted((r.sample_id, r.part, r.n_events, r.time, [[list(x) for x in e] for e in r.hi]) for r in df.collect())


@pytest.mark.parametrize(("seed", "block"), [(1, 4), (2, 16), (3, 256)])
def test_expanded_store_equals_nested_samples(spark, tmp_path, seed, block):
    events, labels, encoded = made(spark, seed)
    headers = lb.sample_headers(events, labels)
    assert headers.where("copies > 1").count() > 0
    placed = samples.sample_positions(events, headers, labels)
    path = str(tmp_path / "blocks")
    writers.write_event_blocks(store.event_blocks(events, encoded, block), path, 3)
    blocks = writers.read_event_blocks(spark, path)
    assert plain(store.expand_samples(headers, blocks, block)) == plain(samples.nested_samples(placed, encoded, block))
    assert blocks.select(F.sum(F.size("events"))).first()[0] == encoded.count()  # each event once


def test_blocks_do_not_move(spark, tmp_path):
    events, labels, encoded = made(spark, 4, 40)
    path = str(tmp_path / "blocks")
    writers.write_event_blocks(store.event_blocks(events, encoded, 8), path, 5)
    headers = lb.sample_headers(events, labels)
    headers.write.parquet(str(tmp_path / "samples"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = store.expand_samples(spark.read.parquet(str(tmp_path / "samples")).where("copies = 1"), writers.read_event_blocks(spark, path), 8)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    first = plan[: plan.index("copies")] if "Union" not in plan else plan
    lines = first.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line and "events#" in line]
    assert scans
    for i in scans:  # from the scan of the blocks up to its join
        above = []
        depth = lines[i].index("FileScan")
        for line in reversed(lines[:i]):
            if len(line) - len(line.lstrip(" :+-")) < depth:
                depth = len(line) - len(line.lstrip(" :+-"))
                above.append(line)
                if "Join" in line:
                    break
        assert "Join" in above[-1] and not any("Exchange" in line for line in above)


def test_written_twice(spark, tmp_path):
    events, _, encoded = made(spark, 5)
    blocks = store.event_blocks(events, encoded, 8)
    path = str(tmp_path / "blocks")
    writers.write_event_blocks(blocks, path, 2)
    with pytest.raises(FileExistsError):
        writers.write_event_blocks(blocks, path, 2)
    writers.write_event_blocks(blocks.limit(0), path, 7, "skip")
    writers.write_event_blocks(blocks, path, 4, "rebase")
    assert writers.read_event_blocks(spark, path).count() == blocks.count()


def test_blocks_are_read_by_row(spark, tmp_path):
    """A columnar batch would hold the ids of thousands of blocks at once."""
    events, _, encoded = made(spark, 6)
    path = str(tmp_path / "blocks")
    writers.write_event_blocks(store.event_blocks(events, encoded, 8), path, 2)
    plan = writers.read_event_blocks(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Batched: false" in plan


@pytest.mark.parametrize("name", ["sample_nested", "sample_store"])
def test_ids_become_text_before_samples_share_them(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    text = "lambdafunction(array_join("
    assert text in plan and text not in plan[: plan.index("Join")]
