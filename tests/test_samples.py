import random
from collections import defaultdict
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from chronofold.operators import events as ev
from chronofold.operators import labels as lb
from chronofold.operators import samples as sm
from chronofold.operators.running import running_totals
from chronofold.operators.skew import _grid, grid_join, lookup_join
from tests.helpers import at, events_df, labels_df, rows_of


def build(spark, event_rows, label_rows, extra=""):
    events = ev.clean_events(events_df(spark, event_rows))
    labels = lb.clean_labels(labels_df(spark, label_rows, extra))
    return events, labels, lb.sample_headers(events, labels)


def test_birth_and_null_events_are_dropped(spark):
    rows = [(1, 0, "MEDS_BIRTH", None, 1), (1, None, "A", 1.0, 2), (None, 0, "A", 1.0, 3), (1, 5, None, 1.0, 4), (1, 6, "B", 1.0, 5)]
    df = events_df(spark, rows)
    nulled = ev.null_birth_time(df).na.drop(subset=["subject_id", "time"])
    assert rows_of(ev.clean_events(df), "seq") == rows_of(nulled, "seq") == [(4,), (5,)]


def test_prediction_time_is_inclusive_to_the_microsecond(spark):
    late = at(10) + timedelta(microseconds=1)
    events, labels, headers = build(spark, [(1, 10, "A", 1.0, 1), (1, late, "B", 1.0, 2)], [(1, 10, True)])
    assert rows_of(headers, "sample_id", "n_events", "label") == [("1_1", 1, 1)]
    assert rows_of(sm.sample_events(events, headers, labels), "sample_id", "seq") == [("1_1", 1)]


def test_label_before_the_first_event_uses_no_number(spark):
    events, labels, headers = build(
        spark, [(1, 10, "A", 1.0, 1), (1, 20, "B", 1.0, 2)], [(1, 5, True), (1, 15, False), (1, 25, True), (2, 25, True)]
    )
    expected = [("1_1", 0, 1), ("1_2", 1, 2)]
    assert rows_of(headers, "sample_id", "label", "n_events") == expected
    numbered = lb.number_samples(events, labels)
    assert rows_of(numbered, "sample_id", "label") == [(s, l) for s, l, _ in expected]
    assert rows_of(sm.sample_events(events, headers, labels), "sample_id", "seq") == [("1_1", 1), ("1_2", 1), ("1_2", 2)]


def test_rows_differing_in_an_ignored_column_repeat_the_events_as_blocks(spark):
    events, labels, headers = build(
        spark,
        [(1, 1, "A", 1.0, 1), (1, 1, "B", 1.0, 2), (1, 2, "C", 1.0, 3)],
        [(1, 9, True, "x"), (1, 9, True, "y"), (1, 9, True, "y")],
        ", note string",
    )
    assert rows_of(headers, "sample_id", "copies", "n_events") == [("1_1", 2, 6)]
    placed = sm.sample_positions(events, headers, labels)
    assert rows_of(placed, "pos", "seq") == [(1, 1), (2, 2), (3, 1), (4, 2), (5, 3), (6, 3)]
    once = lb.clean_labels(labels_df(spark, [(1, 9, True, "x"), (1, 9, True, "y")], ", note string"), dedupe=True)
    assert rows_of(once, "copies") == [(1,)]


def test_both_labels_at_one_time_are_two_samples(spark):
    _, _, headers = build(spark, [(1, 1, "A", 1.0, 1)], [(1, 9, True), (1, 9, False)])
    assert rows_of(headers, "sample_id", "label") == [("1_1", 0), ("1_2", 1)]


def test_null_labels_and_times_are_dropped(spark):
    labels = lb.clean_labels(labels_df(spark, [(1, 9, None), (1, None, True), (None, 9, True), (2, 9, True)]))
    assert rows_of(labels, "subject_id") == [(2,)]


@pytest.mark.parametrize("seconds, minutes", [(0, 0), (30, 0), (90, 2), (31, 1), (150, 2), (89.9, 1)])
def test_minutes_round_half_to_even(spark, seconds, minutes):
    events, labels, headers = build(spark, [(1, 0, "A", 1.0, 1), (1, seconds / 60, "B", 1.0, 2)], [(1, 60, True)])
    assert rows_of(sm.sample_events(events, headers, labels), "seq", "minute") == [(1, 0), (2, minutes)]


def test_other_label_column(spark):
    raw = labels_df(spark, [(1, 9, True)]).withColumn("severity", F.lit(3))
    assert rows_of(lb.clean_labels(raw, "severity"), "label") == [(3,)]
    with pytest.raises(ValueError, match="missing columns"):
        lb.clean_labels(raw, "absent")


def random_case(seed, n_events=400, n_labels=60):
    rng = random.Random(seed)
    event_rows = []
    for seq in range(n_events):
        subject = 1 if rng.random() < 0.4 else rng.randint(2, 12)
        event_rows.append((subject, rng.choice([rng.randint(0, 40), rng.randint(0, 4000)]), rng.choice("ABC"), 1.0, seq))
    label_rows = [
        (1 if rng.random() < 0.4 else rng.randint(2, 14), rng.randint(0, 5000), rng.random() < 0.5, rng.choice("xy"))
        for _ in range(n_labels)
    ]
    return event_rows, label_rows


def brute_samples(event_rows, label_rows):
    """sample id -> ordered (seq, minute) list, by the plain rule."""
    groups = defaultdict(lambda: defaultdict(list))
    for subject, time, _, _, seq in event_rows:
        groups[subject][time].append(seq)
    out = {}
    labels = defaultdict(set)
    for row in set(label_rows):
        labels[row[:3]].add(row)
    number = defaultdict(int)
    for (subject, when, _), same in sorted(labels.items()):
        times = [t for t in sorted(groups[subject]) if t <= when]
        if not times:
            continue
        number[subject] += 1
        rows = [(s, round(t - times[0])) for t in times for _ in same for s in sorted(groups[subject][t])]
        out[f"{subject}_{number[subject]}"] = rows
    return out


@pytest.mark.parametrize("seed, rows_per_task", [(1, 2_000_000), (2, 7), (3, 1)])
def test_samples_against_brute_force(spark, seed, rows_per_task):
    event_rows, label_rows = random_case(seed)
    events, labels, headers = build(spark, event_rows, label_rows, ", note string")
    expected = brute_samples(event_rows, label_rows)
    assert {r.sample_id: r.n_events for r in headers.collect()} == {s: len(v) for s, v in expected.items()}
    placed = sm.sample_positions(events, lb.number_samples(events, labels), labels, rows_per_task)
    found = defaultdict(list)
    for r in placed.orderBy("sample_id", "pos").collect():
        found[r.sample_id].append((r.seq, r.minute))
    assert found == expected
    plain = sm.sample_events(events, headers, labels, rows_per_task)
    assert sorted((r.sample_id, r.seq) for r in plain.collect()) == sorted(
        (s, q) for s, v in expected.items() for q, _ in v
    )
    tail = defaultdict(list)
    for r in sm.sample_tail(events, headers, labels, 10, rows_per_task).orderBy("sample_id", "pos").collect():
        tail[r.sample_id].append((r.seq, r.minute))
    shifted = {s: [(q, m - v[-10:][0][1]) for q, m in v[-10:]] for s, v in expected.items()}
    assert tail == shifted
    parts = sm.sample_sequences(placed, 16).orderBy("sample_id", "part").collect()
    joined = defaultdict(list)
    for r in parts:
        assert len(r.minutes) <= 16
        joined[r.sample_id] += list(zip(r.event_keys, r.minutes))
    assert joined == expected


def test_event_numbers_with_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ev, "SEQ_BLOCK", 3)
    event_rows, _ = random_case(4)
    found = {r.seq: (r.group_start, r.group_size, r.group_index, r.event_no) for r in ev.number_events(events_df(spark, event_rows)).collect()}
    by_subject = defaultdict(list)
    for subject, time, _, _, seq in event_rows:
        by_subject[subject].append((time, seq))
    for rows in by_subject.values():
        rows.sort()
        for number, (time, seq) in enumerate(rows, 1):
            start = sum(t < time for t, _ in rows)
            size = sum(t == time for t, _ in rows)
            assert found[seq] == (start, size, number - start, number)


def test_event_groups_in_parts(spark):
    df = events_df(spark, [(1, 0, f"C{i}", 1.0, i) for i in range(7)] + [(1, 1, "D", 1.0, 9)])
    got = sorted((r.part, r.group_size, r.codes, len(r.times)) for r in ev.event_groups(df, 3).collect() if r.group_size == 7)
    assert got == [(0, 7, ["C0", "C1", "C2"], 3), (1, 7, ["C3", "C4", "C5"], 3), (2, 7, ["C6"], 1)]


def test_running_totals_across_hours_and_days(spark):
    rows = [(1, at(m), 1) for m in (0, 30, 60, 61, 60 * 24, 60 * 50)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, n int")
    assert [r[0] for r in running_totals(df, ["k"], "t", ["n"]).orderBy("t").select("n_before").collect()] == [0, 1, 2, 3, 4, 5]


def test_label_lists_explode_back(spark):
    labels = lb.clean_labels(labels_df(spark, [(1, i % 40, i % 3 == 0) for i in range(50)]))
    lists = lb.subject_label_lists(labels, 6)
    assert max(len(r.cohort_end) for r in lists.collect()) == 6
    back = lb.explode_label_lists(lists)
    assert rows_of(back, "subject_id", "cohort_end", "cohort_label") == rows_of(labels, "subject_id", "prediction_time", "label")


def test_lookup_join_keeps_columns_and_rows(spark):
    facts = spark.createDataFrame([(i, None if i % 11 == 0 else ("hot" if i % 3 else f"k{i}")) for i in range(100)], "seq int, code string")
    lookup = spark.createDataFrame([("hot", 1, None), ("k3", 2, "b"), ("k6", None, "c")], "code string, a int, b string")
    got = lookup_join(facts, lookup, "code")
    assert got.columns == ["seq", "code", "a", "b"]
    values = {"hot": (1, None), "k3": (2, "b"), "k6": (None, "c")}
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr((r.seq, r.code, *values.get(r.code, (None, None)))) for r in facts.collect())


def test_pairs_of_one_key_are_spread_by_their_number(spark):
    rows = 60
    left = spark.range(rows).selectExpr("if(id < 50, 1L, id) as key", "id as l")
    right = spark.range(rows).selectExpr("if(id < 50, 1L, id) as key", "id as r")
    budget = 100
    joined = grid_join(left, right, "key", F.lit(True), F.xxhash64("l"), F.xxhash64("r"), left, right, budget)
    assert joined.count() == 50 * 50 + 10
    (grid,) = _grid("key", left, right, budget).collect()  # 50 rows a side, 2,500 pairs
    assert grid.key == 1 and grid._a * grid._b >= 25 and grid._a <= 50 and grid._b <= 50
    assert 50 / grid._a * 50 / grid._b <= budget


def test_keep_subjects_and_prefix(spark):
    df = events_df(spark, [(s, m, "A", 1.0, s * 10 + m) for s in (1, 2, 3) for m in (0, 1)])
    assert rows_of(ev.keep_subjects(df, df.where("subject_id <> 2")), "subject_id") == [(1,), (1,), (3,), (3,)]
    labels = labels_df(spark, [(1, 0, True), (2, 5, True), (2, 0, False), (3, 0, True), (4, 9, True)])
    assert rows_of(ev.prefix_groups(df, labels, 3), "subject_id", "n_events") == [(1, 1), (2, 1), (2, 1)]


def test_align_labels(spark):
    events = events_df(spark, [(1, 0, "A", 1.0, 1)]).withColumn("split", F.lit("train"))
    labels = labels_df(spark, [(1, 9, True, "train"), (1, 8, True, "tuning"), (2, 9, True, "train")], ", split string")
    assert rows_of(lb.align_labels(events, labels), "subject_id", "split") == [(1, "train")]


def test_join_by_key_moves_each_side_once(spark, tmp_path):
    for name in ("l", "r"):
        spark.range(60).selectExpr("id % 7 as key", f"id as {name}").write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / n)) for n in ("l", "r"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = grid_join(left, right, "key", F.col("l") <= F.col("r"), F.xxhash64("l"), F.xxhash64("r"), left, right)
        assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
        assert joined.count() == sum(a % 7 == b % 7 and a <= b for a in range(60) for b in range(60))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


@pytest.mark.parametrize("tails_per_subject, rows_per_task", [(1, 2_000_000), (1, 5), (0, 5), (64, 5)])
def test_tails_of_long_and_short_subjects(spark, tails_per_subject, rows_per_task):
    event_rows, label_rows = random_case(6)
    events, labels, headers = build(spark, event_rows, label_rows, ", note string")
    tail = defaultdict(list)
    for r in sm.sample_tail(events, headers, labels, 10, rows_per_task, tails_per_subject).orderBy("sample_id", "pos").collect():
        tail[r.sample_id].append((r.seq, r.minute))
    expected = brute_samples(event_rows, label_rows)
    assert tail == {s: [(q, m - v[-10:][0][1]) for q, m in v[-10:]] for s, v in expected.items()}


def test_tail_rows_do_not_move(spark):
    event_rows, label_rows = random_case(7)
    events, labels, headers = build(spark, event_rows, label_rows, ", note string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sm.sample_tail(events, headers, labels, 10)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(subject_id" in plan and "hashpartitioning(sample_id" not in plan
        assert "_block" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
