import random

from pyspark.sql import functions as F

from chronofold.operators import events as ev
from chronofold.operators import running
from tests.helpers import events_df


def test_a_crowded_hour_is_cut_and_totals_stay(spark):
    rng = random.Random(31)
    rows = [(1, rng.random() ** 3 * 59.9, "A", 1.0, k) for k in range(2000)]  # one hour, most of it near its start
    rows += [(1, 60 + rng.random() * 300, "A", 1.0, 5000 + k) for k in range(50)]
    rows += [(2, rng.random() * 600, "A", 1.0, 9000 + k) for k in range(80)]
    df = events_df(spark, rows).select("subject_id", "time", "seq", F.lit(2).alias("n"))
    found = running.running_totals(df, ["subject_id"], "time", ["n"], ["seq"], rows_per_slot=100)
    got = {r.seq: (r.n_before, r._slot) for r in found.collect()}
    for subject in (1, 2):
        mine = sorted((r[1], r[4]) for r in rows if r[0] == subject)
        assert [got[seq][0] for _, seq in mine] == [2 * k for k in range(len(mine))]
        slots = [got[seq][1] for _, seq in mine]
        assert slots == sorted(slots)
    sizes = found.where("subject_id = 1").groupBy("_slot").count().collect()
    assert max(r["count"] for r in sizes) <= 200 and len(sizes) > 15
    plain = running.running_totals(df, ["subject_id"], "time", ["n"], ["seq"])
    assert {r.seq: r.n_before for r in plain.collect()} == {k: v[0] for k, v in got.items()}


def test_equal_times_stay_in_one_slot(spark):
    rows = [(1, 5 if k % 3 else 7, "A", 1.0, k) for k in range(300)]
    df = events_df(spark, rows).select("subject_id", "time", "seq", F.lit(1).alias("n"))
    found = running.running_totals(df, ["subject_id"], "time", ["n"], ["seq"], rows_per_slot=20).collect()
    assert [r.n_before for r in sorted(found, key=lambda r: (r.time, r.seq))] == list(range(300))
    assert len({r._slot for r in found}) == 2


def test_event_numbers_of_a_crowded_hour(spark, monkeypatch):
    rng = random.Random(32)
    rows = [(s, rng.randint(0, 3000) / 60, "A", 1.0, 10_000 * s + k) for s in (1, 2) for k in range(400)]
    events = events_df(spark, rows)
    plain = sorted(map(tuple, ev.number_events(events).select("seq", "group_start", "group_size", "event_no").collect()))
    monkeypatch.setattr(running.running_totals, "__defaults__", (None, None, 30))
    cut = ev.number_events(events).select("seq", "group_start", "group_size", "event_no")
    assert sorted(map(tuple, cut.collect())) == plain
    order = sorted((r[0], r[1], r[4]) for r in rows)
    for s in (1, 2):
        mine = [seq for subject, _, seq in order if subject == s]
        assert [n for seq in mine for q, _, _, n in plain if q == seq] == list(range(1, 401))


def test_event_numbers_of_heavy_subjects(spark, monkeypatch):
    rng = random.Random(33)
    rows = [(s, rng.randint(0, 400) / 2, "A", 1.0, 10_000 * s + k) for s, n in ((1, 300), (2, 40), (3, 1)) for k in range(n)]
    events = events_df(spark, rows + [(None, 0, "A", 1.0, 1), (4, None, "A", 1.0, 2)])
    plain = ev.number_events(events)
    monkeypatch.setattr(ev, "SEQ_BLOCK", 7)
    assert sorted(map(tuple, ev.number_events(events, 50).collect())) == sorted(map(tuple, plain.collect()))
    assert dict(plain.dtypes) == dict(ev.number_events(events, 50).dtypes)
    order = sorted((r[0], r[1], r[4]) for r in rows)
    found = {r.seq: r.event_no for r in plain.collect()}
    assert [found[seq] for _, _, seq in order] == [*range(1, 301), *range(1, 41), 1]


def test_events_move_once_by_subject(spark, tmp_path):
    path = str(tmp_path / "events")
    events_df(spark, [(s, m, "A", 1.0, 100 * s + m) for s in range(9) for m in range(20)]).write.parquet(path)
    groups = ev.event_groups(spark.read.parquet(path), 4)
    assert groups.count() == 180
    assert groups._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
