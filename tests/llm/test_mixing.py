import random
from fractions import Fraction

import pytest

from chronofold.llm import mixing
from tests.llm.cases import ROWS, documents, empty


@pytest.mark.parametrize("slots", [[1], [1, 1], [7, 3], [1] * 30 + [34], [100, 5, 1, 22], [0, 4, 9]])
def test_the_schedule_keeps_every_window_and_share(slots):
    cycle = sum(slots)
    plan = mixing.pfair(slots)
    assert len(plan) == cycle
    done = [0] * len(slots)
    for now, (i, k, release, deadline) in enumerate(plan):
        assert k == done[i] and release <= now < deadline
        done[i] += 1
        for n, s in zip(done, slots, strict=True):
            assert abs(Fraction(s * (now + 1), cycle) - n) < 1
    assert done == slots


def test_random_schedules():
    rng = random.Random(12)
    for _ in range(100):
        test_the_schedule_keeps_every_window_and_share([rng.randint(1, 40) for _ in range(rng.randint(1, 12))])


def test_quotas():
    for weights, cycle in (([1, 1, 1], 10), ([1000, 1e-9], 16), ([0.2, 0.3, 0.5], 100), ([5], 4)):
        slots = mixing.quotas(weights, cycle)
        assert sum(slots) == cycle and min(slots) >= 1


def test_documents_follow_the_weights(spark):
    rng = random.Random(13)
    rows = [(k, "x" * rng.randint(50, 150), "en", ["a", "a", "a", "b", "c", None][k % 6]) for k in range(3000)]
    weights = {"a": 0.5, "b": 0.3, "c": 0.1, None: 0.1}
    found = mixing.mix(documents(spark, rows), weights, block_chars=2000, cycle=100).orderBy("mix_slot", "mix_order").collect()
    assert sorted(r["doc_id"] for r in found) == list(range(3000))
    blocks = sorted({(r["mix_slot"], r["mix_stream"], r["mix_block"]) for r in found}, key=lambda b: b[0])
    assert len({b[0] for b in blocks}) == len(blocks)  # a slot has one block
    ends = min(max(b[0] for b in blocks if b[1] == s) for s in weights)
    for stream, weight in weights.items():
        n = 0
        for slot, name, block in blocks:
            if name == stream:
                assert block == n
                n += 1
            if slot <= ends:
                assert abs(weight * (slot + 1) - n) < 1.001
    for r in found:
        assert r["mix_release"] <= r["mix_slot"] < r["mix_deadline"]


def test_default_weights_favour_small_sources(spark):
    rows = [(k, "x" * 100, "en", "big" if k % 10 else "small") for k in range(1000)]
    weight = {r["mix_stream"]: r["mix_weight"] for r in mixing.mix(documents(spark, rows)).collect()}
    assert weight["big"] == pytest.approx(0.75) and weight["small"] == pytest.approx(0.25)


def test_small_sources_share_a_stream(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STREAMS", 3)
    rows = [(k, "x" * 10, "en", f"s{k % 2}" if k < 80 else f"t{k}") for k in range(100)]
    found = mixing.mix(documents(spark, rows), block_chars=20, cycle=50).collect()
    assert len(found) == 100 and {r["mix_stream"] for r in found} == {"s0", "s1", "(other)"}
    weight = next(r["mix_weight"] for r in found if r["mix_stream"] == "(other)")
    assert weight == pytest.approx(20 * 10**0.5 / (20 * 10**0.5 + 2 * 400**0.5))


def test_awkward_rows(spark):
    docs = documents(spark, clashes=True)
    found = mixing.mix(docs, block_chars=1000)
    assert found.columns[: len(docs.columns) - 1] == [c for c in docs.columns if c != "mix_slot"]
    assert sorted(str(r["doc_id"]) for r in found.collect()) == sorted(str(i) for i, *_ in ROWS)
    laid = mixing.in_mixture_order(docs, block_chars=1000)
    assert laid.columns == docs.columns
    assert sorted(map(str, laid.collect())) == sorted(map(str, docs.collect()))
    assert mixing.mix(empty(spark)).count() == 0 and mixing.in_mixture_order(empty(spark)).count() == 0


def test_the_schedule_follows_the_exact_weights_over_long_runs():
    for others in (4, 19, 254):
        weights, done = [others] + [1] * others, [0] * (others + 1)
        last = -1
        for i, k, release, deadline, slot in mixing.schedule(weights, [15_000] + [15_000 // others] * others):
            assert k == done[i] and release <= slot < deadline and slot > last
            done[i], last = k + 1, slot
            if slot < 29_000:
                assert abs(Fraction(slot + 1, 2) - done[0]) < 1
        assert done[0] == 15_000


def test_streams_end_and_the_others_go_on():
    found = list(mixing.schedule([5, 3, 2], [2, 30, 7]))
    assert len(found) == 39 and all(release <= slot < deadline for *_, release, deadline, slot in found)


def test_target_weights_hold_in_the_table(spark):
    rows = [(k, "x" * 100, "en", "big" if k < 2000 else f"s{k % 40}") for k in range(4000)]
    weights = {"big": 0.5} | {f"s{k}": 0.5 / 40 for k in range(40)}
    found = mixing.mix(documents(spark, rows), weights, block_chars=100).collect()
    big = sorted(r["mix_slot"] for r in found if r["mix_stream"] == "big")
    assert next(r["mix_weight"] for r in found if r["mix_stream"] == "big") == pytest.approx(0.5, abs=1e-12)
    for n, slot in enumerate(big):
        assert abs(0.5 * (slot + 1) - (n + 1)) <= 1


def test_every_source_has_its_own_stream(spark):
    rows = [(k, "x" * 10 * (1 + k % 3), "en", f"s{k % 300}") for k in range(1200)]
    rows += [(5000 + k, "y" * 50, "en", "(other)" if k % 2 else None) for k in range(10)]
    weights = {f"s{k}": 1.0 for k in range(299)} | {"s299": 300.0, None: 2.0}
    found = mixing.mix(documents(spark, rows), weights, block_chars=20).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(r[0] for r in rows)
    assert all(r["mix_stream"] == r["source"] for r in found)
    weight = {r["mix_stream"]: r["mix_weight"] for r in found}
    assert len(weight) == 302
    total = 299 + 300 + 2 + 1
    for s, w in weight.items():
        assert w == pytest.approx((weights.get(s, 1.0)) / total)
    sizes = {s: 40 * (1 + k % 3) for k, s in enumerate(f"s{k}" for k in range(300))}
    whole = sum(n**0.5 for n in sizes.values())
    own = mixing.mix(documents(spark, rows[:1200])).collect()
    for r in own:
        assert r["mix_weight"] == pytest.approx(sizes[r["source"]] ** 0.5 / whole)


def test_blocks_are_runs_of_measured_text(spark):
    rng = random.Random(14)
    rows = [(k, "x" * rng.randint(1, 400), "en", "a") for k in range(800)]
    rows += [(1000 + k, "y" * 50_000, "en", "long") for k in range(10)]
    rows += [(None if k % 2 else 7, f"{k:06}" * 10, "en", "one id") for k in range(2000)]
    rows += [(9, "z" * 100, "en", "copies")] * 500
    block = 1000
    found = mixing.mix(documents(spark, rows).repartition(5), block_chars=block).collect()
    assert len(found) == len(rows)
    for source in ("a", "long", "one id", "copies"):
        own = sorted((r["mix_order"], r["mix_block"], len(r["text"])) for r in found if r["source"] == source)
        at, blocks = 0, []
        for _, k, n in own:
            blocks.append((k, at // block))
            at += n
        if source != "copies":
            assert all(k == want for k, want in blocks)
        else:
            assert {k for k, _ in blocks} == set(range(50)) and max(map([k for k, _ in blocks].count, range(50))) < 40
    slots = {r["mix_stream"]: {} for r in found}
    for r in found:
        assert r["mix_release"] <= r["mix_slot"] < r["mix_deadline"]
        slots[r["mix_stream"]][r["mix_block"]] = r["mix_slot"]
    every = [s for own in slots.values() for s in own.values()]
    assert len(every) == len(set(every))
