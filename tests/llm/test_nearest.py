import numpy as np
import pytest

from chronofold.llm import nearest

RNG = np.random.default_rng(11)


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<float>, score string")


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, every, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and usable(v)]
    out = []
    for q in sorted({i for i, _ in good if i % every == 0}):
        qv = next(v for i, v in good if i == q)
        found = [(-float(v @ qv / np.sqrt((v @ v) * (qv @ qv))), i) for i, v in good if i != q and len(v) == len(qv)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(found)[:k])]
    return out


def check(spark, rows, every=50, k=5, **options):
    found = sorted(map(tuple, nearest.nearest(table(spark, rows).repartition(3), every, k, **options).collect()))
    want = brute(rows, every, k)
    assert [r[:3] for r in found] == [r[:3] for r in want]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in want], abs=1e-12)


@pytest.mark.parametrize("block", [4096, 40])
def test_against_brute_force(spark, block):
    vectors = RNG.normal(size=(400, 24)).astype(np.float32)
    vectors[50:60] = vectors[7]  # copies
    vectors[60:70] = vectors[7] * 2
    vectors[100:130] = vectors[100] + RNG.normal(size=(30, 24)) * 1e-3
    check(spark, [(i, v.tolist()) for i, v in enumerate(vectors)], every=10, block=block)


def test_awkward_rows(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 0.0]),
            (None, [1.0, 0.0]), (6, [0.5, 0.0]), (7, [0.5, 0.0]), (-50, [-1.0, 0.0]), (100, []), (150, [1.0, 2.0, 3.0]), (8, [1e-30, 1e-30])]
    check(spark, rows)
    check(spark, [(0, [1.0, 0.0])])
    check(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0])])
    assert nearest.nearest(table(spark, [])).count() == 0


def test_bounds_hold():
    a, b = RNG.normal(size=(50, 1500)), RNG.normal(size=(60, 1500)) * 100
    ca, sa, la, ea = nearest.quantise(a)
    cb, sb, _, eb = nearest.quantise(b)
    exact = ca.astype(np.int64) @ cb.astype(np.int64).T
    assert (nearest.int8_products(ca, cb) == exact).all()
    near = exact * sa[:, None] * sb
    true = np.array([nearest.cosines(x, b) for x in a])
    assert (np.abs(near - true) <= ea[:, None] + la[:, None] * eb).all()


def test_very_large_and_small_components(spark):
    rows = [(0, [1e200, 0.0]), (50, [1e-200, 2e-200]), (1, [3.0, 4.0]), (2, [1e-300, 1e-300]), (3, [5e-324, 0.0]), (4, [1.7e308, 1.7e308])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, score string")
    found = {(r["query_id"], r["vec_id"]): r["score"] for r in nearest.nearest(df).collect()}
    half = 0.5**0.5
    assert [found[0, k] for k in (1, 2, 3, 4, 50)] == pytest.approx([0.6, half, 1, half, 0.2**0.5], abs=1e-15)
    assert [found[50, k] for k in (0, 1, 2, 3, 4)] == pytest.approx([0.2**0.5, 11 / 5 * 0.2**0.5, 3 * 0.1**0.5, 0.2**0.5, 3 * 0.1**0.5], abs=1e-15)


def test_the_smallest_of_repeated_queries_answers(spark):
    found = nearest.nearest(table(spark, [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.0, 2.0]), (2, [2.0, 0.1])]).repartition(4)).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(found, key=lambda r: r["rank"])] == [(1, 1), (2, 2)]
