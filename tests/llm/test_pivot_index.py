import numpy as np

from chronofold.llm import pivot_index
from tests.llm.test_simhash import classes

RNG = np.random.default_rng(23)


def table(spark, rows):
    schema = "vec_id bigint, embedding array<float>, label int, node string, n string, copies string"
    return spark.createDataFrame([(i, v, label, "x", "y", "z") for i, v, label in rows], schema)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def linked(a, b, least=0.98):
    (_, v, x), (_, w, y) = a, b
    if x is None or x != y or not usable(v) or not usable(w) or len(v) != len(w):
        return False
    v, w = (np.array(u, np.float32).astype(float) for u in (v, w))
    v, w = v / abs(v).max(), w / abs(w).max()
    return v @ w / np.sqrt((v @ v) * (w @ w)) >= least


def brute(rows):
    roots = classes(rows, linked)
    least = {}
    for (i, *_), r in zip(rows, roots, strict=True):
        least[r] = min((k for k in (least.get(r), i) if k is not None), default=None)
    n = [sum(linked(a, b) for k, b in enumerate(rows) if k != j) for j, a in enumerate(rows)]
    return [(i, c, least[r], least[r] == i) for (i, *_), c, r in zip(rows, n, roots, strict=True)]


def check(spark, rows, **options):
    found = pivot_index.near_copies(table(spark, rows).repartition(3), **options).collect()
    assert sorted(map(tuple, found), key=str) == sorted(brute(rows), key=str)


def groups(n, copies, noise, dimensions=64):
    vectors = RNG.normal(size=(n, dimensions))
    vectors = vectors.repeat(copies, 0) + RNG.normal(size=(n * copies, dimensions)) * noise
    return vectors.astype(np.float32)


def test_against_brute_force(spark):
    vectors = np.concatenate([groups(40, 4, 0.06), groups(1, 60, 0.07), groups(60, 1, 0)])
    vectors[5:15] = vectors[3]  # copies
    vectors[20] = vectors[3] * 2
    rows = [(i, v.tolist(), i % 3 if i > 100 else 0) for i, v in enumerate(vectors)]
    rows.append(rows[7])
    assert sum(n for _, n, *_ in brute(rows)) > 500
    check(spark, rows)
    check(spark, rows, block=20)  # lists in pieces


def test_awkward_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.01], 1), (2, [1.0, 0.0], 2), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1),
            (6, [None, 1.0], 1), (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1),
            (None, [2.0, 0.0], 1), (None, [0.0, 1.0], 3), (11, [1e-38, 0.0], 1), (12, [3e38, 0.0], 1), (13, [-1.0, 0.0], 1),
            (0, [0.0, 1.0], 1), (0, [1.0, 0.0], 1), (14, [5.0], 1), (15, [2.0], 1)]
    check(spark, rows)
    check(spark, rows[:1])
    check(spark, rows[3:6])
    assert pivot_index.near_copies(table(spark, [])).collect() == []


def test_nearly_all_pairs_at_the_threshold_are_found(spark):
    """Pairs of cosine 0.98 to 0.981 among other vectors, of which the index must see nine in ten."""
    n = 600
    a, other = pivot_index.units(RNG.normal(size=(2, n, 64)).reshape(-1, 64)).reshape(2, n, 64)
    other = pivot_index.units(other - (other * a).sum(1)[:, None] * a)
    b = 0.9805 * a + np.sqrt(1 - 0.9805**2) * other
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([a, b, RNG.normal(size=(2000, 64))]))]
    found = pivot_index.near_copies(table(spark, rows)).where("n_links > 0").collect()
    assert {r["component_id"] for r in found} <= set(range(n))
    assert len(found) / (2 * n) >= 0.97


def test_no_pivot_is_near_another():
    sample = pivot_index.units(np.concatenate([groups(1, 300, 0.05), groups(300, 1, 0)]).astype(float))
    pivots = pivot_index.separated(sample, 128, 64)
    near = pivots @ pivots.T - np.eye(len(pivots))
    assert len(pivots) == 128 and near.max() <= pivot_index.SEPARATION
    assert len(pivot_index.separated(sample[:10], 128, 64)) == pivot_index.FEWEST_PIVOTS


def test_shared_pivots():
    a = np.sort(RNG.permuted(np.tile(np.arange(20), (30, 1)), axis=1)[:, :8]).astype(np.int16)
    count, before = pivot_index.shared_pivots(a, a, 6)
    for i, x in enumerate(a):
        for j, y in enumerate(a):
            both = set(x.tolist()) & set(y.tolist())
            assert count[i, j] == len(both) and before[i, j] == any(p < 6 for p in both)


def test_recall_on_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    # The small tables hold no near copies: plant some.
    rng = np.random.default_rng(5)
    rows += [(10_000 + i, (np.array(v) + rng.normal(size=len(v)) * 0.012).tolist(), label) for i, v, label in rows[:150]]
    check(spark, rows)
