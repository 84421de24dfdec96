import random
from collections import Counter

import pytest

from chronofold.operators import profile


def exact(values, n):
    counts = Counter(v for v in values if v is not None)
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n]


@pytest.mark.parametrize("kind", ["skewed", "flat", "few", "ties", "none"])
def test_top_frequent(spark, monkeypatch, kind):
    rng = random.Random(kind)
    values = {
        "skewed": [f"v{int(rng.paretovariate(0.9))}" for _ in range(30_000)],
        "flat": [f"v{k}" for k in range(5_000)] * 2,
        "few": ["a", "b", "b", None, "c"],
        "ties": [f"v{k % 40}" for k in range(4_000)] + [f"w{k}" for k in range(3_000)],
        "none": [None, None],
    }[kind]
    recounted = []
    whole = profile.value_counts
    monkeypatch.setattr(profile, "value_counts", lambda df, *c: recounted.append(df) or whole(df, *c))
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    found = profile.top_frequent(df, "v", n=10, tracked=2_000)
    assert [tuple(r) for r in found.collect()] == exact(values, 10)
    # Where some values stand out, nothing but the candidates is counted.
    proven = "LeftSemi" in recounted[-1]._jdf.queryExecution().optimizedPlan().toString()
    assert proven == (kind in ("skewed", "ties"))
