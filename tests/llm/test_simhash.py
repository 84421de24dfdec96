import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chronofold.llm import graph, simhash
from tests.llm.cases import ROWS, WORDS, documents, empty


def by_hand(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(items, linked):
    """Smallest member reachable, by brute force."""
    parent = list(range(len(items)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(items)), 2):
        if linked(items[a], items[b]):
            parent[root(b)] = root(a)
    return [root(x) for x in range(len(items))]


def test_fingerprint():
    rng = random.Random(3)
    texts = [t for _, t, *_ in ROWS if t is None or len(t) < 1000]
    texts += [" ".join(rng.choices([*WORDS, "É", " x", "A B"], k=rng.randint(0, 40))) for _ in range(100)]
    for text in texts:
        assert simhash.fingerprint(text or "") == by_hand(text)


def test_spark_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("the red house by")).alias("h")).first()
    assert row["h"] % 2**64 == xxhash.xxh64_intdigest(b"the red house by", 42)


def test_tiles_connect_what_lies_within_the_radius(monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 2**63, 60, dtype=np.uint64)
    near = np.array([s ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 6)))) for s in seeds.repeat(5)])
    every = np.unique(near)
    rng.shuffle(every)
    want = classes(every.tolist(), lambda a, b: (a ^ b).bit_count() <= 4)
    half = len(every) // 2
    a, b = every[:half], every[half:]
    links = [simhash.tile_links(a, None), simhash.tile_links(b, None), simhash.tile_links(a, b)]
    pairs = {(int(x), int(y)) for one in links for x, y in zip(*one, strict=True)}
    assert all((x ^ y).bit_count() <= 4 for x, y in pairs)
    assert len(pairs) < 3 * len(every)
    got = classes(every.tolist(), lambda a, b: (a, b) in pairs or (b, a) in pairs)
    same = lambda roots: {tuple(k for k, r in enumerate(roots) if r == q) for q in roots}
    assert same(got) == same(want)


@pytest.mark.parametrize("block", [simhash.BLOCK, 7])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(simhash.fingerprint_links, "__defaults__", (simhash.RADIUS, block))
    rng = random.Random(6)
    rows = list(ROWS)
    for k in range(12):
        words = rng.choices(WORDS, k=400)
        for j in range(4):
            words[rng.randrange(400)] = "new"
            rows.append((1000 - 10 * k + j, " ".join(words), "en", "d"))
    found = simhash.near_duplicates(documents(spark, rows, clashes=True)).collect()
    prints = [(by_hand(t), i) for i, t, *_ in rows]
    roots = classes(prints, lambda a, b: (a[0] ^ b[0]).bit_count() <= 4)
    least = {}
    for (_, i), r in zip(prints, roots, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = [(i, f"{p:016x}", least.get(r)) for (p, i), r in zip(prints, roots, strict=True)]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_components(spark):
    rng = random.Random(7)
    links = [(k, k + 1) for k in range(0, 300)] + [(1000, 1000 + k) for k in range(1, 400)]
    links += [(rng.randint(2000, 2300), rng.randint(2000, 2300)) for _ in range(150)] + [(5, 5)]
    found = graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    root = dict(map(tuple, found))
    assert sorted(root) == nodes and len(found) == len(nodes)
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            parent[top(a)] = top(b)
    pairs = {(top(n), root[n]) for n in nodes}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_of_each_group_stays(spark):
    rng = random.Random(8)
    base = [" ".join(rng.choices(WORDS, k=200)) for _ in range(6)]
    rows = [(100 * g + k, text if k == 0 else f"{text} {k}", "en", "a") for g, text in enumerate(base) for k in range(5)]
    docs = documents(spark, rows, clashes=True)
    prints = [by_hand(t) for _, t, *_ in rows]
    roots = classes(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    want = {min(i for (i, *_), q in zip(rows, roots, strict=True) if q == root) for root in set(roots)}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == want and len(want) < len(rows)


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.one_of_each(empty(spark)).count() == 0
