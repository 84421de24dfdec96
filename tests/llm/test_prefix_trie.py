import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from chronofold.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, node string, pos int")


def toward_zero(c):
    return c - (c % 100 if c >= 0 else -(-c % 100))


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(toward_zero(c), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, inside in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(inside) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, inside in members.items():
        ends = ",".join(str(c) for c in sorted(inside) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(inside), len(node), parent, len(inside), children.get(node, 0), leaves[node], saved[node], digest))
    return out


def check(spark, rows):
    found = prefix_trie.prefix_trie(table(spark, rows).repartition(3))
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute(rows), key=str)


def random_rows(rng, convs, longest, texts):
    return [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(texts)) for c in convs for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("longest", [1, 2, 7, 40])
def test_against_brute_force(spark, monkeypatch, longest):
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", 2)
    monkeypatch.setattr(prefix_trie, "RUN", 3)
    rng = random.Random(longest)
    rows = random_rows(rng, [*range(30), *range(200, 230), 350, 351], longest, ["a", "", "bcd"])
    same = [(t, "user", "long one %d" % (t // 5)) for t in range(longest)]
    rows += [(c, *s) for c in range(400, 460) for s in same]  # copies that share all their prefixes
    rng.shuffle(rows)
    check(spark, rows)


def test_awkward_rows(spark):
    rows = [(5, None, "user", "first"), (5, 0, None, "second"), (5, 0, "user", None), (5, 0, "user", None), (5, 1, "", ""),
            (None, 0, "user", "nobody's"), (-105, 0, "user", "x"), (-100, 3, "user", "y"), (-100, 2, "user", "z"), (7, 0, "a:b", "c"), (8, 0, "a", "b:c"),
            (100, 0, "user", "é漢"), (2**62, 0, "user", "x" * 50_000), (2**62 + 1, 0, "user", "x" * 50_000), (101, 9, "user", "only")]
    check(spark, rows)
    check(spark, rows[:1])
    check(spark, [(101, 0, "user", "gone")])  # no rebuilt turn: the root alone
    assert prefix_trie.prefix_trie(table(spark, [])).count() == 0
    assert prefix_trie.prefix_trie(table(spark, [(None, 0, "user", "x")])).count() == 0


def test_one_conversation_in_many_ranges(spark):
    """Places are counted across the ranges that a long conversation is sorted into."""
    rows = [(0, t, "user", str(t % 7)) for t in range(3000)] + [(200, t, "user", str(t % 7)) for t in range(0, 3000, 3)]
    turns = prefix_trie.ordered_turns(table(spark, rows).repartition(8))
    found = turns.select("conv_id", "pos").collect()
    assert sorted(map(tuple, found)) == [(0, p + 1) for p in range(3000)] + [(200, p + 1) for p in range(1000)]
