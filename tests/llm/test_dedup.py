import hashlib
import re

import pytest

from chronofold.llm import exact_dedup
from tests.llm.cases import ROWS, documents, empty


def brute(rows):
    key = lambda t: re.sub(r"[\x20\x09-\x0d]+", "", t or "")
    out = []
    for i, t, *_ in rows:
        group = [(-len(u or ""), j is None, j or 0, j) for j, u, *_ in rows if key(u) == key(t)]
        best = min(group, key=lambda g: g[:3])
        kept = i == best[3] and -len(t or "") == best[0]
        out.append((i, best[3], len(group), kept, hashlib.sha256(key(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [None, 64])
def test_groups(spark, monkeypatch, bits):
    if bits:  # a full filter: every row looks repeated
        monkeypatch.setattr(exact_dedup, "filter_bits", lambda rows: bits)
    found = exact_dedup.duplicate_groups(documents(spark, clashes=True).repartition(4))
    assert sorted(map(tuple, found.collect()), key=str) == brute(ROWS)


def test_filter_finds_all_repeated_and_few_others(spark):
    rows = spark.range(20_000).selectExpr("cast(cast(if(id < 500, id % 100, id) as string) as binary) as digest")
    bits = exact_dedup.filter_bits(20_000)
    flagged = exact_dedup.flag_repeated(rows, "digest", exact_dedup.repeated_slots(rows, "digest", bits), bits)
    assert flagged.count() == 20_000
    again = flagged.where("maybe").selectExpr("cast(cast(digest as string) as int) as k").collect()
    assert sum(r["k"] < 100 for r in again) == 500
    assert len(again) < 500 + 600


def test_one_whole_row_of_each_group_stays(spark):
    docs = documents(spark, clashes=True)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    keys = [re.sub(r"[\x20\x09-\x0d]+", "", r["text"] or "") for r in kept.collect()]
    assert len(keys) == len(set(keys)) == len({re.sub(r"[\x20\x09-\x0d]+", "", t or "") for _, t, *_ in ROWS})
    ids = {r["doc_id"] for r in kept.collect()}
    assert {0, 4, 5, 6, 8} <= ids and 100 not in ids and 3 not in ids


def test_empty_table(spark):
    assert exact_dedup.duplicate_groups(empty(spark)).count() == 0
    assert exact_dedup.drop_duplicates(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = exact_dedup.duplicate_groups(documents(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
