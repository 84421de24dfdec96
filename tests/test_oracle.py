"""Every registered query against its DuckDB equivalent, on whole tables."""

import pytest

import __spark_entry__ as entry
from chronofold.plans.catalog import QUERIES
from chronofold.plans.oracle import ORACLE_SQL

duckdb = pytest.importorskip("duckdb")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def test_every_query_has_an_equivalent():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert QUERIES.items() <= entry.queries().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    con = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in con.description]
    expected = con.fetchall()
    assert sorted(got.columns) == sorted(columns)
    order = sorted(columns)
    at = [columns.index(c) for c in order]

    def plain(value):
        if value is None or value != value:
            return None
        return str(value.to_pydatetime() if hasattr(value, "to_pydatetime") else value)

    ours = sorted(str([plain(v) for v in row]) for row in got[order].astype(object).itertuples(index=False))
    theirs = sorted(str([plain(row[i]) for i in at]) for row in expected)
    assert ours == theirs


def test_entry(spark):
    assert entry.entry(spark).columns == ["sample_id", "seq", "event_time", "minute", "copy_no"]
