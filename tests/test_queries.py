"""Every query against its SQL over the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from millrace.plans.queries import ORACLE_SQL, QUERIES

TABLES = "events documents embeddings pages benchmark labels conversations orders lineitem".split()


def rows_of(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(plain(t[i]) for i in order) for t in tuples), key=repr)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    result = duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
