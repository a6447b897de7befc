"""Every query against its SQL on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(data):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{data}/{table}.parquet')")
    return db


def row_texts(rows):
    return sorted(repr(tuple(round(x, 9) if isinstance(x, float) else x for x in row)) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, data, name):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    result = duck.execute(SQL[name])
    kinds = {c[0]: str(c[1]) for c in result.description}
    wanted = result.fetchall()
    order = [list(kinds).index(c) for c in columns]
    assert sorted(kinds) == columns
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == kinds
    assert row_texts(df.select(*columns).collect()) == row_texts([tuple(r[i] for i in order) for r in wanted])


def test_all_queries_have_sql():
    """Those of the optional subpackage without SQL have tests of their own."""
    assert set(QUERIES) - set(entry.LLM_QUERIES) == set(SQL) - set(entry.LLM_ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
