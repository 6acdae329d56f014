"""Registered queries without the language-model subpackage, against their SQL on a small size."""

import duckdb
import pytest

from acreage.plans import mart_queries, oracle, queries

QUERIES, ORACLE_SQL = queries.QUERIES | mart_queries.QUERIES, oracle.ORACLE_SQL | mart_queries.ORACLE_SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events pages".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(value):
    return value + 0.0 if isinstance(value, float) else value if isinstance(value, (int, bool, type(None))) else str(value)


def same(x, y):
    return x == y or isinstance(x, float) and isinstance(y, (float, int)) and abs(x - y) <= 1e-6 * max(abs(x), abs(y))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, db, name):
    """Equal rows; floats within a millionth of each other."""
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    said = db.sql(ORACLE_SQL[name])
    assert sorted(said.columns) == columns
    key = lambda rows: sorted(rows, key=lambda r: tuple((isinstance(v, float), v is None, str(v) if not isinstance(v, float) else f"{v:.3g}") for v in r))
    a = key(tuple(plain(r[c]) for c in columns) for r in got.collect())
    b = key(tuple(plain(r[said.columns.index(c)]) for c in columns) for r in said.fetchall())
    assert len(a) == len(b)
    assert [(x, y) for x, y in zip(a, b, strict=True) if not all(map(same, x, y))] == []
