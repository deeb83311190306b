"""Every registered query runs at the smallest scale and agrees with its SQL."""
import duckdb
import pytest

import __spark_entry__ as entry
from formsieve.plans.registry import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def cell(v):
    return None if v is None or v != v else repr(v) if isinstance(v, float) else str(v)


def canonical(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(([cell(r[i]) for i in order] for r in rows), key=lambda r: [(x is None, x or "") for x in r])


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    if name in entry.oracle_sql():
        cursor = duck.execute(entry.oracle_sql()[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert canonical(rows, df.columns) == canonical(cursor.fetchall(), columns)


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0
