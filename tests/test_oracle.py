"""Every query with a SQL counterpart gives the rows DuckDB gives."""

import glob
import os

import duckdb
import pytest

from sipnote.checks.oracle import ORACLE
from sipnote.checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if type(v).__name__ == "Decimal":
            v = float(v)
        return round(v, 6) if isinstance(v, float) else v

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.columns, [tuple(r) for r in df.collect()]) == comparable(columns, cursor.fetchall())
