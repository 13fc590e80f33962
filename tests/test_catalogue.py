"""Every query of the core over the smallest data against its SQL."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from marketloom.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data here")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if value != value else round(value, 8)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(names, data):
    order = [names.index(c) for c in sorted(names)]
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in data)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, tables, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    got = rows(df.columns, df.collect())
    if name in catalogue.ORACLE_SQL:
        cursor = tables.execute(catalogue.ORACLE_SQL[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert got == rows(names, cursor.fetchall())
