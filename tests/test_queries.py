"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from lexigrove.plans.oracle import ORACLE_SQL
from lexigrove.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    found = QUERIES[name](spark, FOLDER)
    rows = found.collect()
    if name not in ORACLE_SQL:
        assert rows
        return
    asked = sql.execute(ORACLE_SQL[name])
    columns = [c[0] for c in asked.description]
    assert sorted(columns) == sorted(found.columns)
    order = sorted(columns)
    want = sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in asked.fetchall()), key=str)
    got = sorted((tuple(plain(r[c]) for c in order) for r in rows), key=str)
    assert got == want


def test_oracles_have_queries():
    assert set(ORACLE_SQL) <= set(QUERIES)
