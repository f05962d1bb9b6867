"""Every registered query against DuckDB on the same tables."""

import glob
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from civiclens.plans.catalog import QUERIES
from civiclens.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    picked = [
        tuple(round(v, 9) if isinstance(v, float) and not math.isnan(v) else v for v in row)
        for row in picked
    ]
    return sorted(columns), sorted(picked, key=repr)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert queries().keys() >= QUERIES.keys() and oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(name, spark, duck, folder):
    frame = queries()[name](spark, folder)
    got = comparable(frame.columns, [tuple(row) for row in frame.collect()])
    answer = duck.execute(oracle_sql()[name])
    columns = [column[0] for column in answer.description]
    want = comparable(columns, answer.fetchall())
    assert want[1], "an oracle without rows proves nothing"
    assert got == want
    assert [type(v) for v in got[1][0]] == [type(v) for v in want[1][0]]


def test_entry(spark):
    assert entry(spark).count() == 5
