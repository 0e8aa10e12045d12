"""Every registered query against its SQL twin, on the smallest data folder."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from walletscope.catalog import QUERIES  # noqa: E402
from walletscope.sql_twins import TWINS  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "customer orders supplier events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)
    assert set(QUERIES) <= set(queries()) and set(TWINS) <= set(oracle_sql())


def test_entry_finds_the_known_number_of_alerts(spark):
    assert entry(spark).count() == 111


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_twin(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = duck.execute(TWINS[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(repr(tuple(row[i] for i in order)) for row in cursor.fetchall())
    assert sorted(repr(tuple(row[c] for c in columns)) for row in df.collect()) == expected
