"""Every query of the library against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from ordlog.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the tables are not here")


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_its_sql(spark, sql, name):
    got = contract.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    want = sql.execute(contract.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    wanted = sorted((tuple(row[i] for i in at) for row in want.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == wanted


def test_entry(spark):
    report = contract.entry(spark).collect()
    assert [r.verdict for r in report] == ["PASS"] * 3
