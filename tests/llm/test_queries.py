"""Every query of the subpackage against its SQL, and what the contract says of the others."""

import pytest

import __spark_entry__ as contract
from ordlog.llm import queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality": "doc_id evidence host_posterior path_posterior score keep",
    "op2_language_id": "doc_id held_out lang_pred score",
    "op4_toxicity": "doc_id held_out score predicted",
    "op7_token_files": "doc_id start n_tokens ids_crc32",
}


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_its_sql(spark, sql, name):
    got = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    want = sql.execute(queries.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    wanted = sorted((tuple(row[i] for i in at) for row in want.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == wanted


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_for_each_document(spark, name):
    got = queries.QUERIES[name](spark, FOLDER)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert got.columns == COLUMNS[name].split()
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in documents.collect())


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries())
    assert set(queries.SQL) <= set(contract.oracle_sql())
