"""Registered queries of the operators against their SQL, on the smallest test tables."""

import math
import os

import duckdb
import pytest

from wayfare.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, want.fetchall())


def test_queries_without_sql_return_a_row_for_each_document(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op4_histogram_shards", "op8_token_counts"):
        assert QUERIES[name](spark, SF).count() == documents
    pieces = QUERIES["op5_packing"](spark, SF).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert len(pieces) == documents and all(r["sum(length)"] == r["max(doc_tokens)"] for r in pieces)
