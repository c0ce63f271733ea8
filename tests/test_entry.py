"""Driver contract: entry(), queries() and oracle_sql()."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

REPRESENTATIVE = ["label_scan", "day_number_date", "split_item", "coerced_lookup", "us_ports",
                  "airports", "city", "conform", "arrivals_by_city", "arrivals_by_city_joined",
                  "r3", "preview"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("region nation customer supplier part orders lineitem events").split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


def test_every_query_of_the_library_has_an_oracle():
    import catalog
    import oracle
    assert set(catalog.QUERIES) == set(oracle.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_parts_that_are_not_installed_are_left_out(monkeypatch):
    import catalog
    monkeypatch.setattr(entry, "_llm_parts", lambda: False)
    assert entry.queries() == catalog.QUERIES


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "cicid" in df.columns and "i94dt" in df.columns


@pytest.mark.parametrize("name", REPRESENTATIVE)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    res = duck.execute(entry.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(o_cols, res.fetchall())
