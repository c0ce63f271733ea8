"""C1-C6, D1-D4, E1-E6 on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from wayfare.operators import columns as C
from wayfare.operators import filters as D
from wayfare.operators import joins as E


def test_rename_ignores_absent(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.rename(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]


def test_cast_projection_truncates_and_nulls_overflow(spark):
    df = spark.createDataFrame([(3.7, 5.5e10), (-3.7, 1.0)], "d double, big double")
    out = C.cast_columns(df, [("d", "int", None), ("big", None, None), ("big", "int", "big_int"),
                              ("big", "long", "big_long")]).collect()
    assert [tuple(r) for r in out] == [(3, 5.5e10, None, 55000000000), (-3, 1.0, 1, 1)]


def test_with_period_and_long_copy(spark):
    df = spark.createDataFrame([(1.0,)], "admnum double")
    out = C.with_long_copy(C.with_period(df, "201601"), "admnum", "admnuml")
    assert out.columns == ["admnum", "i94dt", "admnuml"]
    assert tuple(out.first()) == (1.0, "201601", 1)


def test_open_us_airports_three_valued_logic(spark):
    rows = [("US", "small", "ABC"), ("US", "closed", "DEF"), ("US", None, "GHI"),
            ("US", "small", None), ("US", "small", "null"), ("CA", "small", "JKL")]
    df = spark.createDataFrame(rows, "iso_country string, type string, iata_code string")
    assert [r.iata_code for r in D.open_us_airports(df).collect()] == ["ABC"]


def test_equality_and_period_filters(spark):
    df = spark.createDataFrame([("a", "201601"), (None, "201602"), ("a", "201602")],
                               "c string, i94dt string")
    assert D.equals_filter(df, "c", "a").count() == 2
    assert D.period_filter(df, "201602").count() == 2


def test_using_join_key_first_and_fanout(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, l string")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n")], "k int, r string")
    out = E.using_join(left, right, "k")
    assert out.columns == ["k", "l", "r"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", "a"), (1, "x", "b")]


def test_coerced_lookup_numeric_fact_text_dim(spark):
    fact = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 9.0), (4, None)], "id int, i94mode double")
    dim = spark.createDataFrame([("\t1 ", "Air"), ("\t2 ", "Sea"), ("bad", "Bad")],
                                "i94mode string, mode string")
    out = E.coerced_lookup(fact, dim, "i94mode")
    assert out.columns == ["id", "i94mode", "mode"]
    assert sorted((r.id, r.mode) for r in out.collect()) == [(1, "Air"), (2, "Sea")]


def test_named_and_role_lookup(spark):
    fact = spark.createDataFrame([(1, "NY", 236.0, 101.0), (2, None, 236.0, 236.0),
                                  (3, "ZZ", 236.0, 236.0), (4, "NY", 999.0, 236.0)],
                                 "id int, addr string, res double, cit double")
    states = spark.createDataFrame([("NY", "NEW YORK")], "state_code string, state_name string")
    country = spark.createDataFrame([("236", "AFGHANISTAN"), ("101", "ALBANIA")],
                                    "country_code string, country_name string")
    s = E.named_lookup(fact, states, "addr", "state_code", keep_dim_key=True)
    assert sorted(r.id for r in s.collect()) == [1, 4]
    r = E.role_lookup(s, country, "res", "country_code", {"country_name": "residence_country"})
    r = E.role_lookup(r, country, "cit", "country_code", {"country_name": "birth_country"})
    assert "res" not in r.columns and "cit" not in r.columns
    assert [(x.id, x.residence_country, x.birth_country) for x in r.collect()] == [
        (1, "AFGHANISTAN", "ALBANIA")]


def test_replace_side_columns_keeps_left_state(spark):
    events = spark.createDataFrame([("NYC", "AK", "ALASKA")],
                                   "airport_code string, state_code string, state_name string")
    ports = spark.createDataFrame([("NYC", "NY", "NEW YORK", "new york")],
                                  "airport_code string, state_code string, state_name string, city string")
    out = E.replace_side_columns(events, ports, "airport_code", ["state_code", "state_name"])
    assert [tuple(r) for r in out.collect()] == [("NYC", "AK", "ALASKA", "new york")]


def test_multi_key_join(spark):
    a = spark.createDataFrame([("x", "NY", "N", 1), ("x", "AK", "A", 2)],
                              "city string, state_code string, state_name string, v int")
    b = spark.createDataFrame([("x", "NY", "N", "p")],
                              "city string, state_code string, state_name string, w string")
    out = E.multi_key_join(a, b, ["city", "state_code", "state_name"])
    assert [tuple(r) for r in out.collect()] == [("x", "NY", "N", 1, "p")]


def test_stored_lookups_are_broadcast_by_their_size(spark, tmp_path):
    spark.range(10).selectExpr("cast(id as string) k", "id v").write.parquet(str(tmp_path / "dim"))
    spark.range(1000).selectExpr("cast(id as double) k").write.parquet(str(tmp_path / "fact"))
    fact, dim = (spark.read.parquet(str(tmp_path / n)) for n in ("fact", "dim"))
    joined = E.coerced_lookup(fact, dim, "k")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 10


def test_lookup_rejects_duplicate_columns(spark):
    fact = spark.createDataFrame([(1.0, "x")], "k double, mode string")
    dim = spark.createDataFrame([("1", "Air")], "k string, mode string")
    with pytest.raises(ValueError):
        E.coerced_lookup(fact, dim, "k")


def test_airport_coordinate_order(spark):
    from wayfare.plans.dims import build_airports
    raw = spark.createDataFrame(
        [("K1", "small", "A", "US", "ABC", "1.5, 2.5")],
        "ident string, type string, name string, iso_country string, iata_code string, coordinates string"
    ).withColumns({"gps_code": F.lit("g"), "local_code": F.lit("l")})
    ports = spark.createDataFrame([("NY", "ABC", "\tX", "N")],
                                  "state_code string, port_code string, city string, state_name string")
    a = build_airports(raw, ports).first()
    b = build_airports(raw, ports, coord_order="lon_lat").first()
    assert (a.latitude, a.longitude) == (1.5, 2.5) and (b.latitude, b.longitude) == (2.5, 1.5)
    assert a.city == "x"
