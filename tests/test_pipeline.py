"""End-to-end monthly runs on hand-typed sources."""

import pytest
from pyspark.sql import functions as F

from tests.fixtures import (AIRPORTS_CSV, ARRIVAL_ROWS, COUNTRY_LINES, DEMOGRAPHICS_CSV,
                            MODE_LINES, PORT_LINES, STATE_LINES, VISA_LINES, WEATHER_CSV,
                            arrivals_df, write_text)
from wayfare.config import Layout, Options
from wayfare.periods import Period
from wayfare.plans import pipeline, quality
from wayfare.schemas import STORED
from wayfare.sources.tables import read_period, read_table


def stage(spark, root):
    layout = Layout(raw_root=f"{root}/raw", processed_root=f"{root}/processed")
    for table, lines in [("us_state", STATE_LINES), ("country", COUNTRY_LINES),
                         ("us_ports", PORT_LINES), ("i94mode", MODE_LINES),
                         ("i94visa", VISA_LINES)]:
        write_text(layout.label_path(table), lines)
    write_text(layout.raw(layout.weather_file), WEATHER_CSV.strip().splitlines())
    write_text(layout.raw(layout.airports_file), AIRPORTS_CSV.strip().splitlines())
    write_text(layout.raw(layout.demographics_file), DEMOGRAPHICS_CSV.strip().splitlines())
    for month in (1, 2):
        rows = [r for r in ARRIVAL_ROWS if r[2] == float(month)]
        arrivals_df(spark, rows).write.parquet(layout.arrivals_path(Period(2016, month)))
    return layout


@pytest.fixture(scope="module")
def run(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="wayfare-e2e-")
    layout = stage(spark, root)
    checks = pipeline.backfill(spark, layout, "2016-01", "2016-02")
    return layout, checks


def table(spark, layout, name):
    return read_table(spark, layout.table(name), name)


def test_code_and_dimension_tables(spark, run):
    layout, _ = run
    assert table(spark, layout, "us_state").count() == 4
    assert table(spark, layout, "country").count() == len(COUNTRY_LINES)
    assert sorted(r.port_code for r in table(spark, layout, "us_ports").collect()) == [
        "ALC", "CP", "KE", "NYC"]
    airports = table(spark, layout, "airports")
    assert sorted(r.ident for r in airports.collect()) == ["K1", "K10", "K6", "K7", "K8"]
    k8 = airports.filter(F.col("ident") == "K8").first()
    assert (k8.latitude, k8.longitude, k8.city) == (-131.7, None, "ketchikan")
    assert airports.filter(F.col("ident") == "K7").first().latitude is None
    city = table(spark, layout, "city")
    assert city.filter(F.col("city") == "new york").count() == 2  # one row per race
    assert city.count() == 4


def test_weather(spark, run):
    layout, _ = run
    w = table(spark, layout, "weather")
    assert w.count() == 5
    old = w.filter(F.col("date") == "1743-11-01").first()
    assert (old.Year, old.Month, old.DayOfMonth, old.city) == (1743, 11, 1, "New york")
    bad = w.filter(F.col("date") == "not-a-date").first()
    assert (bad.Year, bad.Month) == (None, None)
    assert w.filter(F.col("city").isNull()).count() == 1


def test_facts(spark, run):
    layout, _ = run
    imm = table(spark, layout, "immigration")
    assert sorted(r.cicid for r in imm.collect()) == [1, 2, 3, 4, 11, 21, 22]
    r1 = imm.filter(F.col("cicid") == 1).first()
    assert (r1.arrival_date, r1.departure_date, r1.state_code, r1.i94dt) == (
        "2016-01-01", "2016-01-07", "NY", "201601")
    assert r1.admnuml == 55000000000 and r1.admnum == 5.5e10
    dep = {r.cicid: r.departure_date for r in imm.collect()}
    assert dep[2] is None and dep[3] is None and dep[4] == "2016-01-07"
    people = {r.cicid: r for r in table(spark, layout, "immigrant").collect()}
    assert (people[1].residence_country, people[1].birth_country) == ("ALBANIA", "AFGHANISTAN")
    assert (people[3].residence_country, people[3].birth_country) == ("INVALID", "INVALID")
    assert people[3].age == 25 and people[1].birth_year == 1986


def test_mart_multiplicities(spark, run):
    layout, _ = run
    mart = table(spark, layout, "immigration_demographics")
    by_period = {r.i94dt: r["count"] for r in mart.groupBy("i94dt").count().collect()}
    assert by_period == {"201601": 10, "201602": 4}
    assert mart.filter(F.col("cicid") == 1).count() == 4   # 2 airports x 2 city rows
    assert mart.filter(F.col("cicid") == 11).count() == 0  # port without airport
    assert mart.filter(F.col("cicid") == 22).count() == 0  # airport without demographics
    assert {r.state_code for r in mart.filter(F.col("cicid") == 3).collect()} == {"AK"}


def test_stored_schemas(spark, run):
    layout, _ = run
    for name, schema in STORED.items():
        stored = spark.read.parquet(layout.table(name))
        assert stored.columns == schema.names, name
        for f in schema.fields:
            if f.name not in ("i94dt", "Month"):
                assert stored.schema[f.name].dataType == f.dataType, (name, f.name)


def test_checks_and_rerun_idempotent(spark, run):
    layout, checks = run
    counts = {(r.table, r.i94dt): r.rows for r in checks.collect()}
    assert counts == {("immigration", "201601"): 5, ("immigration", "201602"): 2,
                      ("immigrant", "201601"): 5, ("immigrant", "201602"): 2}
    pipeline.run_month(spark, layout, "2016-02", refresh_reference=False)
    assert table(spark, layout, "immigration").count() == 7
    assert table(spark, layout, "immigration_demographics").count() == 14


def test_missing_period_raises(spark, run):
    layout, _ = run
    with pytest.raises(quality.DataQualityError):
        pipeline.check_periods(spark, layout, [Period(2016, 3)])
    with pytest.raises(quality.DataQualityError):
        quality.check_nonempty(spark, layout.table("immigration"), "immigration", "201603")
    quality.check_nonempty(spark, layout.table("immigration"), "immigration", "201601")


def test_publication_check_reports_missing_marker(spark, run, tmp_root):
    layout, _ = run
    tables = {"immigration": layout.table("immigration"), "nothing": f"{tmp_root}/none"}
    with pytest.raises(quality.DataQualityError):
        quality.publication_check(spark, tables)
    out = {r["table"]: (r["has_marker"], r["rows"] > 0)
           for r in quality.publication_check(spark, tables, raise_on_fail=False).collect()}
    assert out == {"immigration": (True, True), "nothing": (False, False)}


def test_append_mode_duplicates(spark, tmp_root):
    layout = stage(spark, tmp_root)
    opts = Options(write_mode="append")
    pipeline.backfill(spark, layout, "2016-01", "2016-01", opts)
    pipeline.run_month(spark, layout, "2016-01", opts, refresh_reference=False)
    assert table(spark, layout, "immigration").count() == 10


def test_period_read_is_pruned(spark, run):
    layout, _ = run
    df = read_period(spark, layout.table("immigration"), "201602", "immigration")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "i94dt" in plan
    assert df.count() == 2


def test_lookups_are_broadcast_and_udf_free(spark, run):
    layout, _ = run
    from wayfare.plans import facts
    codes = {n: read_table(spark, layout.table(n), n) for n in pipeline.CODE_TABLES}
    arr = pipeline.arrivals_for_periods(spark, layout, [Period(2016, 1)])
    conf = facts.conform_arrivals(arr, codes["i94mode"], codes["i94visa"], codes["us_state"],
                                  codes["country"])
    plan = conf._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 5
    assert "SortMergeJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_command_line_run(spark, tmp_root, capsys):
    from wayfare.__main__ import main
    layout = stage(spark, tmp_root)
    assert main(["run-month", "--raw", layout.raw_root, "--processed", layout.processed_root,
                 "--period", "2016-02"]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert out == ["immigrant\t201602\t2", "immigration\t201602\t2"]
    assert main(["check", "--raw", layout.raw_root, "--processed", layout.processed_root,
                 "--start", "2016-02"]) == 0


def test_read_arrivals_by_template(spark, run):
    from wayfare.sources.arrivals import read_arrivals
    layout, _ = run
    assert read_arrivals(spark, layout, Period(2016, 1)).count() == 11
    assert read_arrivals(spark, layout, Period(2016, 2)).count() == 2


def test_salted_period_write_spreads_one_hot_month(spark, tmp_root):
    from pyspark.sql import functions as F
    from wayfare.sinks.parquet import write_period
    # one month holds every row and one visa class almost all of them
    df = spark.range(4000).select(F.col("id").cast("int").alias("cicid"),
                                  F.lit("201601").alias("i94dt"),
                                  F.when(F.col("id") % 100 == 0, "Student").otherwise("Pleasure").alias("visa"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the case the salt is for
    try:
        write_period(df.coalesce(1), f"{tmp_root}/salted", spread="visa", salt_buckets=8)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    back = read_table(spark, f"{tmp_root}/salted")
    assert back.count() == 4000 and back.columns == ["cicid", "visa", "i94dt"]
    # the hot (month, visa) group alone is written by several tasks
    per_file = (back.filter(F.col("visa") == "Pleasure")
                .groupBy(F.input_file_name()).count().collect())
    assert len(per_file) > 1 and max(r["count"] for r in per_file) < 3960


def test_distinct_city_option(spark, run):
    from wayfare.plans.dims import build_city
    from wayfare.sources.csv import read_demographics
    layout, _ = run
    raw = read_demographics(spark, layout.raw(layout.demographics_file))
    states = table(spark, layout, "us_state")
    assert build_city(raw, states).count() == 4
    assert build_city(raw, states, distinct=True).count() == 3


def test_csv_month_files(spark, tmp_root):
    from dataclasses import replace
    from wayfare.plans import pipeline as pl
    parquet_layout = stage(spark, f"{tmp_root}/p")
    layout = replace(parquet_layout, arrivals_template="arrivals_csv/i94_{token}_sub.csv",
                     arrivals_format="csv")
    for month in (1, 2):
        rows = [r for r in ARRIVAL_ROWS if r[2] == float(month)]
        (arrivals_df(spark, rows).write.option("header", "true")
         .csv(layout.arrivals_path(Period(2016, month))))
    checks = pl.backfill(spark, layout, "2016-01", "2016-02")
    counts = {(r.table, r.i94dt): r.rows for r in checks.collect()}
    assert counts[("immigration", "201601")] == 5 and counts[("immigrant", "201602")] == 2


def test_mart_can_be_gated(spark, run):
    layout, _ = run
    out = pipeline.check_periods(spark, layout, [Period(2016, 1), Period(2016, 2)],
                                 ("immigration", "immigrant", "immigration_demographics"))
    counts = {(r.table, r.i94dt): r.rows for r in out.collect()}
    assert counts[("immigration_demographics", "201601")] == 10


def test_full_refresh_replaces_every_partition(spark, tmp_root):
    from pyspark.sql import functions as F
    from wayfare.sinks.parquet import write_full
    df = spark.range(24).select((F.col("id") % 12 + 1).cast("int").alias("Month"), F.col("id"))
    path = f"{tmp_root}/w"
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
    write_full(df, path, partition_by="Month")
    write_full(df.filter(F.col("Month") == 1), path, partition_by="Month")
    back = spark.read.parquet(path)
    assert back.count() == 2 and {str(r.Month) for r in back.collect()} == {"1"}


def test_reports_on_the_mart(spark, run):
    from wayfare.plans import reports
    layout, _ = run
    mart = table(spark, layout, "immigration_demographics")
    r1 = {(r.i94dt, r.residence_country): r.visitors for r in reports.visitors_by_country(mart).collect()}
    assert r1[("201601", "ALBANIA")] == 4 and r1[("201601", "INVALID")] == 1
    r2 = {(r.i94dt, r.city): (r.visitors, r.airports) for r in reports.visitors_by_city(mart).collect()}
    assert r2[("201601", "new york")] == (8, 1)  # two airports share the IATA code NYC
    r3 = {r.city: (r.visitors, r.population, r.median_age)
          for r in reports.city_demographics(mart).collect()}
    assert r3["alcan"] == (1, 120, 40.0)
    r4 = {(r.city, r.Month): (r.avg_temperature, r.readings)
          for r in reports.monthly_temperature(table(spark, layout, "weather")).collect()}
    assert r4[("New york", 11)] == (6.068, 1) and r4[("New york", 1)] == (None, 0)
    r5 = {(r.visa, r.visatype, r.city): (r.travellers, r.avg_age)
          for r in reports.traveller_types(mart).collect()}
    assert r5[("Business", "B1", "new york")] == (8, 30.0)


def test_mart_sources_agree(spark, tmp_root):
    results = {}
    for source in ("conformed", "tables"):
        layout = stage(spark, f"{tmp_root}/{source}")
        pipeline.backfill(spark, layout, "2016-01", "2016-02", Options(mart_source=source))
        mart = table(spark, layout, "immigration_demographics")
        results[source] = sorted(tuple(r) for r in mart.collect())
    assert len(results["conformed"]) == 14
    assert results["conformed"] == results["tables"]


def test_mart_drops_records_whose_cicid_is_not_an_int(spark, tmp_root):
    rows = [r for r in ARRIVAL_ROWS if r[2] == 1.0] + [(3.0e9,) + ARRIVAL_ROWS[0][1:]]
    results = {}
    for source in ("conformed", "tables"):
        layout = stage(spark, f"{tmp_root}/{source}")
        arrivals_df(spark, rows).write.mode("overwrite").parquet(layout.arrivals_path(Period(2016, 1)))
        pipeline.backfill(spark, layout, "2016-01", "2016-01", Options(mart_source=source))
        imm = table(spark, layout, "immigration")
        assert imm.filter(F.col("cicid").isNull()).count() == 1  # kept in the facts
        mart = table(spark, layout, "immigration_demographics")
        results[source] = sorted(tuple(r) for r in mart.collect())
    assert len(results["conformed"]) == 10 and results["conformed"] == results["tables"]


def test_non_strict_gate_reports_gaps(spark, run):
    layout, _ = run
    out = pipeline.check_periods(spark, layout, [Period(2016, 1), Period(2016, 3)], strict=False)
    assert {(r.table, r.i94dt) for r in out.collect()} == {("immigration", "201601"),
                                                          ("immigrant", "201601")}


def test_missing_month_file_is_reported(spark, run):
    layout, _ = run
    with pytest.raises(FileNotFoundError, match="201603"):
        pipeline.arrivals_for_periods(spark, layout, [Period(2016, 2), Period(2016, 3)])


def test_a_rerun_without_kept_rows_clears_its_month(spark, tmp_root):
    from pyspark.sql import functions as F

    from wayfare.sinks.parquet import write_period
    rows = spark.createDataFrame([(1, "201601"), (2, "201602")], "v int, i94dt string")
    path = f"{tmp_root}/periods"
    write_period(rows, path, periods=["201601", "201602"])
    write_period(rows.filter(F.col("i94dt") == "201601"), path, periods=["201601", "201602"])
    assert [tuple(r) for r in spark.read.parquet(path).select("v").collect()] == [(1,)]
    write_period(rows.filter("v > 9"), path, periods=["201601"])
    assert spark.read.schema(rows.schema).parquet(path).count() == 0
