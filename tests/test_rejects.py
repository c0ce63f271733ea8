"""Rejected records: what is dropped is kept with its reason, and nothing is lost or counted twice."""

from collections import Counter

from pyspark.sql import functions as F

from tests.fixtures import ARRIVAL_ROWS, arrivals_df
from tests.test_pipeline import stage, table
from wayfare.config import Options
from wayfare.periods import Period
from wayfare.plans import facts, pipeline, quality, rejects
from wayfare.sources.tables import read_table

import pytest

CODES = {
    "modes": (["1", " 2 ", "x"], ["Air", "Sea", "Odd"]),
    "visas": (["1", "2", "3"], ["Business", "Pleasure", "Student"]),
    "states": (["NY", "AK", ""], ["NEW YORK", "ALASKA", "OTHER"]),
    "countries": (["236", "101", "135", "438", "103", "0", "730"], ["A", "B", "C", "D", "INVALID", "INVALID", "INVALID"]),
}
COLUMNS = {"modes": ("i94mode", "mode"), "visas": ("i94visa", "visa"), "states": ("state_code", "state_name"),
           "countries": ("country_code", "country_name")}


def codes(spark, more=None):
    out = {}
    for name, (keys, labels) in CODES.items():
        rows = list(zip(keys, labels)) + (more or {}).get(name, [])
        out[name] = spark.createDataFrame(rows, f"{COLUMNS[name][0]} string, {COLUMNS[name][1]} string")
    return out


def plain_reason(row, modes, visas, states, countries):
    def number(keys):
        return {float(k) for k in keys if k.strip().replace(".", "").isdigit()}

    mode, addr, res, cit, visa = row[7], row[8], row[4], row[3], row[11]
    if mode not in number(modes):
        return "mode"
    if mode != 1.0:
        return "mode_label"
    if visa not in number(visas):
        return "visa"
    if addr not in states:
        return "state"
    if res not in number(countries):
        return "residence"
    return None if cit in number(countries) else "birth"


def awkward_rows():
    base = list(ARRIVAL_ROWS[0])

    def changed(cicid, **what):
        row = list(base)
        row[0] = cicid
        for at, value in what.items():
            row[int(at[1:])] = value
        return tuple(row)

    return ARRIVAL_ROWS + [
        changed(40.0, c11=None), changed(41.0, c11=9.0), changed(42.0, c4=None), changed(43.0, c3=None),
        changed(44.0, c3=5.0), changed(45.0, c7=None, c8=None, c11=None), changed(None), changed(46.0), changed(46.0),
        changed(47.0, c1=None), changed(48.0, c8=""), changed(49.0, c7=2.0, c8="??")]


def test_each_record_is_accepted_or_rejected_once(spark):
    rows = awkward_rows()
    tables = codes(spark)
    classified = rejects.classify_arrivals(arrivals_df(spark, rows), **tables)
    dropped = rejects.rejected(classified).collect()
    kept = rejects.accepted(classified)
    wanted = Counter((r[0], plain_reason(r, *[CODES[n][0] for n in ("modes", "visas", "states", "countries")])) for r in rows)
    found = Counter((r.cicid, r.rejected_by) for r in dropped) + Counter((r.cicid, None) for r in kept.collect())
    assert found == wanted
    conformed = facts.conform_arrivals(arrivals_df(spark, rows), **tables)
    assert kept.columns == conformed.columns and kept.dtypes == conformed.dtypes
    assert Counter(map(tuple, kept.collect())) == Counter(map(tuple, conformed.collect()))


def test_codes_that_occur_twice_multiply_rows_not_records(spark):
    tables = codes(spark, {"modes": [("1", "Air"), ("1", "Zeppelin")], "visas": [("1", "Trade")],
                           "states": [("NY", "NEW YORK CITY")], "countries": [("236", "AA"), (None, "nobody"), ("?", "?")]})
    rows = awkward_rows()
    classified = rejects.classify_arrivals(arrivals_df(spark, rows), **tables)
    conformed = facts.conform_arrivals(arrivals_df(spark, rows), **tables)
    assert Counter(map(tuple, rejects.accepted(classified).collect())) == Counter(map(tuple, conformed.collect()))
    totals = {r.rejected_by: (r.records, r.rows) for r in rejects.audit(classified).groupBy("rejected_by").agg(
        F.sum("records").alias("records"), F.sum("rows").alias("rows")).collect()}
    assert sum(records for records, _ in totals.values()) == len(rows)
    assert totals[None][1] == conformed.count() > totals[None][0]
    assert rejects.rejected(classified).count() == len(rows) - totals[None][0]


def test_empty_tables(spark):
    none = arrivals_df(spark, ARRIVAL_ROWS).limit(0)
    classified = rejects.classify_arrivals(none, **codes(spark))
    assert rejects.rejected(classified).count() == rejects.accepted(classified).count() == 0
    bare = {n: df.limit(0) for n, df in codes(spark).items()}
    classified = rejects.classify_arrivals(arrivals_df(spark, ARRIVAL_ROWS), **bare)
    assert {r.rejected_by for r in rejects.rejected(classified).collect()} == {"mode"}


def test_clashing_columns_are_refused(spark):
    with pytest.raises(ValueError, match="rename one side"):
        rejects.classify_arrivals(arrivals_df(spark, ARRIVAL_ROWS).withColumn("visa", F.lit("z")), **codes(spark))


def test_classification_reads_the_records_once_and_has_no_udf(spark, tmp_root):
    arrivals_df(spark, ARRIVAL_ROWS).write.parquet(f"{tmp_root}/arrivals")
    classified = rejects.classify_arrivals(spark.read.parquet(f"{tmp_root}/arrivals"), **codes(spark))
    plan = classified._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_run_stores_rejects_and_they_reconcile(spark, tmp_root):
    layout = stage(spark, tmp_root)
    options = Options(keep_rejects=True)
    pipeline.backfill(spark, layout, "2016-01", "2016-02", options)
    plain = stage(spark, f"{tmp_root}/plain")
    pipeline.backfill(spark, plain, "2016-01", "2016-02")
    for name in ("immigration", "immigrant", "immigration_demographics"):
        assert Counter(map(tuple, table(spark, layout, name).collect())) == Counter(map(tuple, table(spark, plain, name).collect()))
    stored = read_table(spark, layout.table("rejected_arrivals"), "rejected_arrivals")
    assert {(r.cicid, r.rejected_by, r.i94dt) for r in stored.collect()} == {
        (5.0, "mode_label", "201601"), (6.0, "mode_label", "201601"), (7.0, "mode", "201601"), (8.0, "state", "201601"),
        (9.0, "state", "201601"), (10.0, "residence", "201601")}
    months = [Period(2016, 1), Period(2016, 2)]
    found = {tuple(r) for r in pipeline.reconcile_periods(spark, layout, months).collect()}
    assert found == {("201601", 11, 5, 6, True), ("201602", 2, 2, 0, True)}
    # a rerun replaces the month's rejects; a file that has grown since no longer adds up
    pipeline.run_month(spark, layout, "2016-01", options, refresh_reference=False)
    assert read_table(spark, layout.table("rejected_arrivals"), "rejected_arrivals").count() == 6
    arrivals_df(spark, [ARRIVAL_ROWS[11]]).write.mode("append").parquet(layout.arrivals_path(Period(2016, 2)))
    with pytest.raises(quality.DataQualityError, match="201602"):
        pipeline.reconcile_periods(spark, layout, months)
