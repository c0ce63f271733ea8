"""Write, audit, publish: a month changes whole and checked, or not at all."""

import glob
import hashlib
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.fixtures import ARRIVAL_ROWS, arrivals_df
from tests.test_pipeline import stage, table
from wayfare.config import Options
from wayfare.periods import Period
from wayfare.plans import pipeline, quality
from wayfare.sinks import published


def all_bytes(root):
    return {os.path.relpath(p, root): hashlib.sha256(open(p, "rb").read()).hexdigest()
            for p in glob.glob(f"{root}/**/*", recursive=True) if os.path.isfile(p)}


def rows(spark, layout, name, **how):
    return Counter(map(tuple, published.read_published(spark, layout.published_root(), name, **how).collect()))


@pytest.fixture(scope="module")
def layout(spark):
    import tempfile
    layout = stage(spark, tempfile.mkdtemp(prefix="wayfare-publish-"))
    pipeline.publish_months(spark, layout, "2016-01", "2016-02", Options(keep_rejects=True))
    return layout


def test_published_tables_are_those_of_a_plain_run(spark, layout, tmp_root):
    plain = stage(spark, tmp_root)
    pipeline.backfill(spark, plain, "2016-01", "2016-02")
    for name in pipeline.MONTHLY:
        assert rows(spark, layout, name) == Counter(map(tuple, table(spark, plain, name).collect()))
        df = published.read_published(spark, layout.published_root(), name)
        assert df.columns == table(spark, plain, name).columns
    assert sum(rows(spark, layout, "rejected_arrivals").values()) == 6


def test_a_failed_gate_leaves_every_published_byte(spark, tmp_root):
    layout = stage(spark, tmp_root)
    pipeline.publish_months(spark, layout, "2016-01", "2016-02")
    before, seen = all_bytes(layout.published_root()), rows(spark, layout, "immigration")
    sea_only = arrivals_df(spark, [r for r in ARRIVAL_ROWS if r[2] == 1.0]).withColumn("i94mode", F.lit(2.0))
    sea_only.write.mode("overwrite").parquet(layout.arrivals_path(Period(2016, 1)))
    with pytest.raises(quality.DataQualityError, match="201601"):
        pipeline.publish_months(spark, layout, "2016-01", "2016-02", refresh_reference=False)
    assert all_bytes(layout.published_root()) == before and rows(spark, layout, "immigration") == seen

    def too_few(written):
        if written("immigration").count() < 100:
            raise quality.DataQualityError("too few")

    with pytest.raises(quality.DataQualityError, match="too few"):
        pipeline.publish_months(spark, layout, "2016-02", "2016-02", refresh_reference=False, checks=[too_few])
    assert all_bytes(layout.published_root()) == before


def test_a_month_is_replaced_alone_and_an_open_reader_keeps_its_version(spark, tmp_root):
    layout = stage(spark, tmp_root)
    root = layout.published_root()
    first = pipeline.publish_months(spark, layout, "2016-01", "2016-02")
    old = published.read_published(spark, root, "immigration")
    arrivals_df(spark, [ARRIVAL_ROWS[0]]).write.mode("overwrite").parquet(layout.arrivals_path(Period(2016, 1)))
    second = pipeline.publish_months(spark, layout, "2016-01", "2016-01", refresh_reference=False)
    assert (first.version, second.version) == (1, 2)
    assert second.tables["immigration"]["201602"] == first.tables["immigration"]["201602"]
    assert sorted(r.cicid for r in published.read_published(spark, root, "immigration").collect()) == [1, 21, 22]
    assert old.count() == 7
    assert rows(spark, layout, "immigration", manifest=first) == Counter(map(tuple, old.collect()))
    # back to what was there before, then only the files that are still named stay
    published.publish(spark, root, first.tables)
    assert published.read_published(spark, root, "immigration").count() == 7
    gone = published.retire(spark, root, keep=1)
    assert len(gone) == 3 and published.read_published(spark, root, "immigration_demographics").count() == 14
    assert published.read_manifest(spark, root).version == 3
    with pytest.raises(ValueError):
        published.retire(spark, root, keep=0)


def test_two_publishers_cannot_both_win(spark, tmp_root):
    root = f"{tmp_root}/published"
    base = published.read_manifest(spark, root)
    assert base == published.Manifest()
    published.publish(spark, root, {"immigration": {"201601": "a"}}, base)
    with pytest.raises(published.PublishConflict):
        published.publish(spark, root, {"immigration": {"201601": "b"}}, base)
    assert published.read_manifest(spark, root).tables == {"immigration": {"201601": "a"}}
    assert not [p for p in os.listdir(f"{root}/_manifests") if p.startswith(".") and not p.endswith(".crc")]
    published.publish(spark, root, {"immigration": {"201601": None}})
    assert published.read_manifest(spark, root).tables == {"immigration": {}}


def test_reading_some_months_lists_only_their_folders(spark, layout):
    one = published.read_published(spark, layout.published_root(), "immigration", ["201602", "209901"])
    assert sorted(r.cicid for r in one.collect()) == [21, 22]
    assert len(one.inputFiles()) >= 1 and all("i94dt=201602" in f for f in one.inputFiles())


def test_nothing_published_is_an_empty_table(spark, tmp_root):
    for name in ("immigration", "rejected_arrivals"):
        df = published.read_published(spark, f"{tmp_root}/none", name)
        assert df.count() == 0 and "i94dt" in df.columns
    with pytest.raises(ValueError, match="is published"):
        root = f"{tmp_root}/p"
        published.publish(spark, root, {"immigration": {"201601": "a"}})
        published.discard_run(spark, root, ["immigration"], "a")


def test_in_place_runs_check_before_they_overwrite(spark, tmp_root):
    layout = stage(spark, tmp_root)
    pipeline.backfill(spark, layout, "2016-01", "2016-02")
    arrivals_df(spark, [ARRIVAL_ROWS[4]]).write.mode("overwrite").parquet(layout.arrivals_path(Period(2016, 1)))
    before = all_bytes(layout.processed_root)
    with pytest.raises(quality.DataQualityError, match="201601"):
        pipeline.run_month(spark, layout, "2016-01", refresh_reference=False)
    assert all_bytes(layout.processed_root) == before
    # a run that only reports gaps clears the month, as before
    pipeline.run_month(spark, layout, "2016-01", Options(strict_checks=False), refresh_reference=False)
    assert {r.i94dt for r in table(spark, layout, "immigration").collect()} == {"201602"}


def test_command_line_publish_reconcile_and_retire(spark, tmp_root, capsys):
    from wayfare.__main__ import main
    layout = stage(spark, tmp_root)
    roots = ["--raw", layout.raw_root, "--processed", layout.processed_root]
    assert main(["publish", *roots, "--start", "2016-01", "--end", "2016-02"]) == 0
    assert main(["publish", *roots, "--start", "2016-02", "--skip-reference"]) == 0
    assert capsys.readouterr().out.split() == ["published", "1", "published", "2"]
    assert main(["retire", *roots, "--keep", "1"]) == 0
    gone = capsys.readouterr().out.split()       # the first run keeps January, which is still published
    assert len(gone) == 6 and all(name.endswith("/i94dt=201602") for name in gone[1::2])
    assert published.read_published(spark, layout.published_root(), "immigration").count() == 7
    assert main(["run-month", *roots, "--period", "2016-01", "--keep-rejects", "--skip-reference"]) == 0
    capsys.readouterr()
    assert main(["reconcile", *roots, "--start", "2016-01"]) == 0
    assert capsys.readouterr().out.split() == ["201601", "11", "5", "6"]
