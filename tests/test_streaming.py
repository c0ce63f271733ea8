"""Structured Streaming ingest: late files and replays leave one copy of each row."""

import tempfile

from pyspark.sql import functions as F

from tests.fixtures import ARRIVAL_ROWS, arrivals_df
from tests.test_pipeline import stage
from wayfare.periods import Period
from wayfare.plans import pipeline
from wayfare.sources.tables import read_table
from wayfare.streaming import ingest_available


def test_period_tokens():
    assert Period.from_token("jan16") == Period(2016, 1)
    assert Period.from_token("dec97") == Period(1997, 12)
    assert Period(2016, 4).token == "apr16"


def test_stream_ingest_late_file_and_replay(spark):
    root = tempfile.mkdtemp(prefix="wayfare-stream-")
    layout = stage(spark, root)
    pipeline.build_code_tables(spark, layout)
    ckpt = f"{root}/ckpt"
    ingest_available(spark, layout, checkpoint=ckpt)
    imm = read_table(spark, layout.table("immigration"), "immigration")
    assert imm.count() == 7
    # a late January file arrives: January is rebuilt with all of its files
    late = [(31.0,) + ARRIVAL_ROWS[0][1:]]
    arrivals_df(spark, late).write.mode("append").parquet(layout.arrivals_path(Period(2016, 1)))
    ingest_available(spark, layout, checkpoint=ckpt)
    imm = read_table(spark, layout.table("immigration"), "immigration")
    assert imm.count() == 8
    assert imm.filter(F.col("cicid") == 31).first().i94dt == "201601"
    # nothing new: a rerun is a no-op
    ingest_available(spark, layout, checkpoint=ckpt)
    assert read_table(spark, layout.table("immigration"), "immigration").count() == 8
    # a fresh checkpoint replays everything and still leaves one copy
    ingest_available(spark, layout, checkpoint=f"{root}/ckpt2")
    assert read_table(spark, layout.table("immigration"), "immigration").count() == 8


def test_command_line_ingest(spark):
    from wayfare.__main__ import main
    root = tempfile.mkdtemp(prefix="wayfare-cli-stream-")
    layout = stage(spark, root)
    assert main(["ingest", "--raw", layout.raw_root, "--processed", layout.processed_root,
                 "--checkpoint", f"{root}/ckpt"]) == 0
    assert read_table(spark, layout.table("immigrant"), "immigrant").count() == 7


def test_stream_ingest_with_mart(spark):
    root = tempfile.mkdtemp(prefix="wayfare-stream-mart-")
    layout = stage(spark, root)
    pipeline.build_code_tables(spark, layout)
    pipeline.build_dimensions(spark, layout)
    ingest_available(spark, layout, checkpoint=f"{root}/ckpt", with_mart=True)
    mart = read_table(spark, layout.table("immigration_demographics"), "immigration_demographics")
    assert mart.count() == 14


def test_token_regex_is_anchored_to_path_segments():
    import re
    from wayfare.config import Layout
    bare = Layout("r", "p", arrivals_template="arrivals/{token}/data.parquet")
    rx = bare.arrivals_token_regex()
    assert re.search(rx, "s3a://b/abc12x/arrivals/jan16/data.parquet/part-0").group(1) == "jan16"
    default = Layout("r", "p")
    assert re.search(default.arrivals_token_regex(),
                     "file:/x/arrivals/i94_feb16_sub.parquet/part-0.parquet").group(1) == "feb16"
