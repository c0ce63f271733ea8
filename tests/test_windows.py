"""Windowed event stream: equals the batch after a failure and a restart; late events; sessions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wayfare.streaming import windows

T0 = dt.datetime(2024, 1, 1)


def event(k, minutes, kind="click", user=1, value=1.0):
    return (k, None if minutes is None else T0 + dt.timedelta(minutes=minutes), user, kind, value, "{}")


def some_events(seed, n=400):
    rng = random.Random(seed)
    return [event(k, None if k % 50 == 49 else k * 7 + rng.randrange(-20, 20), rng.choice(["click", "view", None]), rng.randrange(5),
                  rng.choice([None, 1.25, -3.0, 10.0])) for k in range(n)]


def land(spark, root, rows):
    spark.createDataFrame(rows, windows.EVENTS).coalesce(1).write.mode("append").parquet(f"{root}/landing")


def run(spark, root, **how):
    stream = windows.read_event_stream(spark, f"{root}/landing", files_per_batch=1)
    query = windows.start_event_windows(stream, f"{root}/out", f"{root}/checkpoint", width="2 hours", delay="1 hour", **how)
    query.awaitTermination()


def as_set(df):
    rows = [tuple(r) for r in df.select("window_start", "window_end", "event_type", "events", "lowest", "highest", "total").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("slide", [None, "30 minutes"])
def test_stream_equals_batch_after_a_failure_half_way(spark, tmp_root, slide):
    rows = some_events(1)
    for at in range(0, 400, 100):
        land(spark, tmp_root, rows[at:at + 100])

    def fails(batch_id):
        if batch_id == 2:
            raise RuntimeError("lost the driver")

    with pytest.raises(Exception, match="lost the driver"):
        run(spark, tmp_root, slide=slide, before_commit=fails)
    run(spark, tmp_root, slide=slide)      # replays the batch that had written but was not done
    batch = windows.event_windows(spark.createDataFrame(rows, windows.EVENTS), width="2 hours", slide=slide)
    assert as_set(windows.current_windows(spark, f"{tmp_root}/out")) == as_set(batch)
    windows.compact_windows(spark, f"{tmp_root}/out", f"{tmp_root}/compact")
    assert as_set(windows.current_windows(spark, f"{tmp_root}/compact")) == as_set(batch)
    run(spark, tmp_root, slide=slide)      # nothing new
    assert as_set(windows.current_windows(spark, f"{tmp_root}/out")) == as_set(batch)


def test_late_events_count_until_the_watermark_has_passed(spark, tmp_root):
    land(spark, tmp_root, [event(1, 10), event(2, 300)])
    run(spark, tmp_root)
    # the watermark is at minute 240: the window of minute 10 is closed, that of minute 250 is not
    land(spark, tmp_root, [event(3, 20), event(4, 250)])
    run(spark, tmp_root)
    found = {(r.window_start - T0).seconds // 60: r.events for r in windows.current_windows(spark, f"{tmp_root}/out").collect()}
    assert found == {0: 1, 240: 2}


def test_events_without_time_and_no_events(spark):
    assert windows.event_windows(spark.createDataFrame([event(1, None)], windows.EVENTS)).collect() == []
    assert windows.user_sessions(spark.createDataFrame([], windows.EVENTS)).collect() == []


def test_sessions_of_a_stream_equal_those_of_the_batch(spark, tmp_root):
    rows = [event(k, m, user=u) for k, (m, u) in enumerate([(0, 1), (20, 1), (45, 1), (80, 1), (10, 2), (41, 2), (70, None)])]
    late = [event(20, 62, user=1)]                         # joins the sessions of minutes 45 and 80
    closing = [event(90 + k, 10_000 + 500 * k, user=99) for k in range(2)]
    land(spark, tmp_root, rows)
    land(spark, tmp_root, late)
    land(spark, tmp_root, closing[:1])
    land(spark, tmp_root, closing[1:])
    stream = windows.read_event_stream(spark, f"{tmp_root}/landing", files_per_batch=1)
    query = (windows.user_sessions(stream, gap="30 minutes", delay="2 hours").writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", f"{tmp_root}/ckpt").option("path", f"{tmp_root}/sessions").trigger(availableNow=True).start())
    query.awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(f"{tmp_root}/sessions").filter("user_id <> 99").collect()}
    batch = windows.user_sessions(spark.createDataFrame(rows + late, windows.EVENTS), gap="30 minutes")
    assert got == {tuple(r) for r in batch.collect()} and len(got) == 3


def test_state_is_kept_by_key_and_events_are_summed_before_the_shuffle(spark):
    df = windows.event_windows(spark.createDataFrame(some_events(2), windows.EVENTS))
    df.write.format("noop").mode("overwrite").save()
    assert "partial_count" in df._jdf.queryExecution().executedPlan().toString()
    assert df.agg(F.sum("events")).first()[0] == 392
