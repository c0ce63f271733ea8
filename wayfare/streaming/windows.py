"""Windowed activity of an event stream, with a watermark and keyed state.

The same function makes the windows of a batch and of a stream.  The stream
keeps one row of state per open window and key; a window is closed, and its
state dropped, once the watermark (latest event time seen, less the allowed
delay) has passed its end.  An event that comes later than that is left out; any
earlier one changes its window, however out of order the files are.

Each micro-batch writes the windows it has changed to a folder of its own, which
a replay after a failure replaces, so a restart from the checkpoint neither
loses nor repeats anything.  A reader takes the latest state of each window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
WINDOWS = ("window_start timestamp, window_end timestamp, event_type string, events long, lowest double, highest double, "
           "total decimal(38,4), batch long")


def event_windows(events: DataFrame, *, width: str = "1 day", slide: str | None = None, by: str = "event_type",
                  delay: str = "1 hour") -> DataFrame:
    """Events, lowest, highest and total value of each window and key (batch or stream).

    Windows of ``width`` start every ``slide`` (default: they do not overlap).
    Events without a time are in no window; a null key is a key; null values
    count as events and have no part in the values.  Totals are decimal, so they
    do not depend on the order of arrival.
    """
    timed = events.filter("ts is not null").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return timed.groupBy(F.window("ts", width, slide), by).agg(
        F.count(F.lit(1)).alias("events"), F.min("value").alias("lowest"), F.max("value").alias("highest"),
        F.sum(F.col("value").cast("decimal(28,4)")).alias("total")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), by, "events", "lowest", "highest", "total")


def user_sessions(events: DataFrame, *, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Sessions of each user: events no more than ``gap`` apart (batch, or a stream in append mode).

    A late event within the watermark can join two sessions into one; a stream
    gives a session once the watermark has passed its end.
    """
    timed = events.filter("ts is not null and user_id is not null").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark(
        "ts", delay)
    return timed.groupBy("user_id", F.session_window("ts", gap)).agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(28,4)")).alias("total")).select(
        "user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"),
        "events", "total")


def read_event_stream(spark: SparkSession, folder: str, *, files_per_batch: int | None = None,
                      schema: str | StructType = EVENTS) -> DataFrame:
    """Parquet event files of a landing folder, in the order in which they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def start_event_windows(events: DataFrame, out: str, checkpoint: str, *, width: str = "1 day", slide: str | None = None,
                        delay: str = "1 hour", available_now: bool = True, before_commit=None) -> StreamingQuery:
    """Start the windowed stream; each micro-batch writes its changed windows to ``out/batch=<n>``.

    ``before_commit(batch_id)`` is called after the write and before the batch
    counts as done (for tests of a failure there).
    """
    def store(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out.rstrip('/')}/batch={batch_id}")
        if before_commit is not None:
            before_commit(batch_id)

    writer = event_windows(events, width=width, slide=slide, delay=delay).writeStream.outputMode("update").foreachBatch(
        store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_windows(spark: SparkSession, out: str) -> DataFrame:
    """The latest state of each window and key; combined per task before the shuffle."""
    rows = spark.read.schema(WINDOWS).parquet(out)
    keys = ["window_start", "window_end", "event_type"]
    values = ["events", "lowest", "highest", "total"]
    last = F.max_by(F.struct(*values), "batch").alias("v")
    return rows.groupBy(*keys).agg(last).select(*keys, "v.*")


def compact_windows(spark: SparkSession, out: str, into: str) -> None:
    """Write the latest states as batch 0 of a new folder, for an output with many batches."""
    current_windows(spark, out).write.parquet(f"{into.rstrip('/')}/batch=0")
