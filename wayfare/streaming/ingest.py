"""Arrivals ingest as a file stream.

A landing folder receives month files (any number of part files per month,
possibly late).  The stream only discovers *which* months received files; for
each micro-batch the touched months are rebuilt whole from the landing folder
with the same batch job as the monthly run (``pipeline.load_facts``), written
with dynamic partition overwrite.  Hence:

* exactly-once bookkeeping comes from the stream checkpoint (shared storage);
* a replayed micro-batch after a failure rewrites the same months -> no duplicates;
* a late file for a month already loaded rebuilds that month with all its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Layout, Options
from ..periods import Period
from ..plans import pipeline
from ..sources.arrivals import read_arrival_stream
from ..session import ensure_checkpoint_dir


def _landing_glob(layout: Layout) -> str:
    """Folder pattern that matches every month file of the template."""
    return layout.raw(layout.arrivals_template.replace("{token}", "*").replace("{key}", "*"))


def _touched_periods(batch: DataFrame, layout: Layout) -> list[Period]:
    token = F.regexp_extract(F.col("_metadata.file_path"), layout.arrivals_token_regex(), 1)
    tokens = [r[0] for r in batch.select(token.alias("t")).distinct().collect() if r[0]]
    return sorted(Period.from_token(t) for t in tokens)


def start_arrivals_ingest(spark: SparkSession, layout: Layout, options: Options = Options(), *,
                          checkpoint: str | None = None, available_now: bool = True,
                          processing_time: str | None = None,
                          with_mart: bool = False) -> StreamingQuery:
    """Start the ingest stream; code tables (and, ``with_mart``, the airports and
    city tables) must already be built.  ``with_mart`` also rewrites the mart of
    the touched months from the same conformed rows."""
    checkpoint = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/wayfare-arrivals-ingest"
    # only the file paths are needed to find the touched months (no data columns read)
    stream = read_arrival_stream(spark, _landing_glob(layout),
                                 layout.arrivals_format).select("_metadata")

    def load(batch: DataFrame, batch_id: int) -> None:
        periods = _touched_periods(batch, layout)
        if periods:
            pipeline.load_facts(batch.sparkSession, layout, periods, options, with_mart=with_mart)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def ingest_available(spark: SparkSession, layout: Layout, options: Options = Options(), *,
                     checkpoint: str | None = None, with_mart: bool = False) -> None:
    """Process every file currently in the landing folder, then stop."""
    q = start_arrivals_ingest(spark, layout, options, checkpoint=checkpoint, available_now=True,
                              with_mart=with_mart)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
