"""A4: monthly arrivals files addressed by a period path template."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import Layout
from ..periods import Period
from ..schemas import ARRIVALS


def read_arrivals(spark: SparkSession, layout: Layout, period: Period, fmt: str | None = None
                  ) -> DataFrame:
    """Read one month's arrivals file (Parquet or header CSV) with the explicit schema.

    Numeric fields are double and text fields string, as in the source files.
    """
    return read_arrival_months(spark, [layout.arrivals_path(period)],
                               fmt or layout.arrivals_format)


def read_arrival_months(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """Several month files in one scan (explicit schema, no inference pass)."""
    reader = spark.read.schema(ARRIVALS)
    if fmt == "csv":
        return reader.option("header", "true").csv(paths)
    return reader.format(fmt).load(paths)


def read_arrival_stream(spark: SparkSession, folder: str, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming view over a landing folder that receives new month files."""
    reader = spark.readStream.schema(ARRIVALS).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.load(folder)
