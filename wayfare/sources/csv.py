"""A2/A3: header CSV sources.  All columns are read as text, no schema inference pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _csv(spark: SparkSession, path: str, sep: str) -> DataFrame:
    return (spark.read.option("header", "true").option("sep", sep)
            .option("encoding", "UTF-8").option("inferSchema", "false").csv(path))


def read_demographics(spark: SparkSession, path: str) -> DataFrame:
    """A2: semicolon-separated city demographics."""
    return _csv(spark, path, ";")


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """A3: comma-separated airport codes."""
    return _csv(spark, path, ",")


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """A3: comma-separated city temperatures."""
    return _csv(spark, path, ",")
