"""Processed (stored) tables, optionally pruned to one period."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import AUDIT, STORED


def read_table(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """Read a stored Parquet table.

    For known tables the stored schema is supplied, which also types the
    partition column (``i94dt`` stays text whatever the session's
    partition-type inference says).
    """
    reader = spark.read
    known = STORED | AUDIT
    if name in known:
        reader = reader.schema(known[name])
    df = reader.parquet(path)
    if "i94dt" in df.columns and name not in known:
        df = df.withColumn("i94dt", F.col("i94dt").cast("string"))
    return df


def read_period(spark: SparkSession, path: str, period: str, name: str | None = None,
                column: str = "i94dt") -> DataFrame:
    """Only the files of one period are scanned (PartitionFilters)."""
    return read_table(spark, path, name).filter(F.col(column) == period)
