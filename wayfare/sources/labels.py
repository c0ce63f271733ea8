"""A1: headerless ``code = label`` text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import LABELS


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Scan label files into (raw_code, raw_label).

    Split on the single ``=``; whitespace and apostrophes are kept as they are
    (cleaning is the job of the column helpers); blank lines are skipped.
    """
    return (spark.read.schema(LABELS)
            .option("sep", "=").option("header", "false")
            .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
            .option("mode", "PERMISSIVE")
            .csv(path))
