"""Staged tables in the shared checkpoint folder.

A staged table cuts lineage, fixes what a task decided (row numbers, partition
ids) and is readable by every executor, so a lost executor costs only the
tasks that had not been committed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, underscored until no column of ``df`` has that name (any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def text_digest(text: Column) -> Column:
    """64-bit digest of a text; null for null."""
    return F.when(text.isNotNull(), F.xxhash64(text))


def without(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` whose id and text digest are not in ``gone`` (gone_id, gone_text).

    ``gone`` is staged with 16 bytes a row: its size on disk lets Spark choose the
    join, and the texts of ``docs`` are not shuffled while it can be broadcast.
    """
    gone = stage(gone.distinct(), name)
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"])
                     & (text_digest(docs["text"].cast("string")) == gone["gone_text"]), "left_anti")
