"""Parquet writers.

Partitioned writes are clustered with a ``rebalance`` hint on the partition
key (plus an optional spread column) instead of a plain ``repartition``: AQE
may then split a partition that holds a large share of the rows and coalesce
small ones, so one hot month or one dominant visa class never ends up in a
single write task.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SUCCESS_MARKER = "_SUCCESS"


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when a file or folder exists on the (shared) file system."""
    p, fs = _fs_path(spark, path)
    return bool(fs.exists(p))


def marker_exists(spark: SparkSession, table_path: str) -> bool:
    """True when the table folder holds a commit marker (shared file system)."""
    p, fs = _fs_path(spark, f"{table_path.rstrip('/')}/{SUCCESS_MARKER}")
    return bool(fs.exists(p))


def publish_marker(spark: SparkSession, table_path: str) -> None:
    """(Re)write the commit marker after a successful write.

    Dynamic partition overwrite commits through a staging folder and leaves
    no marker at the table root, so the writer publishes it itself.
    """
    p, fs = _fs_path(spark, f"{table_path.rstrip('/')}/{SUCCESS_MARKER}")
    fs.create(p, True).close()


def _observed(written: Observation) -> set[str]:
    """The periods an observation has seen; Spark keeps no metrics of a result it finds to be empty."""
    try:
        return set(written.get["periods"])
    except (Py4JJavaError, KeyError):
        return set()


def _clustered(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.hint("rebalance", *keys) if keys else df


def write_full(df: DataFrame, path: str, partition_by: str | None = None,
               max_records_per_file: int | None = None) -> None:
    """B1/B2: full refresh (replaces the table)."""
    writer_df = _clustered(df, [partition_by]) if partition_by else df
    # A full refresh replaces every partition, whatever the session default says.
    w = writer_df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_period(df: DataFrame, path: str, period_column: str = "i94dt",
                 spread: str | None = None, mode: str = "dynamic",
                 max_records_per_file: int | None = None,
                 salt_buckets: int | None = None, periods: list[str] | None = None) -> None:
    """Write the periods present in ``df``.

    ``periods`` names the periods that this run is for: after a dynamic write,
    those of them that got no row are removed, so no older rows stay in them.

    ``mode="dynamic"`` (default) overwrites exactly the periods being written,
    so a retried or repeated run leaves one copy of the rows; ``mode="append"``
    reproduces plain appends.

    Clustering uses the ``rebalance`` hint, which AQE sizes and splits at run
    time; Spark ignores that hint when AQE is off.  For such clusters
    ``salt_buckets`` switches to an explicit hash repartition on (period,
    spread, salt), spreading every (period, spread) group over up to that many
    tasks.
    """
    written = Observation()
    if periods is not None and mode == "dynamic":
        df = df.observe(written, F.collect_set(period_column).alias("periods"))
    keys = [period_column] + ([spread] if spread else [])
    if salt_buckets:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets))
        clustered = (df.withColumn("__salt", salt)
                     .repartition(*[F.col(k) for k in keys], F.col("__salt")).drop("__salt"))
    else:
        clustered = _clustered(df, keys)
    w = clustered.write.partitionBy(period_column)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if mode == "dynamic":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "append":
        w = w.mode("append")
    else:
        raise ValueError(f"unknown write mode {mode!r}")
    w.parquet(path)
    if periods is not None and mode == "dynamic":
        for period in sorted(set(periods) - _observed(written)):
            p, fs = _fs_path(df.sparkSession, f"{path.rstrip('/')}/{period_column}={period}")
            fs.delete(p, True)
    publish_marker(df.sparkSession, path)
