"""H1-H3: quality gates and preview."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.parquet import marker_exists
from ..schemas import STORED
from ..sources.tables import read_period, read_table


class DataQualityError(ValueError):
    """Raised when a quality gate fails."""


def periods_present(df: DataFrame, period_column: str = "i94dt") -> DataFrame:
    """H1 for many periods in one job: rows per period (partial aggregation per task)."""
    return df.groupBy(period_column).agg(F.count(F.lit(1)).alias("rows"))


def check_nonempty(spark: SparkSession, path: str, table: str, period: str) -> None:
    """H1: the period must have at least one column and one row, else raise.

    ``isEmpty`` stops at the first row found in the pruned partition.
    """
    df = read_period(spark, path, period, table)
    if not df.columns or df.isEmpty():
        raise DataQualityError(f"data quality check failed: {table} has no rows for {period}")


def require_periods(what: str, wanted: list[str], present: set[str]) -> None:
    """H1: raise for the periods that have no row."""
    missing = sorted(set(wanted) - present)
    if missing:
        raise DataQualityError(f"data quality check failed: {what} has no rows for {', '.join(missing)}")


def require_published(spark: SparkSession, tables: dict[str, str], periods: list[str] | None = None) -> None:
    """H2 after a run: each table has its marker and a row, those by month one in ``periods`` if these are named.

    ``isEmpty`` stops at the first row, so the history is not counted again.
    """
    def check(item):
        name, path = item
        if not marker_exists(spark, path):
            return name, False
        rows = read_table(spark, path, name) if name in STORED else spark.read.parquet(path)
        if periods is not None and "i94dt" in rows.columns:
            rows = rows.filter(F.col("i94dt").isin(periods))
        return name, not rows.isEmpty()

    with ThreadPoolExecutor(max_workers=max(1, min(4, len(tables)))) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(check), tables.items()))
    failed = [name for name, there in found if not there]
    if failed:
        raise DataQualityError(f"publication check failed for: {', '.join(failed)}")


def publication_check(spark: SparkSession, tables: dict[str, str], *, raise_on_fail: bool = True
                      ) -> DataFrame:
    """H2: every table has a commit marker and at least one row.

    A marker alone is not enough for appended tables (an old marker stays), so
    the rows are always counted too; a table without a marker counts as empty.
    Returns (table, has_marker, rows).
    """
    def check(item):
        name, path = item
        has_marker = marker_exists(spark, path)
        if not has_marker:
            return name, False, 0
        # with its schema, a table whose every period was cleared can be read too
        rows = read_table(spark, path, name) if name in STORED else spark.read.parquet(path)
        return name, True, rows.count()

    with ThreadPoolExecutor(max_workers=max(1, min(4, len(tables)))) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(check), tables.items()))
    failed = [n for n, m, r in rows if not (m and r)]
    if failed and raise_on_fail:
        raise DataQualityError(f"publication check failed for: {', '.join(failed)}")
    return spark.createDataFrame(rows, "table string, has_marker boolean, rows long")


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """H3: first ``n`` rows; deterministic when ``order_by`` is given (top-n, no full sort)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
