"""Projections and column operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Bulk rename; names that are absent are no-ops."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Column subset in the given order."""
    return df.select(*columns)


def cast_columns(df: DataFrame, spec: list[tuple[str, str | None, str | None]]) -> DataFrame:
    """Projection where each item is (source, target type or None, alias or None).

    Casts use ``try_cast``: double -> int truncates (3.7 -> 3) and values out of
    range become null instead of failing the job under ANSI mode.
    """
    cols = []
    for source, dtype, alias in spec:
        c = F.col(source) if dtype is None else F.col(source).try_cast(dtype)
        cols.append(c.alias(alias or source))
    return df.select(*cols)


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """C4."""
    return df.drop(*columns)


def with_period(df: DataFrame, period_value, column: str = "i94dt") -> DataFrame:
    """Constant (or per-row) period column, text ``yyyyMM``."""
    value = period_value if not isinstance(period_value, str) else F.lit(period_value)
    return df.withColumn(column, value.cast("string"))


def with_long_copy(df: DataFrame, column: str, alias: str) -> DataFrame:
    """Keep ``column`` and add its long copy ``alias``."""
    return df.withColumn(alias, F.col(column).try_cast("long"))
