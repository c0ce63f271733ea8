"""Inner equi-joins.

No broadcast hints: code tables are stored as Parquet, so Spark knows their
size in bytes and broadcasts them below ``spark.sql.autoBroadcastJoinThreshold``;
above it the join is a shuffle join, which AQE may still turn into a broadcast
or split where keys are skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions.text import text_key_as_double


def _dtype(df: DataFrame, column: str):
    return df.schema[column].dataType


def _aligned_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> tuple[Column, Column]:
    """Numeric fact key vs text dim key: normalise the text once (trim + try_cast)."""
    ft, dt = _dtype(fact, fact_key), _dtype(dim, dim_key)
    fk, dk = F.col(fact_key), F.col(dim_key)
    if isinstance(ft, NumericType) and isinstance(dt, StringType):
        return fk.cast("double"), text_key_as_double(dk)
    if isinstance(ft, StringType) and isinstance(dt, NumericType):
        return text_key_as_double(fk), dk.cast("double")
    return fk, dk


def using_join(left: DataFrame, right: DataFrame, keys: list[str] | str) -> DataFrame:
    """Inner USING join; keys emitted once, first; null keys never match."""
    return left.join(right, keys if isinstance(keys, list) else [keys], "inner")


def multi_key_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """E5."""
    return using_join(left, right, keys)


def coerced_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None,
                   *, keep_key: bool = True) -> DataFrame:
    """Lookup join where key types may differ (double fact key vs text code).

    The dimension key is normalised once on the (small) dimension side, so the
    fact side stays a plain column and the join stays a hash join.  Output:
    the fact's columns then the dimension's non-key columns; ``keep_key=False``
    drops the fact key as well.
    """
    dim_key = dim_key or fact_key
    fk, dk = _aligned_keys(fact, fact_key, dim, dim_key)
    fact_cols = [c for c in fact.columns if keep_key or c != fact_key]
    dim_cols = [c for c in dim.columns if c != dim_key]
    clash = set(fact.columns) & set(dim_cols)
    if clash:
        raise ValueError(f"lookup would duplicate columns {sorted(clash)}; rename one side first")
    d = dim.select(dk.alias("__lookup_key"), *dim_cols)
    joined = fact.join(d, fk == F.col("__lookup_key"), "inner")
    return joined.select(*fact_cols, *dim_cols)


def named_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, *,
                 keep_dim_key: bool = False) -> DataFrame:
    """Lookup on differently named keys; rows with unknown/null keys are dropped.

    Keeps the fact key; keeps the dim key only when asked (as the arrivals
    state lookup does).
    """
    fk, dk = _aligned_keys(fact, fact_key, dim, dim_key)
    dim_cols = [c for c in dim.columns if keep_dim_key or c != dim_key]
    clash = set(fact.columns) & set(dim_cols)
    if clash:
        raise ValueError(f"lookup would duplicate columns {sorted(clash)}; rename one side first")
    d = dim.select(dk.alias("__lookup_key"), *dim_cols)
    joined = fact.join(d, fk == F.col("__lookup_key"), "inner")
    return joined.select(*fact.columns, *dim_cols)


def outer_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, columns: dict[str, str],
                 found: str) -> DataFrame:
    """Left outer lookup that says whether it matched.

    Keeps every fact row and column, adds the dimension's ``columns`` (source ->
    output name) and ``found``: 1 for the first match of a row, 2, 3, ... for
    further ones (a code that occurs several times multiplies the row, as the
    inner lookups do), null for none.  Null keys match nothing.
    """
    fk, dk = _aligned_keys(fact, fact_key, dim, dim_key)
    clash = set(fact.columns) & {*columns.values(), found}
    if clash:
        raise ValueError(f"lookup would duplicate columns {sorted(clash)}; rename one side first")
    d = dim.select(dk.alias("__lookup_key"), *[F.col(c).alias(name) for c, name in columns.items()]).filter(
        "__lookup_key is not null")
    nth = F.row_number().over(Window.partitionBy("__lookup_key").orderBy(*(list(columns.values()) or ["__lookup_key"])))
    return fact.join(d.withColumn(found, nth), fk == F.col("__lookup_key"), "left").drop("__lookup_key")


def role_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                role_names: dict[str, str], *, drop_fact_key: bool = True) -> DataFrame:
    """One dimension joined in a named role (e.g. country as residence).

    ``role_names`` renames the dimension's attribute columns for this role.
    """
    d = dim.withColumnsRenamed(role_names)
    out = named_lookup(fact, d, fact_key, dim_key)
    return out.drop(fact_key) if drop_fact_key else out


def replace_side_columns(left: DataFrame, right: DataFrame, keys: list[str] | str,
                         drop_from_right: list[str]) -> DataFrame:
    """Drop ``drop_from_right`` from the right side, then USING-join, so the
    left side's copies of those columns are the ones that survive."""
    return using_join(left, right.drop(*drop_from_right), keys)
