"""The first k rows of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANKS = {"rows": F.row_number, "rank": F.rank, "dense": F.dense_rank}


def top_k_per_group(df: DataFrame, by: list[str], order: list[Column], k: int, *, ties: str = "rows",
                    name: str = "place") -> DataFrame:
    """Rows whose place in their group, by ``order``, is at most ``k``; ``name`` is the place.

    Spark keeps k rows of a group per task before the shuffle (WindowGroupLimit),
    so a group with a third of all rows sends k rows from each task.  ``ties``:
    "rows" takes exactly k rows (give a complete order, else which of equal rows
    stay is open), "rank" all rows that tie with the k-th, "dense" those with the
    k best values.  Null is a group like others.
    """
    if ties not in _RANKS:
        raise ValueError(f"unknown ties {ties!r}")
    if k < 1:
        raise ValueError("k is at least 1")
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"top k would duplicate column {name}; give another name")
    return df.withColumn(name, _RANKS[ties]().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(name) <= k)
