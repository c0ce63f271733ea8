"""Totals over several sets of dimensions from one scan.

Rows are aggregated once at the finest grain, all dimensions together; only
that result, at most a row per combination that occurs, is expanded into the
grouping sets.  (Grouping sets over the rows themselves would copy each row once
per set before the first aggregation.)
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_sets(dims: list[str]) -> list[list[str]]:
    return [dims[:n] for n in range(len(dims), -1, -1)]


def cube_sets(dims: list[str]) -> list[list[str]]:
    return [list(s) for n in range(len(dims), -1, -1) for s in combinations(dims, n)]


def grouped_totals(df: DataFrame, dims: list[str], sets: list[list[str]], measures: dict[str, tuple[str, str]],
                   *, grouping_name: str = "grouping_id") -> DataFrame:
    """(dims..., measures..., grouping_id) for each set of dimensions.

    ``measures``: name -> (kind, column); kinds are ``count`` (rows; column ``*``,
    or its values that are not null), ``sum``, ``min``, ``max``, ``avg`` and
    ``distinct`` (different values that are not null; the column joins the finest
    grain).  Dimensions that a set leaves out are null; ``grouping_id`` has a bit
    for each dimension, the first one highest, that is 1 where it is left out, and
    so tells those nulls from null values.  Repeated sets count once.  Without
    rows there is no total, as without any group; the empty set ``[]`` gives the
    grand total.
    """
    unknown = {c for s in sets for c in s} - set(dims)
    if unknown:
        raise ValueError(f"sets name no dimension: {sorted(unknown)}")
    clash = {m.lower() for m in measures} & {c.lower() for c in [*dims, grouping_name]}
    if clash:
        raise ValueError(f"measures would duplicate columns {sorted(clash)}")
    partial: list[Column] = []
    final: list[Column] = []
    distinct = {name: f"__distinct_{name}" for name, (kind, _) in measures.items() if kind == "distinct"}
    for name, (kind, column) in measures.items():
        part = f"__part_{name}"
        if kind == "count":
            partial.append(F.count(F.lit(1) if column == "*" else F.col(column)).alias(part))
            final.append(F.sum(part).alias(name))
        elif kind in ("sum", "min", "max"):
            combine = getattr(F, kind)
            partial.append(combine(column).alias(part))
            final.append(combine(part).alias(name))
        elif kind == "avg":
            partial += [F.sum(column).alias(part), F.count(column).alias(f"{part}_n")]
            final.append((F.sum(part) / F.when(F.sum(f"{part}_n") > 0, F.sum(f"{part}_n"))).alias(name))
        elif kind == "distinct":
            final.append(F.count_distinct(distinct[name]).alias(name))
        else:
            raise ValueError(f"unknown measure {kind!r}")
    grain = [*[F.col(c) for c in dims], *[F.col(measures[n][1]).alias(c) for n, c in distinct.items()]]
    # without an own partial measure the grain alone is aggregated
    fine = df.groupBy(*grain).agg(*partial) if partial else df.select(*grain).distinct()
    unique = [list(s) for s in dict.fromkeys(tuple(c for c in dims if c in s) for s in sets)]
    return fine.groupingSets([[F.col(c) for c in s] for s in unique], *dims).agg(
        *final, F.grouping_id(*dims).cast("long").alias(grouping_name))
