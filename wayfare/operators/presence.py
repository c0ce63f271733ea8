"""How many are present on each day, from stays with a first and a last day.

A stay is +1 on its first day and -1 on the day after its last; the number
present on a day is the sum of all that has happened up to it.  Events are
summed per group and day before anything else (a hot group is a row per task
and day), and the running sum has two levels: within blocks of days, and over
the totals of the blocks before.  No stay is ever spread over its days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_DAYS = 64
EPOCH = "1970-01-01"


def _day(column: str) -> Column:
    return F.datediff(F.col(column).try_cast("date"), F.lit(EPOCH).cast("date"))


def _day_of(iso: str) -> Column:
    return F.datediff(F.lit(iso).cast("date"), F.lit(EPOCH).cast("date"))


def presence_per_day(stays: DataFrame, start: str, end: str, by: list[str] | None = None, *,
                     open_stays: str = "to_last", first_day: str | None = None, last_day: str | None = None,
                     count_last_day: bool = True, name: str = "present") -> DataFrame:
    """(by..., day, ``name``, arrived, left): a row for each group and day.

    A stay counts from ``start`` to ``end``, the last day included unless
    ``count_last_day`` is false.  Both are dates, or text that casts to one (other
    text is no date).
    Days run from ``first_day`` to ``last_day`` (ISO text), by default from the
    first start to the last start or end of any stay of the table; all groups
    have the same days, those with nobody present too.  Stays that began before
    ``first_day`` are present on it.

    A stay without an end lasts ``to_last`` day, or is left out (``drop``).
    Stays without a start, or that end before they start, are left out, as are
    groups without any stay that counts.  Null is a group like others.  Repeated
    stays count as often as they occur.  An empty table has no days.  The stays are
    read more than once (for the days, too): give a stored table, not a long plan.
    """
    if open_stays not in ("to_last", "drop"):
        raise ValueError(f"unknown open_stays {open_stays!r}")
    by = by or []
    clash = {c.lower() for c in by} & {"day", name.lower(), "arrived", "left"}
    if clash:
        raise ValueError(f"presence would duplicate columns {sorted(clash)}; rename them first")
    keys = [f"__k{i}" for i in range(len(by))] or ["__all"]
    groups = [F.col(c).alias(k) for c, k in zip(by, keys)] or [F.lit(0).alias("__all")]
    spans = stays.select(*groups, _day(start).alias("__from"), _day(end).alias("__to"))
    spans = spans.filter("__from is not null and (__to is null or __to >= __from)")
    if open_stays == "drop":
        spans = spans.filter("__to is not null")
    # two events of a stay at most, summed per group and day at once
    gone = F.col("__to") + (1 if count_last_day else 0)
    event = F.explode(F.array(
        F.struct(F.col("__from").alias("__day"), F.lit(1).alias("__in"), F.lit(0).alias("__out")),
        F.struct(gone.alias("__day"), F.lit(0).alias("__in"), F.lit(1).alias("__out"))))
    changes = spans.select(*keys, event.alias("e")).select(*keys, "e.*").filter("__day is not null").groupBy(
        *keys, "__day").agg(F.sum("__in").alias("__in"), F.sum("__out").alias("__out"))

    def limit(day: str | None, found: Column) -> Column:
        """A given day, or one of the table's own, as a value that is computed once."""
        return _day_of(day) if day else spans.agg(found.alias("v")).select("v").scalar()

    lo = limit(first_day, F.min("__from"))
    hi = limit(last_day, F.max(F.greatest("__from", "__to")))
    days = changes.select(*keys).distinct().filter(lo <= hi).select(*keys, F.explode(F.sequence(lo, hi)).alias("__day"))
    # what came before the first day counts on it
    old = F.col("__day") < lo
    known = changes.filter((F.col("__day") <= hi) & (lo <= hi)).select(
        *keys, F.greatest(F.col("__day"), lo).alias("__day"), (F.col("__in") - F.col("__out")).alias("__delta"),
        F.when(old, 0).otherwise(F.col("__in")).alias("__in"), F.when(old, 0).otherwise(F.col("__out")).alias("__out"))
    # the days are rows of the same kind without a change: one aggregation instead of a join
    nothing = days.select(*keys, "__day", *[F.lit(0).cast("long").alias(c) for c in ("__delta", "__in", "__out")])
    grid = known.unionByName(nothing).withColumn("__block", F.floor(F.col("__day") / BLOCK_DAYS)).groupBy(
        *keys, "__block", "__day").agg(*[F.sum(c).alias(c) for c in ("__delta", "__in", "__out")])

    inside = Window.partitionBy(*keys, "__block").orderBy("__day").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    running = grid.withColumn("__sum", F.sum("__delta").over(inside)).alias("r")
    offsets = grid.groupBy(*keys, "__block").agg(F.sum("__delta").alias("__total")).select(
        *keys, "__block", F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__offset")).alias("o")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*keys, "__block"]]
    return running.join(offsets, same).select(
        *[F.col(f"r.{k}").alias(c) for c, k in zip(by, keys)], F.date_add(F.lit(EPOCH).cast("date"), F.col("__day")).alias("day"),
        (F.col("__sum") + F.col("__offset")).alias(name), F.col("__in").alias("arrived"), F.col("__out").alias("left"))
