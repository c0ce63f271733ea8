"""As-of join: each row takes the last reading at or before its own time.

Both sides are put into one sequence per key and sorted by time, and the last
reading is carried forward.  The sequence of a key is cut into time ranges, so
that a key with a third of all rows is many tasks: within a range the last
reading is carried row by row, and what a range starts with is carried over
from the ranges before it in a small table, one row per key and range.

Rows that ask for the same key and time get the same answer, so they are asked
once: the sorted sequence holds distinct (key, time) pairs and not the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, NumericType, StringType

RANGE_DAYS = 32


def _position(df: DataFrame, column: str) -> Column:
    """A time as a number that sorts alike: days of a date, microseconds of a timestamp, a number itself."""
    kind = df.schema[column].dataType
    if isinstance(kind, IntegralType):
        return F.col(column).cast("long")
    if isinstance(kind, NumericType):
        return F.when(~F.isnan(F.col(column).cast("double")), F.col(column).cast("double"))
    if isinstance(kind, DateType):
        return F.datediff(F.col(column), F.lit("1970-01-01").cast("date")).cast("long")
    return F.unix_micros(F.col(column).cast("timestamp"))


def _unit(df: DataFrame, column: str) -> int:
    """Positions in the unit that widths and ages are given in."""
    return 1 if isinstance(df.schema[column].dataType, (DateType, NumericType)) else 1_000_000


def asof_join(left: DataFrame, right: DataFrame, by: list[str], on: str, *, right_on: str | None = None,
              columns: list[str] | None = None, how: str = "left", max_age: float | None = None,
              range_width: float | None = None, time_name: str | None = None) -> DataFrame:
    """Each left row with the ``columns`` of the right row of its key that is last at or before it.

    ``by`` are key columns of both sides, ``on`` (right: ``right_on``) the time:
    a date, a timestamp or a number; text is refused.  ``columns`` default to all
    other columns of the right side; ``time_name`` adds the time of the reading
    under that name.  ``how="inner"`` drops left rows without a reading, ``left``
    keeps them with nulls.  ``max_age`` (days, seconds or the number's unit)
    takes no older reading.  Of several readings of one key and time the one with
    the largest values counts, compared column by column in the given order,
    nulls smallest.

    Null keys and times match nothing; such readings are ignored.  Repeated left
    rows each get the answer.  Empty sides are fine.  ``range_width`` (same unit)
    sets how much time of a key one task sorts: 32 days by default.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unknown how {how!r}")
    right_on = right_on or on
    for df, column in ((left, on), (right, right_on)):
        if isinstance(df.schema[column].dataType, StringType):
            raise ValueError(f"{column} is text; cast it to a date or timestamp first")
    if columns is None:
        columns = [c for c in right.columns if c not in (*by, right_on)]
    added = [*columns, *([time_name] if time_name else [])]
    clash = {c.lower() for c in left.columns} & {c.lower() for c in added}
    if clash:
        raise ValueError(f"as-of join would duplicate columns {sorted(clash)}; rename one side first")
    unit = _unit(left, on)
    if unit != _unit(right, right_on) or isinstance(left.schema[on].dataType, DateType) != isinstance(
            right.schema[right_on].dataType, DateType):
        raise ValueError(f"{on} and {right_on} are not of one kind of time; cast one of them")
    days = RANGE_DAYS if unit == 1 else RANGE_DAYS * 86400
    width = float(days if range_width is None else range_width) * unit
    keys = [f"__k{i}" for i in range(len(by))]

    def placed(df: DataFrame, time: str, *more: Column) -> DataFrame:
        at = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], _position(df, time).alias("__t"), *more)
        return at.dropna(subset=[*keys, "__t"])

    reading = F.struct(*[F.col(c) for c in columns], F.col(right_on).alias("__time")).alias("__reading")
    readings = placed(right, right_on, reading).groupBy(*keys, "__t").agg(F.max("__reading").alias("__reading"))
    asked = placed(left, on).distinct()
    both = (asked.withColumn("__reading", F.lit(None).cast(readings.schema["__reading"].dataType)).withColumn("__asked", F.lit(True))
            .unionByName(readings.withColumn("__asked", F.lit(False)))
            .withColumn("__range", F.floor(F.col("__t") / width)))
    stamped = both.withColumn("__last", F.when(~F.col("__asked"), F.struct("__t", "__reading")))
    # a reading of the same time counts: readings sort before what is asked
    within = Window.partitionBy(*keys, "__range").orderBy("__t", "__asked").rowsBetween(Window.unboundedPreceding, 0)
    sequence = stamped.withColumn("__last", F.last("__last", ignorenulls=True).over(within)).filter("__asked")
    # what each range starts with: a row per key and range that has anything in it
    ends = stamped.groupBy(*keys, "__range").agg(F.max("__last").alias("__end"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*keys, "__range", F.last("__end", ignorenulls=True).over(before).alias("__carry"))
    answered = sequence.join(carry, [*keys, "__range"]).withColumn("__last", F.coalesce("__last", "__carry")).filter(
        F.col("__last").isNotNull())
    if max_age is not None:
        answered = answered.filter(F.col("__t") - F.col("__last.__t") <= float(max_age) * unit)
    answers = answered.select(*keys, "__t", F.col("__last.__reading").alias("__reading"))
    asking = left.withColumns({"__at": _position(left, on), **{k: F.col(c) for k, c in zip(keys, by)}})
    joined = asking.join(answers.withColumnRenamed("__t", "__at"), [*keys, "__at"], how)
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"__reading.`{c}`").alias(c) for c in columns],
                         *([F.col("__reading.__time").alias(time_name)] if time_name else []))
