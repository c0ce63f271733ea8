"""The analyst questions the star schema is built for.

All are algebraic aggregates (count / sum / avg / max), so Spark combines them
map-side before the shuffle and a hot key costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.presence import presence_per_day
from ..operators.topk import top_k_per_group


def visitors_by_country(mart: DataFrame, role: str = "residence_country") -> DataFrame:
    """Visitors per residence (or birth) country and period."""
    return mart.groupBy("i94dt", role).agg(F.count(F.lit(1)).alias("visitors"))


def visitors_by_city(mart: DataFrame) -> DataFrame:
    """R2: visitors per arrival city and state and period."""
    return mart.groupBy("i94dt", "city", "state_code").agg(
        F.count(F.lit(1)).alias("visitors"),
        F.countDistinct("airport_code").alias("airports"))


def city_demographics(mart: DataFrame) -> DataFrame:
    """Visitor counts next to the city's population and median age."""
    return mart.groupBy("city", "state_code").agg(
        F.count(F.lit(1)).alias("visitors"),
        F.max(F.col("population").try_cast("long")).alias("population"),
        F.max(F.col("median_age").try_cast("double")).alias("median_age"))


def monthly_temperature(weather: DataFrame) -> DataFrame:
    """Mean temperature per city and calendar month."""
    t = F.col("AverageTemperature").try_cast("double")
    return weather.groupBy("city", "Month").agg(
        F.avg(t).alias("avg_temperature"), F.count(t).alias("readings"))


def traveller_types(mart: DataFrame) -> DataFrame:
    """Visa class x visa type x city, with traveller counts and mean age."""
    return mart.groupBy("visa", "visatype", "city").agg(
        F.count(F.lit(1)).alias("travellers"), F.avg("age").alias("avg_age"))


def top_origins(mart: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` residence countries most visitors of each month and city come from.

    Equal counts: the country first in the alphabet (null first), so the list has
    exactly k rows where a city has as many countries.
    """
    counts = mart.groupBy("i94dt", "city", "residence_country").agg(F.count(F.lit(1)).alias("visitors"))
    return top_k_per_group(counts, ["i94dt", "city"], [F.desc("visitors"), F.asc_nulls_first("residence_country")], k)


def present_by_state(immigration: DataFrame, open_stays: str = "to_last") -> DataFrame:
    """Visitors present in each address state on each day; departures unknown: still present."""
    return presence_per_day(immigration, "arrival_date", "departure_date", ["state_code"], open_stays=open_stays)
