"""Temperatures next to visits: the last reading of a city at or before an arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.asof import asof_join


def arrivals_with_temperature(arrivals: DataFrame, weather: DataFrame, *, city: str = "city",
                              date: str = "arrival_date", max_age_days: int | None = None) -> DataFrame:
    """All arrivals with ``temperature``, ``uncertainty`` and ``measured_on`` of their city.

    ``weather`` is the stored table (G6); cities meet in lower case, dates are ISO
    text.  Readings without a temperature are passed over, so the last one that
    was taken counts; of several on a day the highest.  Arrivals without a city,
    a date or a reading before it keep nulls, as do those whose reading is older
    than ``max_age_days``.
    """
    readings = weather.select(
        F.lower("city").alias("__city"), F.col("date").try_cast("date").alias("__date"),
        F.col("AverageTemperature").try_cast("double").alias("temperature"),
        F.col("AverageTemperatureUncertainty").try_cast("double").alias("uncertainty")).filter("temperature is not null")
    asking = arrivals.withColumns({"__city": F.lower(city), "__date": F.col(date).try_cast("date")})
    return asof_join(asking, readings, ["__city"], "__date", columns=["temperature", "uncertainty"],
                     max_age=max_age_days, time_name="measured_on").drop("__city", "__date")
