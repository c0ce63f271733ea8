"""Reports kept up to date by month.

A run stores what its months contribute to each report: counts, sums and maxima
by month and group, a small table per report.  A month that is run again
replaces its own part, and reports are merged from the parts, so neither reads
another month of the mart.  (Counts and sums could be kept as one total from
which the old part is taken away; a maximum could not, so parts are kept and
merged when a report is read.)  Temperatures have no run month: their part is by
calendar month and is stored with the weather table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.parquet import write_full, write_period


def _visitors(mart: DataFrame, *by: str) -> DataFrame:
    return mart.groupBy("i94dt", *by).agg(F.count(F.lit(1)).alias("visitors"))


def _origins(mart: DataFrame) -> DataFrame:
    return _visitors(mart, "residence_country")


def _cities(mart: DataFrame) -> DataFrame:
    return mart.groupBy("i94dt", "city", "state_code").agg(
        F.count(F.lit(1)).alias("visitors"), F.count_distinct("airport_code").alias("airports"),
        F.max(F.col("population").try_cast("long")).alias("population"),
        F.max(F.col("median_age").try_cast("double")).alias("median_age"))


def _types(mart: DataFrame) -> DataFrame:
    return mart.groupBy("i94dt", "visa", "visatype", "city").agg(
        F.count(F.lit(1)).alias("travellers"), F.sum("age").alias("age_sum"), F.count("age").alias("ages"))


PARTS: dict[str, Callable[[DataFrame], DataFrame]] = {"origins": _origins, "cities": _cities, "types": _types}
SCHEMAS = {
    "origins": "residence_country string, visitors long, i94dt string",
    "cities": "city string, state_code string, visitors long, airports long, population long, median_age double, i94dt string",
    "types": "visa string, visatype string, city string, travellers long, age_sum long, ages long, i94dt string",
    "temperatures": "city string, Month int, total double, readings long",
}


def _part(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/report_{name}"


def store_parts(mart: DataFrame, root: str, periods: list[str]) -> None:
    """Replace the parts of these months (a month without a row has none); only they are read from the mart."""
    own = mart.filter(F.col("i94dt").isin(periods))
    for name, build in PARTS.items():
        columns = [c.strip().split(" ")[0] for c in SCHEMAS[name].split(",")]
        write_period(build(own).select(*columns), _part(root, name), periods=periods)


def store_temperature_part(weather: DataFrame, root: str) -> None:
    t = F.col("AverageTemperature").try_cast("double")
    write_full(weather.groupBy("city", "Month").agg(F.sum(t).alias("total"), F.count(t).alias("readings")),
               _part(root, "temperatures"))


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(_part(root, name))


def visitors_by_country(spark: SparkSession, root: str) -> DataFrame:
    """R1 from its parts."""
    return _read(spark, root, "origins").select("i94dt", "residence_country", "visitors")


def visitors_by_city(spark: SparkSession, root: str) -> DataFrame:
    """R2 from its parts."""
    return _read(spark, root, "cities").select("i94dt", "city", "state_code", "visitors", "airports")


def city_demographics(spark: SparkSession, root: str) -> DataFrame:
    """R3 from its parts."""
    return _read(spark, root, "cities").groupBy("city", "state_code").agg(
        F.sum("visitors").alias("visitors"), F.max("population").alias("population"), F.max("median_age").alias("median_age"))


def monthly_temperature(spark: SparkSession, root: str) -> DataFrame:
    """R4 from its part."""
    return _read(spark, root, "temperatures").select(
        "city", "Month", (F.col("total") / F.when(F.col("readings") > 0, F.col("readings"))).alias("avg_temperature"), "readings")


def traveller_types(spark: SparkSession, root: str) -> DataFrame:
    """R5 from its parts."""
    return _read(spark, root, "types").groupBy("visa", "visatype", "city").agg(
        F.sum("travellers").alias("travellers"),
        (F.sum("age_sum") / F.when(F.sum("ages") > 0, F.sum("ages"))).alias("avg_age"))
