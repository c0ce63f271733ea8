"""Weather, airports and city dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_day, iso_month, iso_year
from ..functions.geo import coord_first, coord_second
from ..functions.text import capitalise, lower_trimmed, lower_untabbed
from ..operators.filters import equals_filter, open_us_airports
from ..operators.joins import using_join
from ..schemas import AIRPORTS, CITY, US_PORTS


def build_weather(raw: DataFrame, country: str = "United States") -> DataFrame:
    """One country's city temperatures with calendar parts; stored by Month."""
    us = equals_filter(raw, "Country", country)
    return us.select(
        F.col("dt").alias("date"),
        iso_year("dt").alias("Year"),
        iso_month("dt").alias("Month"),
        iso_day("dt").alias("DayOfMonth"),
        "AverageTemperature", "AverageTemperatureUncertainty",
        capitalise("City").alias("city"),
        "Latitude", "Longitude")


def build_airports(raw: DataFrame, us_ports: DataFrame, coord_order: str = "lat_lon") -> DataFrame:
    """Open US airports with an IATA code that is a known port of entry.

    Coordinates ``"a, b"`` give latitude=a, longitude=b (positional, the
    default); ``coord_order="lon_lat"`` reads them the other way round, for
    files that store longitude first.  The city and state come from the port
    table (tabs removed, lower-cased).
    """
    if coord_order not in ("lat_lon", "lon_lat"):
        raise ValueError(f"unknown coord_order {coord_order!r}")
    first, second = coord_first("coordinates"), coord_second("coordinates")
    lat, lon = (first, second) if coord_order == "lat_lon" else (second, first)
    derived = {"airport_code": F.col("iata_code"), "latitude": lat, "longitude": lon}
    from_file = [derived.get(c, F.col(c)).alias(c) for c in AIRPORTS.names if c not in US_PORTS.names]
    ports = us_ports.select(F.col("port_code").alias("airport_code"), "state_code",
                            lower_untabbed("city").alias("city"), "state_name")
    return using_join(open_us_airports(raw).select(*from_file), ports, "airport_code").select(*AIRPORTS.names)


def build_city(raw: DataFrame, us_state: DataFrame, distinct: bool = False) -> DataFrame:
    """(state_code, city, median_age, population, state_name).

    Not de-duplicated by default: the public file has one row per city and
    race, and the mart multiplies accordingly; ``distinct=True`` keeps the one
    with the smallest median age, then population (as text).
    """
    # Header names of the public file.
    headers = {"state_code": "State Code", "city": "City", "median_age": "Median Age", "population": "Total Population"}
    d = raw.select(*[F.col(header).alias(name) for name, header in headers.items()])
    d = using_join(d.withColumn("city", lower_trimmed("city")), us_state, "state_code").select(*CITY.names)
    if distinct:
        smallest = F.min(F.struct("median_age", "population", "state_name")).alias("kept")
        d = d.groupBy("state_code", "city").agg(smallest).select(
            "state_code", "city", "kept.median_age", "kept.population", "kept.state_name")
    return d
