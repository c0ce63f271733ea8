"""Arrivals joined to the demographics of the arrival city."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import using_join
from ..schemas import IMMIGRANT, IMMIGRATION_DEMOGRAPHICS

# The mart's columns, as stored.
MART_COLUMNS = IMMIGRATION_DEMOGRAPHICS.fieldNames()
RECORD_KEY = ["cicid", "i94dt"]
TRAVELLER_COLUMNS = [c for c in MART_COLUMNS if c in IMMIGRANT.fieldNames()]


def city_of_airport(airports: DataFrame, city: DataFrame) -> DataFrame:
    """What the mart says of an airport: its name, and its city with demographics.

    Airports and cities meet on city (in lower case), state code and state
    name; the state columns are left out, so that the mart's are the
    traveller's address state (E6).
    """
    place = airports.select("airport_code", "name", F.lower("city").alias("city"), "state_code", "state_name")
    return using_join(place, city, ["city", "state_code", "state_name"]).select(
        "airport_code", "name", "city", "population", "median_age")


def build_immigration_demographics(immigration: DataFrame, immigrant: DataFrame,
                                   airports: DataFrame, city: DataFrame, *,
                                   period: str | None = None) -> DataFrame:
    """G12 (flagship).  Arrival events at a known airport city, with the traveller.

    Events and travellers meet on (cicid, i94dt): a record id that occurs twice
    in a month gives every pairing, as the stored tables imply.
    """
    if period is not None:
        immigration = immigration.filter(F.col("i94dt") == period)
        immigrant = immigrant.filter(F.col("i94dt") == period)
    places = city_of_airport(airports, city)
    events = immigration.join(places, immigration["port_of_entry"] == places["airport_code"])
    events = events.select(*RECORD_KEY, *[c for c in MART_COLUMNS if c not in TRAVELLER_COLUMNS])
    return using_join(immigrant.select(*TRAVELLER_COLUMNS), events, RECORD_KEY).select(*MART_COLUMNS)


def mart_from_conformed(conformed: DataFrame, airports: DataFrame, city: DataFrame) -> DataFrame:
    """G12 in one pass over the conformed arrivals, where cicid is unique within a month.

    Both facts are projections of the same conformed record; when cicid
    identifies it, the mart can be read off the conformed rows with one lookup.
    Where ids repeat, use ``build_immigration_demographics``, the default.
    """
    places = city_of_airport(airports, city)
    # the fact-table join on cicid can never match a cicid that is not a valid int
    records = conformed.filter(F.col("cicid").try_cast("int").isNotNull())
    whole = records.drop("city", "name").join(places, records["port_of_entry"] == places["airport_code"])
    return whole.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in ("cicid", "age")
                          else F.col(f.name) for f in IMMIGRATION_DEMOGRAPHICS])
