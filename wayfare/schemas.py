"""Explicit schemas for every source (§1.4) and the stored tables (§1.5)."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)


def _struct(spec: list[tuple[str, object]]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in spec])


S, D, I, L = StringType(), DoubleType(), IntegerType(), LongType()

LABELS = _struct([("raw_code", S), ("raw_label", S)])

WEATHER_COLUMNS = ["dt", "AverageTemperature", "AverageTemperatureUncertainty", "City",
                   "Country", "Latitude", "Longitude"]
AIRPORT_COLUMNS = ["ident", "type", "name", "elevation_ft", "continent", "iso_country",
                   "iso_region", "municipality", "gps_code", "iata_code", "local_code",
                   "coordinates"]
DEMOGRAPHIC_COLUMNS = ["City", "State", "Median Age", "Male Population", "Female Population",
                       "Total Population", "Number of Veterans", "Foreign-born",
                       "Average Household Size", "State Code", "Race", "Count"]

ARRIVAL_DOUBLES = ["cicid", "i94yr", "i94mon", "i94cit", "i94res", "arrdate", "i94mode",
                   "depdate", "i94bir", "i94visa", "biryear", "admnum"]
ARRIVAL_ORDER = ["cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode",
                 "i94addr", "depdate", "i94bir", "i94visa", "dtadfile", "visapost", "occup",
                 "entdepa", "entdepd", "entdepu", "matflag", "biryear", "dtaddto", "gender",
                 "insnum", "airline", "admnum", "fltno", "visatype"]
ARRIVALS = _struct([(c, D if c in ARRIVAL_DOUBLES else S) for c in ARRIVAL_ORDER])

US_STATE = _struct([("state_code", S), ("state_name", S)])
COUNTRY = _struct([("country_code", S), ("country_name", S)])
US_PORTS = _struct([("state_code", S), ("port_code", S), ("city", S), ("state_name", S)])
I94MODE = _struct([("i94mode", S), ("mode", S)])
I94VISA = _struct([("i94visa", S), ("visa", S)])
WEATHER = _struct([("date", S), ("Year", I), ("DayOfMonth", I), ("AverageTemperature", S),
                   ("AverageTemperatureUncertainty", S), ("city", S), ("Latitude", S),
                   ("Longitude", S), ("Month", I)])
AIRPORTS = _struct([("airport_code", S), ("ident", S), ("type", S), ("name", S), ("gps_code", S),
                    ("local_code", S), ("latitude", D), ("longitude", D), ("state_code", S),
                    ("city", S), ("state_name", S)])
CITY = _struct([("state_code", S), ("city", S), ("median_age", S), ("population", S),
                ("state_name", S)])
IMMIGRANT = _struct([("cicid", I), ("age", I), ("occup", S), ("birth_year", I),
                     ("birth_country", S), ("residence_country", S), ("gender", S),
                     ("visapost", S), ("visa", S), ("visatype", S), ("i94dt", S)])
IMMIGRATION = _struct([("cicid", I), ("year", I), ("month", I), ("port_of_entry", S),
                       ("arrival_date", S), ("departure_date", S), ("dtadfile", S),
                       ("entdepa", S), ("entdepd", S), ("entdepu", S), ("matflag", S),
                       ("dtaddto", S), ("insnum", S), ("airline", S), ("admnum", D),
                       ("admnuml", L), ("fltno", S), ("state_code", S), ("state_name", S),
                       ("i94dt", S)])
IMMIGRATION_DEMOGRAPHICS = _struct([
    ("cicid", I), ("age", I), ("birth_country", S), ("residence_country", S), ("gender", S),
    ("visatype", S), ("visa", S), ("arrival_date", S), ("departure_date", S),
    ("airport_code", S), ("name", S), ("city", S), ("state_code", S), ("state_name", S),
    ("population", S), ("median_age", S), ("i94dt", S)])

# Column names, order and types of each stored table and source above.
# Stored layout of each processed table (partition column last).
STORED = {
    "us_state": US_STATE, "country": COUNTRY, "us_ports": US_PORTS, "i94mode": I94MODE,
    "i94visa": I94VISA, "weather": WEATHER, "airports": AIRPORTS, "city": CITY,
    "immigrant": IMMIGRANT, "immigration": IMMIGRATION,
    "immigration_demographics": IMMIGRATION_DEMOGRAPHICS,
}

# Tables that a run stores only when asked to (``Options.keep_rejects``).
AUDIT = {
    "rejected_arrivals": _struct([*[(f.name, f.dataType) for f in ARRIVALS], ("rejected_by", S), ("i94dt", S)]),
    "arrival_audit": _struct([("rejected_by", S), ("records", L), ("rows", L), ("i94dt", S)]),
}
