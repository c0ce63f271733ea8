"""Conformed arrivals and the two fact tables built from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.dates import day_number_to_iso
from ..operators.columns import cast_columns, rename
from ..operators.filters import label_filter
from ..operators.joins import coerced_lookup, named_lookup, role_lookup
from ..schemas import IMMIGRANT, IMMIGRATION

ARRIVAL_RENAMES = {"i94yr": "year", "i94mon": "month", "i94port": "port_of_entry",
                   "arrdate": "arrival_date", "depdate": "departure_date", "i94bir": "age"}


def record_period(year: str = "year", month: str = "month") -> Column:
    """Per-row ``yyyyMM`` from the record's own year and month numbers; null without them."""
    y, m = F.col(year).try_cast("int"), F.col(month).try_cast("int")
    return F.when(y.isNotNull() & m.isNotNull(), F.format_string("%04d%02d", y, m))


def decode_arrivals(arrivals: DataFrame) -> DataFrame:
    """Arrival records with dates as ISO text and the stored column names."""
    decoded = arrivals.withColumns({c: day_number_to_iso(c) for c in ("arrdate", "depdate")})
    return rename(decoded, ARRIVAL_RENAMES)


def conform_arrivals(arrivals: DataFrame, modes: DataFrame, visas: DataFrame,
                     states: DataFrame, countries: DataFrame, *, mode_label: str = "Air",
                     period: "str | None" = None) -> DataFrame:
    """Decode dates, look up mode/visa/state/countries, keep one travel mode.

    Every lookup is an inner join against a code table, so records with an unknown or null code are dropped, as in
    the source ETL.  ``period`` stamps ``i94dt``; without it the period comes
    from each record's year and month, which lets one job conform many months.
    """
    df = coerced_lookup(decode_arrivals(arrivals), modes, "i94mode")
    df = label_filter(df, "mode", mode_label)
    df = coerced_lookup(df, visas, "i94visa")
    df = named_lookup(df, states, "i94addr", "state_code", keep_dim_key=True)
    df = role_lookup(df, countries, "i94res", "country_code",
                     {"country_name": "residence_country"})
    df = df.drop("i94visa", "i94mode", "i94addr")
    df = role_lookup(df, countries, "i94cit", "country_code",
                     {"country_name": "birth_country"})
    return df.withColumn("i94dt", F.lit(period) if period else record_period())


# Stored columns that are read from a source column of another name.
READ_FROM = {"birth_year": "biryear", "admnuml": "admnum"}


def _stored_columns(schema: StructType) -> list[tuple[str, str, str]]:
    """(source, type, name) of a stored table's columns."""
    return [(READ_FROM.get(f.name, f.name), f.dataType.simpleString(), f.name) for f in schema]


def build_immigrant(conformed: DataFrame) -> DataFrame:
    """Traveller attributes; stored by i94dt, clustered by visa."""
    return cast_columns(conformed, _stored_columns(IMMIGRANT))


def build_immigration(conformed: DataFrame) -> DataFrame:
    """Arrival events; stored by i94dt, clustered by state_code."""
    return cast_columns(conformed, _stored_columns(IMMIGRATION))
