"""Filters and predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the airport filter: country, the excluded type, the text
# some source rows carry instead of an empty IATA code.
US_COUNTRY = "US"
CLOSED_TYPE = "closed"
NULL_TEXT = "null"


def conjunctive_filter(df: DataFrame, *predicates: Column) -> DataFrame:
    """AND of predicates with SQL three-valued logic: a null comparison drops the row."""
    return df.filter(reduce(lambda a, b: a & b, predicates))


def open_us_airports(df: DataFrame, country: str = "iso_country", kind: str = "type",
                     code: str = "iata_code") -> DataFrame:
    """US airports that are not closed and carry an IATA code (text 'null' excluded)."""
    return conjunctive_filter(df, F.col(country) == US_COUNTRY, F.col(kind) != CLOSED_TYPE,
                              F.col(code) != NULL_TEXT)


def equals_filter(df: DataFrame, column: str, value) -> DataFrame:
    """Equality predicate; nulls dropped.  Pushed into the scan by Catalyst."""
    return df.filter(F.col(column) == value)


def label_filter(df: DataFrame, label_column: str, label) -> DataFrame:
    """D3: keep rows whose looked-up label equals ``label``.

    Applied after the lookup join; Catalyst moves it onto the dimension side
    before the broadcast, so the fact is probed against the one matching code.
    """
    return df.filter(F.col(label_column) == label)


def period_filter(df: DataFrame, period: str, column: str = "i94dt") -> DataFrame:
    """Period predicate on the partition column (becomes a PartitionFilter)."""
    return df.filter(F.col(column) == period)
