"""Code tables from label files.

Input of every job is the label scan (raw_code, raw_label); output columns and
order follow the stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (ALNUM, LETTERS, UPPER, invalid_labels, keep_class, split_item,
                              strip_quotes, trim_spaces)
from ..operators.joins import using_join


def build_us_state(raw: DataFrame) -> DataFrame:
    """G1: (state_code, state_name).  Code keeps A-Z only, so '99' becomes ''."""
    return raw.select(keep_class("raw_code", UPPER).alias("state_code"),
                      trim_spaces(strip_quotes("raw_label")).alias("state_name"))


def build_country(raw: DataFrame) -> DataFrame:
    """(country_code, country_name); unusable labels become INVALID, rows kept."""
    return raw.select(trim_spaces("raw_code").alias("country_code"),
                      invalid_labels(trim_spaces(strip_quotes("raw_label"))).alias("country_name"))


def build_us_ports(raw: DataFrame, us_state: DataFrame, lenient: bool = False) -> DataFrame:
    """(state_code, port_code, city, state_name) for ports in a known state.

    The label is ``CITY, ST``: item 0 of the comma split is the city (blank-
    trimmed only, a leading tab stays), item 1 reduced to A-Z is the state.
    Labels without a comma have no state and drop out in the state join, as do
    labels such as ``X, AL (BPS)``.  ``lenient=True`` instead takes the last
    two-letter word of the label as the state (``X, AL (BPS)`` -> AL,
    ``MARIPOSA AZ`` -> AZ).
    """
    label = strip_quotes("raw_label")
    if lenient:
        last_pair = F.regexp_extract(label, r".*\b([A-Z]{2})\b", 1)
        state = F.when(last_pair != "", last_pair)
    else:
        state = keep_class(split_item(label, ",", 1), UPPER)
    ports = raw.select(
        keep_class(strip_quotes("raw_code"), UPPER).alias("port_code"),
        trim_spaces(split_item(label, ",", 0)).alias("city"),
        state.alias("state_code"))
    return using_join(ports, us_state, "state_code").select(
        "state_code", "port_code", "city", "state_name")


def build_mode(raw: DataFrame) -> DataFrame:
    """(i94mode, mode); the code text is kept untrimmed, the label keeps letters only."""
    return raw.select(strip_quotes("raw_code").alias("i94mode"),
                      keep_class(strip_quotes("raw_label"), LETTERS).alias("mode"))


def build_visa(raw: DataFrame) -> DataFrame:
    """(i94visa, visa); the label keeps letters and digits."""
    return raw.select(strip_quotes("raw_code").alias("i94visa"),
                      keep_class(strip_quotes("raw_label"), ALNUM).alias("visa"))

