"""Readers (A1-A6)."""

from .labels import read_labels
from .csv import read_demographics, read_airports, read_weather
from .arrivals import read_arrivals, read_arrival_stream
from .tables import read_table, read_period

__all__ = ["read_labels", "read_demographics", "read_airports", "read_weather",
           "read_arrivals", "read_arrival_stream", "read_table", "read_period"]
