"""Coordinate and region parsing."""

from __future__ import annotations

from pyspark.sql import Column

from .text import split_item, strip_ws


def coord_first(c) -> Column:
    """text before the first comma, as double; null/malformed -> null."""
    return split_item(strip_ws(c), ",", 0, 2).try_cast("double")


def coord_second(c) -> Column:
    """text after the first comma, as double; missing/malformed -> null."""
    return split_item(strip_ws(c), ",", 1, 2).try_cast("double")


def region_state(c) -> Column:
    """``US-PA`` -> ``PA`` (text after the first dash); no dash -> null."""
    return split_item(strip_ws(c), "-", 1, 2)
