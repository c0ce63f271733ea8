"""Column -> Column helpers.  Every helper is a composition of Spark built-ins,
so it stays inside whole-stage code generation."""

from .text import (strip_quotes, keep_class, invalid_labels, trim_spaces, strip_ws,
                   split_item, lower_untabbed, lower_trimmed, capitalise, text_key_as_double)
from .dates import day_number_to_iso, iso_year, iso_month, iso_day, period_key, period_token
from .geo import coord_first, coord_second, region_state

__all__ = [
    "strip_quotes", "keep_class", "invalid_labels", "trim_spaces", "strip_ws", "split_item",
    "lower_untabbed", "lower_trimmed", "capitalise", "text_key_as_double",
    "day_number_to_iso", "iso_year", "iso_month", "iso_day", "period_key", "period_token",
    "coord_first", "coord_second", "region_state",
]
