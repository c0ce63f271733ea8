"""DataFrame -> DataFrame relational steps; column names are arguments."""

from .columns import rename, select_columns, cast_columns, drop_columns, with_period, with_long_copy
from .filters import conjunctive_filter, open_us_airports, equals_filter, label_filter, period_filter
from .joins import (using_join, coerced_lookup, named_lookup, role_lookup,
                    multi_key_join, replace_side_columns)

__all__ = [
    "rename", "select_columns", "cast_columns", "drop_columns", "with_period", "with_long_copy",
    "conjunctive_filter", "open_us_airports", "equals_filter", "label_filter", "period_filter",
    "using_join", "coerced_lookup", "named_lookup", "role_lookup",
    "multi_key_join", "replace_side_columns",
]
