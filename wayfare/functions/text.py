"""String cleaning helpers for label files and CSV text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# The character classes the code tables keep, and the pattern
# that collapses unusable country labels into the single label INVALID.
UPPER = "A-Z"
LETTERS = "A-Za-z"
ALNUM = "A-Za-z0-9"
INVALID_COUNTRY_PATTERN = r"^INVALID.*|Collapsed.*|No\ Country.*"
INVALID_LABEL = "INVALID"


def strip_quotes(c) -> Column:
    """remove every apostrophe (inner ones too)."""
    return F.regexp_replace(as_col(c), "'", "")


def keep_class(c, char_class: str) -> Column:
    """keep only characters of ``char_class``; may yield '' (never null for non-null input)."""
    return F.regexp_replace(as_col(c), f"[^{char_class}]", "")


def invalid_labels(c) -> Column:
    """relabel unusable country names as INVALID (rows are kept)."""
    return F.regexp_replace(as_col(c), INVALID_COUNTRY_PATTERN, INVALID_LABEL)


def trim_spaces(c) -> Column:
    """trim blanks (0x20) at both ends only; a leading tab survives."""
    return F.trim(as_col(c))


def strip_ws(c) -> Column:
    """Trim all leading/trailing whitespace (tabs and newlines too), like Python's str.strip()."""
    return F.regexp_replace(as_col(c), r"^\s+|\s+$", "")


def split_item(c, sep: str, index: int, limit: int = -1) -> Column:
    """item ``index`` of ``split(c, sep)``; null when out of range (never raises)."""
    return F.get(F.split(as_col(c), sep, limit), index)


def lower_untabbed(c) -> Column:
    """drop tabs, then lower-case."""
    return F.lower(F.regexp_replace(as_col(c), "\t", ""))


def lower_trimmed(c) -> Column:
    """trim blanks, then lower-case."""
    return F.lower(F.trim(as_col(c)))


def capitalise(c) -> Column:
    """first character upper-case, all others lower-case (not initcap)."""
    c = as_col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def text_key_as_double(c) -> Column:
    """E2 key normalisation: text such as '\\t1 ' -> 1.0; malformed text -> null."""
    return strip_ws(c).try_cast("double")
