"""Date helpers (F7, F8) and period parameters (H4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed value: day numbers in the arrivals files count from this epoch.
DAY_NUMBER_EPOCH = "1960-01-01"
_MICROS_PER_DAY = 86_400_000_000.0


def day_number_to_iso(c) -> Column:
    """epoch-1960 day number (double) -> ISO date text.

    Null and 0 give null (the source treats 0 as 'no date'); fractional days
    floor; negative days are allowed.  Out-of-range values give null.  As with
    a Python timedelta, the fraction of a day is first rounded (half-even) to
    whole microseconds, so -1e-12 is day 0, not day -1.
    """
    c = as_col(c)
    whole = F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c)).cast("double")
    frac_micros = F.bround((c - whole) * _MICROS_PER_DAY, 0)
    days = (whole + F.floor(frac_micros / _MICROS_PER_DAY)).try_cast("int")
    as_date = F.date_add(F.lit(DAY_NUMBER_EPOCH).cast("date"), days)
    return F.when(c != 0, as_date.cast("string"))


def _as_date(c) -> Column:
    return as_col(c).try_cast("date")


def iso_year(c) -> Column:
    """F8: year of an ISO date text; malformed text -> null."""
    return F.year(_as_date(c))


def iso_month(c) -> Column:
    return F.month(_as_date(c))


def iso_day(c) -> Column:
    return F.dayofmonth(_as_date(c))


def period_key(c) -> Column:
    """H4: ``yyyyMM`` text of a date/timestamp column (e.g. 201601)."""
    return F.date_format(as_col(c), "yyyyMM")


def period_token(c) -> Column:
    """H4: lower-case ``MMMyy`` token used in month file names (e.g. jan16)."""
    return F.lower(F.date_format(as_col(c), "MMMyy"))
