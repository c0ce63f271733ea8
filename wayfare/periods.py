"""Run periods (H4) and month ranges (H6)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# Fixed value: English month abbreviations used in arrival file names.
_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


@dataclass(frozen=True, order=True)
class Period:
    year: int
    month: int

    @classmethod
    def parse(cls, text: str) -> "Period":
        """Accepts ``yyyyMM`` or ``yyyy-MM``."""
        t = text.replace("-", "")
        return cls(int(t[:4]), int(t[4:6]))

    @classmethod
    def from_token(cls, token: str) -> "Period":
        """``jan16`` -> 2016-01 (two-digit years as in strptime's %y)."""
        d = _dt.datetime.strptime(token.title(), "%b%y")
        return cls(d.year, d.month)

    @property
    def key(self) -> str:
        """``yyyyMM`` partition value, e.g. 201601."""
        return f"{self.year:04d}{self.month:02d}"

    @property
    def token(self) -> str:
        """Lower-case ``MMMyy`` file token, e.g. jan16."""
        return f"{_MONTHS[self.month - 1]}{self.year % 100:02d}"

    @property
    def first_day(self) -> _dt.date:
        return _dt.date(self.year, self.month, 1)

    def next(self) -> "Period":
        return Period(self.year + self.month // 12, self.month % 12 + 1)


def month_range(start: Period | str, end: Period | str) -> list[Period]:
    """Inclusive list of months, e.g. 2016-01 .. 2016-04 -> 4 periods."""
    p = Period.parse(start) if isinstance(start, str) else start
    e = Period.parse(end) if isinstance(end, str) else end
    out = []
    while p <= e:
        out.append(p)
        p = p.next()
    return out
