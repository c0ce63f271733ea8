"""Table-building jobs (G1-G12), quality gates (H1-H3), reports (R1-R5), runs (H5-H6)."""

from .dictionary import build_us_state, build_country, build_us_ports, build_mode, build_visa
from .dims import build_weather, build_airports, build_city
from .facts import conform_arrivals, build_immigrant, build_immigration
from .marts import city_of_airport, build_immigration_demographics
from .quality import (periods_present, check_nonempty, publication_check, preview,
                      DataQualityError)
from . import reports

__all__ = [
    "build_us_state", "build_country", "build_us_ports", "build_mode", "build_visa",
    "build_weather", "build_airports", "build_city", "conform_arrivals", "build_immigrant",
    "build_immigration", "city_of_airport", "build_immigration_demographics", "periods_present",
    "check_nonempty", "publication_check", "preview", "DataQualityError", "reports",
]
