"""Storage layout and fidelity options."""

from __future__ import annotations

from dataclasses import dataclass, field

from .periods import Period

# Default names of the five label files in the raw landing zone (configurable).
DEFAULT_LABEL_FILES = {
    "us_state": "states.txt",
    "country": "countries.txt",
    "us_ports": "ports.txt",
    "i94mode": "modes.txt",
    "i94visa": "visas.txt",
}
CODE_TABLES = tuple(DEFAULT_LABEL_FILES)


@dataclass(frozen=True)
class Layout:
    """Where raw inputs live and where processed tables are written.

    Every raw location is relative to ``raw_root`` and can be overridden; the
    arrivals template must contain ``{token}`` (lower-case ``MMMyy``).
    """

    raw_root: str
    processed_root: str
    arrivals_template: str = "arrivals/i94_{token}_sub.parquet"
    arrivals_format: str = "parquet"      # or "csv" (header row, explicit schema)
    weather_file: str = "weather/temperatures_by_city.csv"
    airports_file: str = "airports/airport_codes.csv"
    demographics_file: str = "demographics/us_cities_demographics.csv"
    label_files: dict = field(default_factory=lambda: dict(DEFAULT_LABEL_FILES))

    def label_path(self, table: str) -> str:
        return f"{self.raw_root.rstrip('/')}/codes/{self.label_files[table]}"

    def raw(self, relative: str) -> str:
        return f"{self.raw_root.rstrip('/')}/{relative}"

    def arrivals_path(self, period: Period) -> str:
        return self.raw(self.arrivals_template.format(token=period.token, key=period.key))

    def arrivals_token_regex(self) -> str:
        """Regex whose group 1 is the period token inside an arrivals file path."""
        import re
        pre, _, post = self.arrivals_template.partition("{token}")
        # anchored to whole path segments, so no other folder name can match
        return (r"(?:^|/)" + re.escape(pre.split("/")[-1]) + r"([a-z]{3}[0-9]{2})"
                + re.escape(post.split("/")[0]) + r"(?:/|$)")

    def published_root(self) -> str:
        return f"{self.processed_root.rstrip('/')}/published"

    def table(self, name: str) -> str:
        sub = "codes/" if name in CODE_TABLES else ""
        return f"{self.processed_root.rstrip('/')}/{sub}{name}"


@dataclass(frozen=True)
class Options:
    """Behaviour switches.  Defaults reproduce the source ETL's results except
    where it crashes or corrupts (see README, fidelity decisions)."""

    mode_label: str = "Air"
    weather_country: str = "United States"
    write_mode: str = "dynamic"          # "dynamic" (idempotent reruns) or "append"
    distinct_city: bool = False           # Q6: keep city x race fan-out by default
    lenient_ports: bool = False           # Q1: last two-letter word as the port state
    coord_order: str = "lat_lon"          # F11: positional coordinate order
    parallel_tables: int = 3              # independent tables built concurrently
    salt_buckets: int | None = None       # explicit write salt where AQE is off
    check_tables: tuple = ("immigration", "immigrant")  # H1 tables; add the mart to gate it too
    strict_checks: bool = True            # H1: raise on a period without rows (else report)
    keep_rejects: bool = False            # store dropped records with the lookup that dropped them
    # "tables": re-read the stored facts and join them on (cicid, i94dt), as the
    # source ETL does.  "conformed": write the mart in the same pass as the facts
    # (no fact x fact join), where cicid is known to identify a record in a month.
    mart_source: str = "tables"
