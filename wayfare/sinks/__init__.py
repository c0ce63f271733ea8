"""Writers (B1-B3)."""

from .parquet import write_full, write_period, SUCCESS_MARKER

__all__ = ["write_full", "write_period", "SUCCESS_MARKER"]
