"""Incremental ingest of arrival month files with Structured Streaming."""

from .ingest import start_arrivals_ingest, ingest_available

__all__ = ["start_arrivals_ingest", "ingest_available"]
