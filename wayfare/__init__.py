"""wayfare: a Spark-native star-schema builder for monthly visitor-arrival records.

Layout
------
functions/  Column -> Column helpers (built-ins only, no Python UDF)
operators/  DataFrame -> DataFrame relational steps (projections, filters, joins)
sources/    readers (label files, CSV, arrival months, stored tables)
sinks/      writers (full refresh, period-partitioned, idempotent)
plans/      the table-building jobs, quality gates, reports and the monthly run
streaming/  incremental ingest of arrival month files with Structured Streaming
starmap     adapters that map the driver's TPC-H-like tables onto the source shapes
"""

__version__ = "0.1.0"
