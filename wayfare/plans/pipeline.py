"""H5/H6: one-month run in dependency order, and multi-month backfill.

Plain Python orchestration around Spark jobs; any scheduler can call these via
spark-submit.  No driver-side data loops: every step is a distributed job.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Layout, Options
from ..periods import Period, month_range
from ..session import scratch_path
from ..sources.arrivals import read_arrival_months
from ..sinks import published
from ..sinks.parquet import path_exists, write_full, write_period
from ..sources.csv import read_airports, read_demographics, read_weather
from ..sources.labels import read_labels
from ..sources.tables import read_table
from . import dictionary, dims, facts, marts, quality, rejects

CODE_TABLES = ["us_state", "country", "us_ports", "i94mode", "i94visa"]
log = logging.getLogger(__name__)


def run_concurrently(tasks: list, workers: int) -> None:
    """Run independent Spark jobs from a small thread pool (each thread submits
    its own job; the cluster schedules them side by side).  Errors propagate."""
    if workers <= 1 or len(tasks) <= 1:
        for task in tasks:
            task()
        return
    inherit = inheritable_thread_target(SparkSession.getActiveSession())
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        for future in [pool.submit(inherit(t)) for t in tasks]:
            future.result()


def build_code_tables(spark: SparkSession, layout: Layout, options: Options = Options()) -> None:
    """G1-G5 written as full refreshes; ports join the state table just built."""
    states = dictionary.build_us_state(read_labels(spark, layout.label_path("us_state")))
    write_full(states, layout.table("us_state"))
    states = read_table(spark, layout.table("us_state"), "us_state")
    run_concurrently([
        lambda: write_full(dictionary.build_us_ports(
            read_labels(spark, layout.label_path("us_ports")), states, options.lenient_ports),
            layout.table("us_ports")),
        lambda: write_full(dictionary.build_country(
            read_labels(spark, layout.label_path("country"))), layout.table("country")),
        lambda: write_full(dictionary.build_mode(
            read_labels(spark, layout.label_path("i94mode"))), layout.table("i94mode")),
        lambda: write_full(dictionary.build_visa(
            read_labels(spark, layout.label_path("i94visa"))), layout.table("i94visa")),
    ], options.parallel_tables)


def build_dimensions(spark: SparkSession, layout: Layout, options: Options = Options()) -> None:
    """G6-G8, built side by side (they only share the code tables)."""
    ports = read_table(spark, layout.table("us_ports"), "us_ports")
    states = read_table(spark, layout.table("us_state"), "us_state")
    run_concurrently([
        lambda: write_full(dims.build_weather(read_weather(spark, layout.raw(layout.weather_file)),
                                              options.weather_country),
                           layout.table("weather"), partition_by="Month"),
        lambda: write_full(dims.build_airports(read_airports(spark, layout.raw(layout.airports_file)),
                                               ports, options.coord_order),
                           layout.table("airports")),
        lambda: write_full(dims.build_city(read_demographics(spark, layout.raw(layout.demographics_file)),
                                           states, options.distinct_city),
                           layout.table("city")),
    ], options.parallel_tables)


def _code(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    return read_table(spark, layout.table(name), name)


def arrivals_for_periods(spark: SparkSession, layout: Layout, periods: list[Period]) -> DataFrame:
    """All requested month files in one scan; each row is stamped with the
    period of the file it came from (``_metadata.file_path``)."""
    paths = [layout.arrivals_path(p) for p in periods]
    missing = [p.key for p, path in zip(periods, paths) if not path_exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"no arrivals file for {', '.join(missing)} "
                                f"(template {layout.raw(layout.arrivals_template)})")
    df = read_arrival_months(spark, paths, layout.arrivals_format)
    token = F.regexp_extract(F.col("_metadata.file_path"), layout.arrivals_token_regex(), 1)
    mapping = F.create_map(*[x for p in periods for x in (F.lit(p.token), F.lit(p.key))])
    return df.withColumn("__period", mapping[token])


def _staged_arrivals(spark: SparkSession, layout: Layout, periods: list[Period],
                     options: Options) -> tuple[DataFrame, DataFrame | None]:
    """The conformed rows of the months, and with ``keep_rejects`` all records classified; looked up once.

    Several writes read the same rows: they are staged on shared storage.
    """
    arrivals = arrivals_for_periods(spark, layout, periods).withColumnRenamed("__period", "i94dt")
    codes = [_code(spark, layout, name) for name in ("i94mode", "i94visa", "us_state", "country")]
    path = scratch_path(spark, "conformed")
    if not options.keep_rejects:
        found = facts.conform_arrivals(arrivals.withColumnRenamed("i94dt", "__period"), *codes,
                                       mode_label=options.mode_label)
        found = found.withColumn("i94dt", F.col("__period")).drop("__period")
        found.write.partitionBy("i94dt").parquet(path)
        return spark.read.schema(found.schema).parquet(path), None
    found = rejects.classify_arrivals(arrivals, *codes, mode_label=options.mode_label)
    found.withColumn("kept", F.col("rejected_by").isNull()).write.partitionBy("i94dt", "kept").parquet(path)
    classified = spark.read.schema(found.schema.add("kept", "boolean")).parquet(path)
    return rejects.accepted(classified.filter("kept").drop("kept")), classified


def load_facts(spark: SparkSession, layout: Layout, periods: list[Period],
               options: Options = Options(), *, with_mart: bool = False, gate: bool = False,
               target: Callable[[str], str] | None = None) -> None:
    """G9-G11 (and with ``with_mart`` G12) for the given months from one conform;
    reruns replace those months.

    With ``gate`` a month without a row to keep raises before any table is
    touched (H1).  ``target`` says where a table is written (default: the
    layout's place).
    """
    target = target or layout.table
    conformed, classified = _staged_arrivals(spark, layout, periods, options)
    keys = [p.key for p in periods]
    if gate:
        present = {r["i94dt"] for r in conformed.select("i94dt").distinct().collect()}
        quality.require_periods("arrivals to keep", keys, present)
    targets = [("immigrant", facts.build_immigrant(conformed), "visa"),
               ("immigration", facts.build_immigration(conformed), "state_code")]
    if with_mart:
        mart = marts.mart_from_conformed(conformed, _code(spark, layout, "airports"), _code(spark, layout, "city"))
        targets.append(("immigration_demographics", mart, None))
    if classified is not None:
        targets += [("rejected_arrivals", rejects.rejected(classified.filter("not kept")), "rejected_by"),
                    ("arrival_audit", rejects.audit(classified), None)]
    for name, rows, spread in targets:
        write_period(rows, target(name), spread=spread, mode=options.write_mode,
                     salt_buckets=options.salt_buckets, periods=keys)


def load_mart(spark: SparkSession, layout: Layout, periods: list[Period],
              options: Options = Options(), *, target: Callable[[str], str] | None = None) -> None:
    """G12 from the stored tables, pruned to the requested months."""
    target = target or layout.table
    keys = [p.key for p in periods]
    immigration, immigrant = (read_table(spark, target(name), name).filter(F.col("i94dt").isin(keys))
                              for name in ("immigration", "immigrant"))
    mart = marts.build_immigration_demographics(
        immigration, immigrant, _code(spark, layout, "airports"), _code(spark, layout, "city"))
    write_period(mart, target("immigration_demographics"), mode=options.write_mode,
                 salt_buckets=options.salt_buckets, periods=keys)


def reconcile_periods(spark: SparkSession, layout: Layout, periods: list[Period], *,
                      audit: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """Records read = kept + rejected for each month, the read ones counted on the month files again.

    Needs months loaded with ``keep_rejects``; raises where a month does not add up.
    """
    keys = [p.key for p in periods]
    audited = read_table(spark, layout.table("arrival_audit"), "arrival_audit") if audit is None else audit
    read = arrivals_for_periods(spark, layout, periods).groupBy(F.col("__period").alias("i94dt")).agg(
        F.count(F.lit(1)).alias("records"))
    found = rejects.reconcile(audited.filter(F.col("i94dt").isin(keys)), read)
    if strict:
        wrong = [r["i94dt"] for r in found.filter("not balanced").collect()]     # a row per month at most
        if wrong:
            raise quality.DataQualityError(f"records read are not kept + rejected in {', '.join(sorted(wrong))}")
    return found


def check_periods(spark: SparkSession, layout: Layout, periods: list[Period],
                  tables: tuple[str, ...] = ("immigration", "immigrant"),
                  strict: bool = True, target: Callable[[str], str] | None = None) -> DataFrame:
    """H1 for every (table, period) with one aggregation job per table; raises on a gap."""
    keys = [p.key for p in periods]
    target = target or layout.table

    def count(table: str) -> list[tuple]:
        rows = read_table(spark, target(table), table).filter(F.col("i94dt").isin(keys))
        return [(r["i94dt"], r["rows"], table) for r in quality.periods_present(rows).collect()]

    # one small aggregation job per table, run side by side; each returns <= len(keys) rows
    with ThreadPoolExecutor(max_workers=max(1, min(4, len(tables)))) as pool:
        found = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(count), t) for t in tables]]
    for table, rows in zip(tables, found):
        if strict:
            quality.require_periods(table, keys, {key for key, n, _ in rows if n > 0})
        log.info("data quality check passed: %s", table)
    return spark.createDataFrame([r for rows in found for r in rows], "i94dt string, rows long, `table` string")


def run_month(spark: SparkSession, layout: Layout, period: Period | str,
              options: Options = Options(), *, refresh_reference: bool = True) -> DataFrame:
    """H5: codes -> {weather, airports, city} -> arrivals -> mart -> checks."""
    return backfill(spark, layout, period, period, options, refresh_reference=refresh_reference)


def backfill(spark: SparkSession, layout: Layout, start: Period | str, end: Period | str,
             options: Options = Options(), *, refresh_reference: bool = True,
             only: set[str] | None = None) -> DataFrame:
    """H6: a month range as one multi-period run (one scan, one write per table).

    ``only`` leaves out the months of the range that have no file.
    Returns the per-(table, period) row counts of the quality gate.
    """
    periods = [p for p in month_range(start, end) if only is None or p.key in only]
    if refresh_reference:
        build_code_tables(spark, layout, options)
        build_dimensions(spark, layout, options)
    if options.mart_source not in ("conformed", "tables"):
        raise ValueError(f"unknown mart_source {options.mart_source!r}")
    load_facts(spark, layout, periods, options, with_mart=options.mart_source == "conformed",
               gate=options.strict_checks)
    if options.mart_source == "tables":
        load_mart(spark, layout, periods, options)
    tables = {n: layout.table(n) for n in ("weather", "airports", "city", "immigration",
                                              "immigrant")}
    quality.require_published(spark, tables, [p.key for p in periods] if options.strict_checks else None)
    return check_periods(spark, layout, periods, tuple(options.check_tables),
                         strict=options.strict_checks)


#: The tables of a month that are published together.
MONTHLY = ("immigration", "immigrant", "immigration_demographics")


def publish_months(spark: SparkSession, layout: Layout, start: Period | str, end: Period | str,
                   options: Options = Options(), *, refresh_reference: bool = True, only: set[str] | None = None,
                   checks: list[Callable[[Callable[[str], DataFrame]], None]] | None = None) -> published.Manifest:
    """Write, audit, publish: the months of a range change together, and only if they pass.

    The facts and the mart (with ``keep_rejects`` the rejected records and their
    audit too) are written to folders of this run, checked there (H1 for the
    facts and ``options.check_tables``, both facts have as many rows, records add
    up, and ``checks``, which get a function table name -> rows and raise), and
    then published by one manifest.  If anything raises, the run's folders are
    removed and what was published before is still there, byte for byte.
    Readers use ``published.read_published``.
    """
    root, run = layout.published_root(), published.new_run_id()
    periods = [p for p in month_range(start, end) if only is None or p.key in only]
    if refresh_reference:
        build_code_tables(spark, layout, options)
        build_dimensions(spark, layout, options)
    names = [*MONTHLY, *(("rejected_arrivals", "arrival_audit") if options.keep_rejects else ())]
    base = published.read_manifest(spark, root)

    def target(name: str) -> str:
        return published.run_path(root, name, run)

    def written(name: str) -> DataFrame:
        return read_table(spark, target(name), name)

    try:
        load_facts(spark, layout, periods, options, with_mart=options.mart_source == "conformed", gate=True, target=target)
        if options.mart_source == "tables":
            load_mart(spark, layout, periods, options, target=target)
        gated = tuple(dict.fromkeys([*MONTHLY[:2], *options.check_tables]))
        found = check_periods(spark, layout, periods, gated, target=target).collect()
        rows = {(r["table"], r["i94dt"]): r["rows"] for r in found}     # a row per table and month
        uneven = [p.key for p in periods if rows["immigration", p.key] != rows["immigrant", p.key]]
        if uneven:
            raise quality.DataQualityError(f"the facts differ in their rows for {', '.join(uneven)}")
        if options.keep_rejects:
            reconcile_periods(spark, layout, periods, audit=written("arrival_audit"))
        for check in checks or []:
            check(written)
        present = {name: {r["i94dt"] for r in written(name).select("i94dt").distinct().collect()} for name in names}
        return published.publish(spark, root, {
            name: {p.key: run if p.key in present[name] else None for p in periods} for name in names}, base)
    except Exception:
        published.discard_run(spark, root, names, run)
        raise
