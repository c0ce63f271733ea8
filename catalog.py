"""

Each callable takes (spark, sf_dir) and returns a DataFrame.  Queries that
exercise a reader or writer first write their input below the session's
shared checkpoint folder, then read it back with the operator under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import starmap as sm
from wayfare.functions import dates, geo, text
from wayfare.operators import columns as C
from wayfare.operators import filters as D
from wayfare.operators import joins as E
from wayfare.operators.deliveries import compare_deliveries
from wayfare.operators.totals import grouped_totals, rollup_sets
from wayfare.periods import Period, month_range
from wayfare.plans import (dictionary, dims, facts, marts, pipeline, quality, rejects, report_parts, reports, sketches,
                           temperature)
from wayfare.session import scratch_path
from wayfare.sinks import published
from wayfare.sinks.parquet import write_full, write_period
from wayfare.sources.csv import read_airports, read_demographics
from wayfare.sources.labels import read_labels
from wayfare.sources.tables import read_period, read_table

# The analog month used by the single-period queries.
PERIOD = Period(1997, 1)


# ------------------------------------------------------------------ helpers
def _codes(spark, sf, *names):
    """G1-G5, or the named ones, as plans over the derived label lines."""
    return sm.code_tables(spark, sf, *names)


# Tables that a run has stored, by session and data folder.
_STORED: dict = {}


def _stored_codes(spark, sf):
    """G1-G5 as a run has stored them: written once per session and data folder, read back."""
    key = (spark.sparkContext.applicationId, sf, "codes")
    if key not in _STORED:
        built = sm.code_tables(spark, sf)
        paths = {name: scratch_path(spark, name) for name in built}
        pipeline.run_concurrently([lambda n=n, df=df: write_full(df, paths[n]) for n, df in built.items()], 4)
        _STORED[key] = paths
    return {name: read_table(spark, path, name) for name, path in _STORED[key].items()}


def _conformed(spark, sf, codes=None) -> DataFrame:
    c = codes or _stored_codes(spark, sf)
    return facts.conform_arrivals(sm.arrivals(spark, sf), c["i94mode"], c["i94visa"],
                                  c["us_state"], c["country"], mode_label=sm.MODE_LABEL)


def _airports(spark, sf, codes=None):
    (supplier,) = sm.tables(spark, sf, "supplier")
    return dims.build_airports(sm.airport_rows(supplier), (codes or _codes(spark, sf, "us_ports"))["us_ports"])


def _city(spark, sf, codes=None, **options):
    (supplier,) = sm.tables(spark, sf, "supplier")
    return dims.build_city(sm.demographic_rows(supplier), (codes or _codes(spark, sf, "us_state"))["us_state"], **options)


def _dims(spark, sf, codes=None):
    return _airports(spark, sf, codes), _city(spark, sf, codes)


def _joined_mart(spark, sf, conformed, codes) -> DataFrame:
    """The default path: both facts, joined back on (cicid, i94dt)."""
    airports, city = _dims(spark, sf, codes)
    return marts.build_immigration_demographics(facts.build_immigration(conformed),
                                                facts.build_immigrant(conformed), airports, city)


def _stored_mart(spark, sf) -> DataFrame:
    """The mart as a run has stored it: written once per session and data folder, reports read what they need."""
    key = (spark.sparkContext.applicationId, sf, "mart")
    if key not in _STORED:
        codes = _stored_codes(spark, sf)
        airports, city = _dims(spark, sf, codes)
        path = scratch_path(spark, "mart")
        write_period(marts.mart_from_conformed(_conformed(spark, sf, codes), airports, city), path)
        _STORED[key] = path
    return read_table(spark, _STORED[key], "immigration_demographics")


def _written_immigration(spark, sf) -> str:
    path = scratch_path(spark, "immigration")
    write_period(facts.build_immigration(_conformed(spark, sf)), path, spread="state_code")
    return path


# ------------------------------------------------------------- A: sources
def label_scan(spark, sf):
    (customer,) = sm.tables(spark, sf, "customer")
    path = scratch_path(spark, "labels")
    sm.write_lines(sm.customer_labels(customer), path)
    raw = read_labels(spark, path)
    return raw.select(text.trim_spaces("raw_code").alias("code"),
                      text.trim_spaces(text.strip_quotes("raw_label")).alias("label"))


def csv_semicolon_scan(spark, sf):
    (supplier,) = sm.tables(spark, sf, "supplier")
    path = scratch_path(spark, "demographics")
    sm.write_csv(sm.demographic_rows(supplier), path, ";")
    d = read_demographics(spark, path)
    return d.select(F.col("City").alias("city"), F.col("State Code").alias("state_code"),
                    F.col("Median Age").alias("median_age"),
                    F.col("Total Population").alias("population"), F.col("Race").alias("race"))


def csv_comma_scan(spark, sf):
    (supplier,) = sm.tables(spark, sf, "supplier")
    path = scratch_path(spark, "airports")
    sm.write_csv(sm.airport_rows(supplier), path, ",")
    return read_airports(spark, path).select(
        "ident", "type", "iso_country", "iata_code",
        geo.coord_first("coordinates").alias("latitude"),
        geo.coord_second("coordinates").alias("longitude"))


def period_source(spark, sf):
    """A4: every month file addressed through the path template, one scan."""
    root = scratch_path(spark, "landing")
    layout = sm.analog_layout(root)
    sm.write_arrival_months(sm.arrivals(spark, sf), layout)
    lo, hi = sm.arrival_months(spark, sf)
    from wayfare.periods import month_range
    df = pipeline.arrivals_for_periods(spark, layout, month_range(lo, hi))
    return df.select(F.col("cicid").cast("long").alias("cicid"), F.col("__period").alias("i94dt"),
                     "i94port", "arrdate")


def table_scan(spark, sf):
    """A5 (+B3): the period-partitioned immigration table read back whole."""
    return read_table(spark, _written_immigration(spark, sf), "immigration")


def period_pruned_read(spark, sf):
    """One month read from the partitioned table (PartitionFilters)."""
    return read_period(spark, _written_immigration(spark, sf), PERIOD.key, "immigration")


# --------------------------------------------------------------- B: sinks
def full_refresh(spark, sf):
    (part,) = sm.tables(spark, sf, "part")
    path = scratch_path(spark, "part")
    write_full(part, path)
    write_full(part, path)  # a second refresh replaces, never adds
    return spark.read.parquet(path)


def partitioned_refresh(spark, sf):
    (orders,) = sm.tables(spark, sf, "orders")
    path = scratch_path(spark, "weather")
    weather = dims.build_weather(sm.weather_rows(orders))
    write_full(weather, path, partition_by="Month")
    write_full(weather, path, partition_by="Month")
    return read_table(spark, path, "weather")


def period_rerun(spark, sf):
    path = scratch_path(spark, "immigrant")
    immigrant = facts.build_immigrant(_conformed(spark, sf))
    write_period(immigrant, path, spread="visa")
    write_period(immigrant, path, spread="visa")  # rerun replaces the same periods
    return read_table(spark, path, "immigrant")


# ---------------------------------------------------------- C: projections
def rename_select_cast(spark, sf):
    (orders,) = sm.tables(spark, sf, "orders")
    df = C.rename(orders, {"o_orderkey": "order_id", "o_totalprice": "total",
                           "not_there": "ignored"})
    df = C.with_period(df, dates.period_key("o_orderdate"))
    df = C.with_period(df, PERIOD.key, "run_period")
    df = C.drop_columns(df, "o_orderstatus")
    df = C.with_long_copy(df, "total", "total_long")
    df = C.cast_columns(df, [("order_id", "int", None), ("total", None, None), ("total", "int", "total_int"),
                             ("total_long", None, None), ("i94dt", None, None), ("run_period", None, None)])
    return C.select_columns(df, ["order_id", "total", "total_int", "total_long", "i94dt", "run_period"])


# --------------------------------------------------------------- D: filters
def conjunctive_filter(spark, sf):
    (supplier,) = sm.tables(spark, sf, "supplier")
    return D.open_us_airports(sm.airport_rows(supplier)).select("ident", "type", "iata_code")


def equality_filter(spark, sf):
    (events,) = sm.tables(spark, sf, "events")
    return D.equals_filter(events, "event_type", "click").select("event_id", "user_id", "value")


def mode_filter(spark, sf):
    (orders,) = sm.tables(spark, sf, "orders")
    fact = orders.select("o_orderkey",
                         F.substring("o_orderpriority", 1, 1).cast("double").alias("i94mode"))
    out = E.coerced_lookup(fact, _codes(spark, sf, "i94mode")["i94mode"], "i94mode")
    return D.label_filter(out, "mode", sm.MODE_LABEL).select("o_orderkey", "mode")


# ----------------------------------------------------------------- E: joins
def using_join(spark, sf):
    orders, customer = sm.tables(spark, sf, "orders", "customer")
    o = orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    c = customer.select(F.col("c_custkey").alias("custkey"), "c_name", "c_nationkey")
    return E.using_join(o, c, "custkey")


def coerced_lookup(spark, sf):
    (customer,) = sm.tables(spark, sf, "customer")
    fact = customer.select("c_custkey", F.col("c_nationkey").cast("double").alias("nation_key"))
    country = _codes(spark, sf, "country")["country"]
    return E.coerced_lookup(fact, country, "nation_key", "country_code", keep_key=False)


def named_lookup(spark, sf):
    (customer,) = sm.tables(spark, sf, "customer")
    fact = customer.select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
                           .otherwise(sm.nation_code("c_nationkey")).alias("addr"))
    return E.named_lookup(fact, _codes(spark, sf, "us_state")["us_state"], "addr", "state_code",
                          keep_dim_key=True).drop("addr")


def role_playing_dim(spark, sf):
    arrivals = sm.arrivals(spark, sf).select("cicid", "i94res", "i94cit")
    country = _codes(spark, sf, "country")["country"]
    df = E.role_lookup(arrivals, country, "i94res", "country_code",
                       {"country_name": "residence_country"})
    return E.role_lookup(df, country, "i94cit", "country_code", {"country_name": "birth_country"})


def multi_key_join(spark, sf):
    airports, city = _dims(spark, sf)
    return E.multi_key_join(airports.withColumn("city", F.lower("city")), city, ["city", "state_code", "state_name"]).select(
        "airport_code", "name", "city", "population", "median_age")


def replace_side_columns(spark, sf):
    codes = _codes(spark, sf)
    airports, city = _dims(spark, sf, codes)
    events = facts.build_immigration(_conformed(spark, sf, codes)).withColumnRenamed(
        "port_of_entry", "airport_code")
    ac = airports.withColumn("city", F.lower("city"))
    ac = E.multi_key_join(ac, city, ["city", "state_code", "state_name"])
    # the airport's state columns go, the traveller's address state stays
    joined = E.replace_side_columns(events, ac, "airport_code", ["state_code", "state_name"])
    return joined.select("cicid", "airport_code", "city", "state_code", "state_name", "i94dt")


# ------------------------------------------------------- F: column helpers
def strip_quotes(spark, sf):
    (customer,) = sm.tables(spark, sf, "customer")
    return sm.customer_labels(customer).select(text.strip_quotes("raw_label").alias("label"))


def keep_class(spark, sf):
    part, customer = sm.tables(spark, sf, "part", "customer")
    p = part.select("p_partkey", text.keep_class("p_brand", text.UPPER).alias("upper_only"),
                    text.keep_class("p_name", text.LETTERS).alias("letters_only"),
                    text.keep_class(F.concat("p_brand", F.lit(" "), "p_type"), text.ALNUM
                                    ).alias("alnum_only"))
    return p


def invalid_labels(spark, sf):
    (customer,) = sm.tables(spark, sf, "customer")
    return dictionary.build_country(sm.customer_labels(customer))


def trim_spaces(spark, sf):
    (supplier,) = sm.tables(spark, sf, "supplier")
    return supplier.select("s_suppkey", text.trim_spaces(
        F.concat(F.lit("  "), "s_name", F.lit("\t  "))).alias("trimmed"),
        text.trim_spaces(F.concat(F.lit("\t "), "s_name", F.lit(" "))).alias("tab_kept"))


def split_item(spark, sf):
    (part,) = sm.tables(spark, sf, "part")
    return part.select("p_partkey", *[text.split_item("p_name", " ", i).alias(f"word{i}")
                                      for i in range(3)])


def lower_clean(spark, sf):
    supplier, customer = sm.tables(spark, sf, "supplier", "customer")
    s = supplier.select(F.col("s_suppkey").alias("k"),
                        text.lower_untabbed(F.concat(F.lit("\t"), "s_name", F.lit("\t"))).alias("v"))
    c = customer.select(F.col("c_custkey").alias("k"),
                        text.lower_trimmed(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("v"))
    return s.withColumn("src", F.lit("supplier")).unionByName(c.withColumn("src", F.lit("customer")))


def _day_numbers(orders: DataFrame) -> DataFrame:
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1960-01-01").cast("date")).cast("double")
    k = F.col("o_orderkey") % 10
    x = (F.when(k == 0, F.lit(0.0)).when(k == 1, F.lit(None).cast("double"))
         .when(k == 2, -days + 0.5).otherwise(days + F.col("o_totalprice") / 1e6))
    return orders.select("o_orderkey", x.alias("day_number"))


def day_number_date(spark, sf):
    (orders,) = sm.tables(spark, sf, "orders")
    return _day_numbers(orders).select("o_orderkey", "day_number",
                                       dates.day_number_to_iso("day_number").alias("iso_date"))


def date_parts(spark, sf):
    (orders,) = sm.tables(spark, sf, "orders")
    iso = F.when(F.col("o_orderkey") % 13 == 0, F.lit("not-a-date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    df = orders.select("o_orderkey", iso.alias("dt"))
    return df.select("o_orderkey", "dt", dates.iso_year("dt").alias("year"),
                     dates.iso_month("dt").alias("month"), dates.iso_day("dt").alias("day"))


def capitalise(spark, sf):
    part, customer = sm.tables(spark, sf, "part", "customer")
    p = part.select(F.col("p_partkey").alias("k"), text.capitalise("p_name").alias("v"))
    c = customer.select(F.col("c_custkey").alias("k"), text.capitalise("c_mktsegment").alias("v"))
    return p.withColumn("src", F.lit("part")).unionByName(c.withColumn("src", F.lit("customer")))


def _coordinates(supplier: DataFrame) -> DataFrame:
    txt = F.when(F.col("s_suppkey") % 5 == 0, F.lit("n/a")).otherwise(
        F.concat(F.lit(" "), F.col("s_suppkey").cast("string"), F.lit(", "),
                 F.col("s_nationkey").cast("string"), F.lit(" ")))
    return supplier.select("s_suppkey", txt.alias("coordinates"))


def coord_first(spark, sf):
    (supplier,) = sm.tables(spark, sf, "supplier")
    return _coordinates(supplier).select("s_suppkey", geo.coord_first("coordinates").alias("latitude"))


def coord_second(spark, sf):
    (supplier,) = sm.tables(spark, sf, "supplier")
    return _coordinates(supplier).select("s_suppkey", geo.coord_second("coordinates").alias("longitude"))


def region_state(spark, sf):
    (supplier,) = sm.tables(spark, sf, "supplier")
    k = F.col("s_suppkey") % 6
    region = (F.when(k == 0, sm.nation_code("s_nationkey"))
              .when(k == 1, F.concat(F.lit("US-"), sm.nation_code("s_nationkey"), F.lit("-X")))
              .otherwise(F.concat(F.lit(" US-"), sm.nation_code("s_nationkey"))))
    return supplier.select("s_suppkey", geo.region_state(region).alias("state"))


# ------------------------------------------------------ G: table builders
def us_state(spark, sf):
    return _codes(spark, sf, "us_state")["us_state"]


def country(spark, sf):
    return _codes(spark, sf, "country")["country"]


def us_ports(spark, sf):
    return _codes(spark, sf, "us_ports")["us_ports"]


def mode(spark, sf):
    return _codes(spark, sf, "i94mode")["i94mode"]


def visa(spark, sf):
    return _codes(spark, sf, "i94visa")["i94visa"]


def weather_month(spark, sf):
    (orders,) = sm.tables(spark, sf, "orders")
    return dims.build_weather(sm.weather_rows(orders))


def airports(spark, sf):
    return _airports(spark, sf)


def city(spark, sf):
    return _city(spark, sf)


def city_distinct(spark, sf):
    """G8 with one row per city and state."""
    return _city(spark, sf, distinct=True)


def conform(spark, sf):
    return _conformed(spark, sf)


def immigrant(spark, sf):
    return facts.build_immigrant(_conformed(spark, sf))


def immigration(spark, sf):
    return facts.build_immigration(_conformed(spark, sf))


def arrivals_by_city(spark, sf):
    """G12 flagship: the two fact tables joined back on (cicid, i94dt), the default."""
    codes = _stored_codes(spark, sf)
    return _joined_mart(spark, sf, _conformed(spark, sf, codes), codes)


def arrivals_by_city_joined(spark, sf):
    """G12 by its default path from the facts as a run stores them, both from one staged conform."""
    codes = _stored_codes(spark, sf)
    airports, city = _dims(spark, sf, codes)
    conformed = _copied(spark, _conformed(spark, sf, codes))
    paths = {n: scratch_path(spark, n) for n in ("immigration", "immigrant")}
    write_period(facts.build_immigration(conformed), paths["immigration"], spread="state_code")
    write_period(facts.build_immigrant(conformed), paths["immigrant"], spread="visa")
    stored = {n: read_table(spark, path, n) for n, path in paths.items()}
    return marts.build_immigration_demographics(stored["immigration"], stored["immigrant"], airports, city)


def arrivals_by_city_one_pass(spark, sf):
    """G12 in one pass over the conformed arrivals (their ids are unique in a month)."""
    codes = _stored_codes(spark, sf)
    airports, city = _dims(spark, sf, codes)
    return marts.mart_from_conformed(_conformed(spark, sf, codes), airports, city)


def stored_mart(spark, sf):
    """G12 written by month and read back, as the reports find it."""
    return _stored_mart(spark, sf)


def mart_duplicate_ids(spark, sf):
    """G12 where every third record id occurs twice in its month, with another gender."""
    codes = _stored_codes(spark, sf)
    conformed = _conformed(spark, sf, codes)
    again = conformed.filter(F.col("cicid") % 3 == 0).withColumn("gender", F.lit("X"))
    return _joined_mart(spark, sf, conformed.unionByName(again), codes)


# ------------------------------------------------ H: checks, runs, params
def nonempty_by_period(spark, sf):
    return quality.periods_present(facts.build_immigration(_conformed(spark, sf)))


def _run(spark, sf, start: Period, end: Period):
    root = scratch_path(spark, "run")
    layout = sm.analog_layout(root)
    sm.stage_raw(spark, sf, layout)
    from wayfare.config import Options
    checks = pipeline.backfill(spark, layout, start, end, Options(mode_label=sm.MODE_LABEL),
                               only=sm.months_with_mode(spark, sf))
    return layout, checks


def gate_after_empty_rerun(spark, sf):
    """H1: a month is loaded, its file then has no record to keep, and the month is run again."""
    from wayfare.config import Options
    layout, _ = _run(spark, sf, PERIOD, PERIOD)

    def rows(table):
        return read_period(spark, layout.table(table), PERIOD.key, table).count()

    tables = ("immigration", "immigrant", "immigration_demographics")
    before = {t: rows(t) for t in tables}
    file = layout.arrivals_path(PERIOD)
    kept_out = spark.read.parquet(file).withColumn("i94mode", F.lit(-1.0))
    write_full(_copied(spark, kept_out), file)
    try:
        pipeline.run_month(spark, layout, PERIOD, Options(mode_label=sm.MODE_LABEL))
        failed = False
    except quality.DataQualityError:
        failed = True
    return spark.createDataFrame([(t, before[t], rows(t), failed) for t in tables],
                                 "`table` string, rows_before long, rows_after long, gate_failed boolean")


def _copied(spark, df) -> DataFrame:
    """The rows from a copy on scratch storage, so that their own file can be replaced."""
    path = scratch_path(spark, "copy")
    write_full(df, path)
    return spark.read.schema(df.schema).parquet(path)


def _stored(name):
    """A table of G1-G8 as a run stores it from files, read back."""
    def query(spark, sf):
        layout = sm.analog_layout(scratch_path(spark, "stored"))
        sm.stage_raw(spark, sf, layout)
        pipeline.build_code_tables(spark, layout)
        pipeline.build_dimensions(spark, layout)
        return read_table(spark, layout.table(name), name)
    return query


def publication_check(spark, sf):
    lo, hi = sm.arrival_months(spark, sf)
    layout, _ = _run(spark, sf, lo, hi)
    tables = {n: layout.table(n) for n in ("weather", "airports", "city", "immigration",
                                           "immigrant")}
    tables["never_written"] = scratch_path(spark, "never-written")
    return quality.publication_check(spark, tables, raise_on_fail=False)


def preview(spark, sf):
    return quality.preview(facts.build_immigration(_conformed(spark, sf)), 5, ["cicid"])


def period_params(spark, sf):
    (orders,) = sm.tables(spark, sf, "orders")
    return orders.select(dates.period_key("o_orderdate").alias("period_key"),
                         dates.period_token("o_orderdate").alias("period_token")).distinct()


def run_month(spark, sf):
    layout, _ = _run(spark, sf, PERIOD, PERIOD)
    return read_period(spark, layout.table("immigration_demographics"), PERIOD.key,
                       "immigration_demographics")


def backfill(spark, sf):
    lo, hi = sm.arrival_months(spark, sf)
    _, checks = _run(spark, sf, lo, hi)
    return checks


# --------------------------------------------------------------- R: reports
def r1(spark, sf):
    return reports.visitors_by_country(_stored_mart(spark, sf))


def r2(spark, sf):
    return reports.visitors_by_city(_stored_mart(spark, sf))


def r3(spark, sf):
    return reports.city_demographics(_stored_mart(spark, sf))


def r4(spark, sf):
    (orders,) = sm.tables(spark, sf, "orders")
    return reports.monthly_temperature(dims.build_weather(sm.weather_rows(orders)))


def r5(spark, sf):
    return reports.traveller_types(_stored_mart(spark, sf))


def top_origins(spark, sf):
    """The five countries most visitors of each city and month come from."""
    return reports.top_origins(_stored_mart(spark, sf), 5)


def report_totals(spark, sf):
    """R1, R2 and R5 with their subtotals, from one scan of the mart."""
    dims_ = ["i94dt", "residence_country", "city", "state_code", "visa", "visatype"]
    sets = [*rollup_sets(["i94dt", "residence_country"]), *rollup_sets(["i94dt", "city", "state_code"]),
            *rollup_sets(["visa", "visatype", "city"])]
    return grouped_totals(_stored_mart(spark, sf), dims_, sets, {
        "visitors": ("count", "*"), "airports": ("distinct", "airport_code"), "avg_age": ("avg", "age")})


def reports_by_parts(spark, sf):
    """R1-R5 merged from monthly parts after one month has been run again with other records."""
    mart = _stored_mart(spark, sf)
    months = [r[0] for r in mart.select("i94dt").distinct().collect()]
    root = scratch_path(spark, "parts")
    report_parts.store_parts(mart, root, months)
    rerun = mart.filter((F.col("i94dt") == PERIOD.key) & (F.col("cicid") % 2 == 0))
    report_parts.store_parts(rerun, root, [PERIOD.key])
    (orders,) = sm.tables(spark, sf, "orders")
    report_parts.store_temperature_part(dims.build_weather(sm.weather_rows(orders)), root)

    def rows(name, df, keys, n, values):
        texts = [F.col(k).cast("string") for k in keys] + [F.lit(None).cast("string")] * (3 - len(keys))
        numbers = [F.col(v).cast("double") for v in values] + [F.lit(None).cast("double")] * (2 - len(values))
        return df.select(F.lit(name).alias("report"), *[c.alias(f"key{i}") for i, c in enumerate(texts)], F.col(n).alias("n"),
                         *[c.alias(f"value{i}") for i, c in enumerate(numbers)])

    return (rows("r1", report_parts.visitors_by_country(spark, root), ["i94dt", "residence_country"], "visitors", [])
            .unionByName(rows("r2", report_parts.visitors_by_city(spark, root), ["i94dt", "city", "state_code"], "visitors", ["airports"]))
            .unionByName(rows("r3", report_parts.city_demographics(spark, root), ["city", "state_code"], "visitors",
                              ["population", "median_age"]))
            .unionByName(rows("r4", report_parts.monthly_temperature(spark, root), ["city", "Month"], "readings", ["avg_temperature"]))
            .unionByName(rows("r5", report_parts.traveller_types(spark, root), ["visa", "visatype", "city"], "travellers", ["avg_age"])))


def sketch_estimates(spark, sf):
    """Stored sketches of all months merged by city: estimates within their bounds of the exact figures."""
    mart = _stored_mart(spark, sf)
    path = scratch_path(spark, "sketches")
    sketches.store_sketches(mart, path, [r[0] for r in mart.select("i94dt").distinct().collect()])
    merged = sketches.merged_estimates(sketches.read_sketches(spark, path), ["city"], quantiles=(0.5,))
    exact = mart.groupBy("city").agg(F.count_distinct(sketches.traveller()).alias("exact"))
    ages = mart.filter("age is not null").join(merged.select("city", "age_50"), "city").groupBy("city").agg(
        F.avg((F.col("age") < F.col("age_50")).cast("double")).alias("below"),
        F.avg((F.col("age") <= F.col("age_50")).cast("double")).alias("up_to"))
    both = merged.join(exact, "city").join(ages, "city", "left")
    median = (F.col("below") - sketches.RANK_ERROR <= 0.5) & (F.col("up_to") + sketches.RANK_ERROR >= 0.5)
    return both.select("city", "visits", F.col("exact").alias("travellers"),
                       (F.abs(F.col("travellers") - F.col("exact")) <= sketches.DISTINCT_ERROR * F.col("exact")).alias("distinct_within"),
                       F.coalesce(median, F.col("age_50").isNull()).alias("median_within"))


# ------------------------------------------- rejected records, publication
def _classified(spark, sf) -> DataFrame:
    c = _stored_codes(spark, sf)
    return rejects.classify_arrivals(sm.arrivals(spark, sf), c["i94mode"], c["i94visa"], c["us_state"], c["country"],
                                     mode_label=sm.MODE_LABEL)


def rejected_records(spark, sf):
    """Every dropped record with the first lookup that dropped it."""
    return rejects.rejected(_classified(spark, sf)).select("cicid", "i94dt", "i94port", "i94addr", "rejected_by")


def reject_audit(spark, sf):
    """Records and rows of each month by reason; reason null: kept."""
    return rejects.audit(_classified(spark, sf))


def reject_reconciliation(spark, sf):
    """All months run with their rejects stored: read = kept + rejected, counted on the files again."""
    from wayfare.config import Options
    layout = sm.analog_layout(scratch_path(spark, "run"))
    sm.stage_raw(spark, sf, layout)
    lo, hi = sm.arrival_months(spark, sf)
    only = sm.months_with_mode(spark, sf)
    pipeline.backfill(spark, layout, lo, hi, Options(mode_label=sm.MODE_LABEL, keep_rejects=True), only=only)
    return pipeline.reconcile_periods(spark, layout, [p for p in month_range(lo, hi) if p.key in only])


def publish_cycle(spark, sf):
    """A month is published, a broken rerun fails its gate, a good rerun replaces the month."""
    from wayfare.config import Options
    options = Options(mode_label=sm.MODE_LABEL)
    layout = sm.analog_layout(scratch_path(spark, "publish"))
    sm.stage_raw(spark, sf, layout)
    root, file = layout.published_root(), layout.arrivals_path(PERIOD)
    seen = []

    def look(step, failed):
        manifest = published.read_manifest(spark, root)
        for name in pipeline.MONTHLY:
            rows = published.read_published(spark, root, name, [PERIOD.key], manifest=manifest).count()
            seen.append((step, name, manifest.version, rows, failed))

    pipeline.publish_months(spark, layout, PERIOD, PERIOD, options)
    look("published", False)
    records = _copied(spark, spark.read.parquet(file))
    write_full(records.withColumn("i94mode", F.lit(-1.0)), file)
    try:
        pipeline.publish_months(spark, layout, PERIOD, PERIOD, options, refresh_reference=False)
        failed = False
    except quality.DataQualityError:
        failed = True
    look("broken rerun", failed)
    write_full(records.filter(F.col("cicid") % 2 == 0), file)
    pipeline.publish_months(spark, layout, PERIOD, PERIOD, options, refresh_reference=False)
    look("good rerun", False)
    return spark.createDataFrame(seen, "step string, `table` string, version int, rows long, gate_failed boolean")


# --------------------------------------- time: temperatures, presence, deliveries
def asof_temperature(spark, sf):
    """Every arrival with the last temperature of its city; a city is the label of the travel mode here."""
    (orders,) = sm.tables(spark, sf, "orders")
    weather = dims.build_weather(sm.weather_rows(orders))
    arrivals = E.coerced_lookup(facts.decode_arrivals(sm.arrivals(spark, sf)), _stored_codes(spark, sf)["i94mode"], "i94mode")
    found = temperature.arrivals_with_temperature(arrivals.select("cicid", F.col("mode").alias("city"), "arrival_date"), weather)
    return found.select("cicid", "city", "arrival_date", "temperature", "measured_on")


def presence_by_state(spark, sf):
    """Visitors present in each state on each day, by arrival and departure."""
    return reports.present_by_state(read_table(spark, _written_immigration(spark, sf), "immigration"))


def delivery_changes(spark, sf):
    """Two deliveries of the orders: some lost, some corrected, some repeated, some new."""
    (orders,) = sm.tables(spark, sf, "orders")
    k = F.col("o_orderkey") % 20
    kept = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    old = kept.filter(k != 1).unionByName(kept.filter(k == 2)).unionByName(kept.filter(k == 5))
    new = kept.filter(k != 3).withColumn("o_orderstatus", F.when(k == 4, "X").otherwise(F.col("o_orderstatus")))
    new = new.unionByName(kept.filter(k == 5).withColumn("o_totalprice", F.lit(None).cast("double"))).unionByName(kept.filter(k == 6))
    return compare_deliveries(old, new, ["o_orderkey"])


def event_windows(spark, sf):
    """Daily windows of the event stream, in files by time, with a restart from the checkpoint half-way."""
    from wayfare.streaming import windows
    (events,) = sm.tables(spark, sf, "events")
    root = scratch_path(spark, "events")
    (middle,) = events.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("t")).approxQuantile("t", [0.5], 0.01)
    early = F.unix_micros(F.col("ts").cast("timestamp")) < int(middle)
    for part in (events.filter(early), events.filter(~early)):
        (part.withColumn("ts", F.col("ts").cast("timestamp")).repartitionByRange(3, "ts").sortWithinPartitions("ts")
         .write.mode("append").parquet(f"{root}/landing"))
        stream = windows.read_event_stream(spark, f"{root}/landing", files_per_batch=3)
        query = windows.start_event_windows(stream, f"{root}/out", f"{root}/checkpoint", delay="2 days")
        query.awaitTermination()
    found = windows.current_windows(spark, f"{root}/out")
    return found.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "events", "lowest", "highest",
                        F.col("total").cast("double").alias("total"))


QUERIES = {
    # A sources
    "label_scan": label_scan, "csv_semicolon_scan": csv_semicolon_scan,
    "csv_comma_scan": csv_comma_scan, "period_source": period_source,
    "table_scan": table_scan, "period_pruned_read": period_pruned_read,
    # B sinks
    "full_refresh": full_refresh, "partitioned_refresh": partitioned_refresh,
    "period_rerun": period_rerun,
    # C projections
    "rename_select_cast": rename_select_cast,
    # D filters
    "conjunctive_filter": conjunctive_filter, "equality_filter": equality_filter,
    "mode_filter": mode_filter,
    # E joins
    "using_join": using_join, "coerced_lookup": coerced_lookup, "named_lookup": named_lookup,
    "role_playing_dim": role_playing_dim, "multi_key_join": multi_key_join,
    "replace_side_columns": replace_side_columns,
    # F column helpers
    "strip_quotes": strip_quotes, "keep_class": keep_class, "invalid_labels": invalid_labels,
    "trim_spaces": trim_spaces, "split_item": split_item, "lower_clean": lower_clean,
    "day_number_date": day_number_date, "date_parts": date_parts, "capitalise": capitalise,
    "coord_first": coord_first, "coord_second": coord_second, "region_state": region_state,
    # G jobs
    "us_state": us_state, "country": country, "us_ports": us_ports, "mode": mode, "visa": visa,
    "weather_month": weather_month, "airports": airports, "city": city,
    "city_distinct": city_distinct, "conform": conform,
    "immigrant": immigrant, "immigration": immigration, "arrivals_by_city": arrivals_by_city,
    "arrivals_by_city_joined": arrivals_by_city_joined,
    "arrivals_by_city_one_pass": arrivals_by_city_one_pass, "mart_duplicate_ids": mart_duplicate_ids,
    "stored_mart": stored_mart,
    # H checks and runs
    "nonempty_by_period": nonempty_by_period, "publication_check": publication_check,
    "preview": preview, "period_params": period_params, "run_month": run_month,
    "backfill": backfill, "gate_after_empty_rerun": gate_after_empty_rerun,
    # G as stored by a run
    **{f"stored_{n}": _stored(n) for n in ("us_state", "country", "us_ports", "weather", "airports", "city")},
    # R reports
    "r1": r1, "r2": r2, "r3": r3, "r4": r4, "r5": r5,
    "top_origins": top_origins, "report_totals": report_totals, "reports_by_parts": reports_by_parts,
    "sketch_estimates": sketch_estimates,
    # rejected records, publication, time
    "rejected_records": rejected_records, "reject_audit": reject_audit, "reject_reconciliation": reject_reconciliation,
    "publish_cycle": publish_cycle, "asof_temperature": asof_temperature, "presence_by_state": presence_by_state,
    "delivery_changes": delivery_changes, "event_windows": event_windows,
}


# ------------------------------------------------------------ streaming
def stream_ingest(spark, sf):
    """Arrival month files picked up by a file stream and loaded as facts."""
    from wayfare.config import Options
    from wayfare.streaming import ingest_available
    root = scratch_path(spark, "stream")
    layout = sm.analog_layout(root)
    sm.stage_raw(spark, sf, layout)
    pipeline.build_code_tables(spark, layout)
    ingest_available(spark, layout, Options(mode_label=sm.MODE_LABEL),
                     checkpoint=f"{root}/_stream_checkpoint")
    return read_table(spark, layout.table("immigration"), "immigration")


QUERIES["stream_ingest"] = stream_ingest
