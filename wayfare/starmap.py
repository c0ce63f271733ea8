"""Map the driver's TPC-H-like tables onto the arrivals source shapes.

The test tables carry no arrival records, so each source is derived from them
with Spark (its size grows with the tables) and fed to the *unchanged* jobs:

=============== ===================================== =========================
source          derived from                          notes
=============== ===================================== =========================
state labels    nation                                code = letters of the key
                                                      + region digit; region 4
                                                      keeps digits only -> ''
country labels  nation                                regions 3/4 and key%10=7
                                                      get unusable labels
port labels     supplier                              code = letters of the key
                                                      + digit; key%7=0 has no
                                                      comma (state lost)
mode labels     distinct order priorities             '1-URGENT' -> 1 = URGENT
visa labels     distinct market segments              code = ascii(first) - 64
weather CSV     orders                                status F = United States
airports CSV    supplier                              IATA = port code
demographics    supplier (+ a 2nd row when key%4=0)   fan-out as city x race
arrivals        orders + customer + per-order line    one record per order
                summary + the order's first supplier
=============== ===================================== =========================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import table_path

# Fixed values of the mapping (shared with the DuckDB oracles).
NATION_LETTERS = "ABCDEFGHIJ"
SUPPLIER_LETTERS = "KLMNOPQRST"
DIGITS = "0123456789"
EPOCH = "1960-01-01"
MODE_LABEL = "URGENT"


_READS: dict = {}


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The named test tables; each file is listed and its footer read once per session."""
    out = []
    for n in names:
        key = (id(spark), spark.sparkContext.applicationId, table_path(sf_dir, n))
        if key not in _READS:
            _READS[key] = spark.read.parquet(key[2])
        out.append(_READS[key])
    return out


def nation_code(k) -> Column:
    return F.translate(F.col(k).cast("string") if isinstance(k, str) else k.cast("string"),
                       DIGITS, NATION_LETTERS)


def supplier_code(k) -> Column:
    return F.translate(F.col(k).cast("string") if isinstance(k, str) else k.cast("string"),
                       DIGITS, SUPPLIER_LETTERS)


def _days_since_epoch(c: str) -> Column:
    return F.datediff(F.col(c).cast("date"), F.lit(EPOCH).cast("date")).cast("double")


# ---------------------------------------------------------------- label lines
def state_labels(nation: DataFrame) -> DataFrame:
    code = F.when(F.col("n_regionkey") == 4, F.col("n_nationkey").cast("string")).otherwise(
        F.concat(nation_code("n_nationkey"), F.col("n_regionkey").cast("string")))
    return nation.select(F.concat(F.lit("\t'"), code, F.lit("'")).alias("raw_code"),
                         F.concat(F.lit("'"), F.col("n_name"), F.lit("'")).alias("raw_label"))


def customer_labels(customer: DataFrame) -> DataFrame:
    """Country-style label lines, one per customer: ``   <key> =  '<label> '``;
    some labels are unusable (Collapsed / No Country Code / INVALID)."""
    k = F.col("c_custkey") % 10
    label = (F.when(k == 3, F.concat(F.lit("Collapsed ("), "c_name", F.lit(")")))
             .when(k == 4, F.concat(F.lit("No Country Code ("), "c_name", F.lit(")")))
             .when(k == 7, F.concat(F.lit("INVALID: "), "c_name"))
             .otherwise(F.col("c_name")))
    return customer.select(
        F.concat(F.lit("   "), F.col("c_custkey").cast("string"), F.lit(" ")).alias("raw_code"),
        F.concat(F.lit("  '"), label, F.lit(" '")).alias("raw_label"))


def country_labels(nation: DataFrame) -> DataFrame:
    label = (F.when(F.col("n_regionkey") == 3, F.concat(F.lit("Collapsed ("), "n_name", F.lit(")")))
             .when(F.col("n_regionkey") == 4, F.concat(F.lit("No Country Code ("), "n_name", F.lit(")")))
             .when(F.col("n_nationkey") % 10 == 7, F.concat(F.lit("INVALID: "), "n_name"))
             .otherwise(F.col("n_name")))
    return nation.select(
        F.concat(F.lit("   "), F.col("n_nationkey").cast("string"), F.lit(" ")).alias("raw_code"),
        F.concat(F.lit("  '"), label, F.lit(" '")).alias("raw_label"))


def port_city(supplier_name: str = "s_name") -> Column:
    return F.upper(F.regexp_replace(F.col(supplier_name), "#", " "))


def port_labels(supplier: DataFrame) -> DataFrame:
    sep = F.when(F.col("s_suppkey") % 7 == 0, F.lit(" ")).otherwise(F.lit(", "))
    return supplier.select(
        F.concat(F.lit("   '"), supplier_code("s_suppkey"), (F.col("s_suppkey") % 3).cast("string"),
                 F.lit("'\t")).alias("raw_code"),
        F.concat(F.lit("\t'"), port_city(), sep, nation_code("s_nationkey"),
                 F.lit("      '")).alias("raw_label"))


def mode_labels(orders: DataFrame) -> DataFrame:
    p = orders.select("o_orderpriority").distinct()
    return p.select(
        F.concat(F.lit("\t"), F.substring("o_orderpriority", 1, 1), F.lit(" ")).alias("raw_code"),
        F.concat(F.lit(" '"), F.substr(F.col("o_orderpriority"), F.lit(3)), F.lit("'")).alias("raw_label"))


def visa_labels(customer: DataFrame) -> DataFrame:
    s = customer.select("c_mktsegment").distinct()
    return s.select(
        F.concat(F.lit("   "), (F.ascii("c_mktsegment") - 64).cast("string"), F.lit(" ")).alias("raw_code"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("raw_label"))


# ---------------------------------------------------------------- CSV sources
def weather_rows(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"),
        F.floor(F.col("o_totalprice") / 10000).cast("bigint").cast("string").alias("AverageTemperature"),
        (F.col("o_custkey") % 7).cast("string").alias("AverageTemperatureUncertainty"),
        F.substr(F.col("o_orderpriority"), F.lit(3)).alias("City"),
        F.when(F.col("o_orderstatus") == "F", F.lit("United States")).otherwise(F.lit("Canada")).alias("Country"),
        F.col("o_custkey").cast("string").alias("Latitude"),
        F.col("o_orderkey").cast("string").alias("Longitude"))


def airport_rows(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return supplier.select(
        F.concat(F.lit("S"), k.cast("string")).alias("ident"),
        F.when(F.col("s_acctbal") < 0, F.lit("closed")).when(k % 5 == 0, F.lit("heliport"))
         .otherwise(F.lit("small_airport")).alias("type"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_nationkey") % 6 == 5, F.lit("CA")).otherwise(F.lit("US")).alias("iso_country"),
        F.concat(F.lit("US-"), nation_code("s_nationkey")).alias("iso_region"),
        F.lower("s_name").alias("municipality"),
        F.concat(F.lit("K"), supplier_code("s_suppkey")).alias("gps_code"),
        F.when(k % 11 == 3, F.lit("null")).when(k % 13 == 4, F.lit(None).cast("string"))
         .otherwise(supplier_code("s_suppkey")).alias("iata_code"),
        k.cast("string").alias("local_code"),
        F.when(k % 17 == 9, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("s_acctbal").cast("string"), F.lit(", "),
                             F.col("s_nationkey").cast("string"))).alias("coordinates"))


def demographic_rows(supplier: DataFrame) -> DataFrame:
    """One row per supplier city, and a second ("race B") row when key % 4 = 0,
    produced in one scan by exploding a one- or two-element array."""
    k = F.col("s_suppkey")
    extra = F.explode(F.when(k % 4 == 0, F.array(F.lit(17), F.lit(18))).otherwise(F.array(F.lit(17))))
    rows = supplier.select("s_suppkey", "s_name", "s_nationkey", extra.alias("extra"))
    return rows.select(
        F.concat(F.lit("  Supplier "), F.substr(F.col("s_name"), F.lit(10)), F.lit(" ")).alias("City"),
        F.when(k % 9 == 1, F.lit("ZZ")).otherwise(nation_code("s_nationkey")).alias("State Code"),
        F.concat((k % 40 + 20).cast("string"), F.lit(".5")).alias("Median Age"),
        (k * 1000 + F.col("extra")).cast("string").alias("Total Population"),
        F.when(F.col("extra") == 17, F.lit("A")).otherwise(F.lit("B")).alias("Race"))


# ------------------------------------------------------------------- arrivals
def arrival_rows(orders: DataFrame, customer: DataFrame, lineitem: DataFrame,
                 supplier: DataFrame) -> DataFrame:
    """One arrival record per order (cicid = order key), all 27 source columns."""
    lines = lineitem.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("first_supp"), F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty"), F.max("l_shipdate").alias("last_ship"))
    df = (orders.join(lines, orders.o_orderkey == lines.l_orderkey)
          .join(customer, orders.o_custkey == customer.c_custkey)
          .join(supplier, F.col("first_supp") == supplier.s_suppkey))
    age = F.col("qty") / F.col("n_lines")
    year = F.year("o_orderdate").cast("double")
    return df.select(
        F.col("o_orderkey").cast("double").alias("cicid"),
        year.alias("i94yr"),
        F.month("o_orderdate").cast("double").alias("i94mon"),
        F.col("s_nationkey").cast("double").alias("i94cit"),
        F.col("c_nationkey").cast("double").alias("i94res"),
        supplier_code("s_suppkey").alias("i94port"),
        _days_since_epoch("o_orderdate").alias("arrdate"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("i94mode"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
         .otherwise(nation_code("c_nationkey")).alias("i94addr"),
        F.when(F.col("n_lines") == 1, F.lit(0.0))
         .otherwise(_days_since_epoch("last_ship") + 0.25).alias("depdate"),
        age.alias("i94bir"),
        (F.ascii("c_mktsegment") - 64).cast("double").alias("i94visa"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("dtadfile"),
        F.col("o_orderstatus").alias("visapost"),
        F.substring("c_mktsegment", 1, 3).alias("occup"),
        F.col("o_orderstatus").alias("entdepa"),
        F.substring("o_orderpriority", 1, 1).alias("entdepd"),
        F.lit(None).cast("string").alias("entdepu"),
        F.lit("M").alias("matflag"),
        (year - F.floor(age)).alias("biryear"),
        F.date_format("last_ship", "MMddyyyy").alias("dtaddto"),
        F.when(F.col("o_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.lit(None).cast("string").alias("insnum"),
        F.col("n_lines").cast("string").alias("airline"),
        (F.col("o_orderkey").cast("double") * 1000003.0 + F.col("c_custkey").cast("double")).alias("admnum"),
        F.col("first_supp").cast("string").alias("fltno"),
        F.substring("c_mktsegment", 1, 2).alias("visatype"))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, l, s = tables(spark, sf_dir, "orders", "customer", "lineitem", "supplier")
    return arrival_rows(o, c, l, s)


def code_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """G1-G5 (all, or the named ones) built from the derived label lines."""
    from .plans import dictionary as d
    nation, supplier, orders, customer = tables(spark, sf_dir, "nation", "supplier", "orders",
                                                "customer")
    build = {
        "us_state": lambda: d.build_us_state(state_labels(nation)),
        "country": lambda: d.build_country(country_labels(nation)),
        "us_ports": lambda: d.build_us_ports(port_labels(supplier), d.build_us_state(state_labels(nation))),
        "i94mode": lambda: d.build_mode(mode_labels(orders)),
        "i94visa": lambda: d.build_visa(visa_labels(customer)),
    }
    return {name: build[name]() for name in names or build}


# ------------------------------------------------------------ raw landing zone
ANALOG_ARRIVALS_TEMPLATE = "arrivals/file_month={token}"


def write_lines(df: DataFrame, path: str) -> None:
    df.select(F.concat("raw_code", F.lit("="), "raw_label").alias("value")).write.mode(
        "overwrite").text(path)


def write_csv(df: DataFrame, path: str, sep: str) -> None:
    (df.write.mode("overwrite").option("header", "true").option("sep", sep)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))


def stage_raw(spark: SparkSession, sf_dir: str, layout) -> None:
    """Write every raw input of a monthly run, derived from the test tables,
    into ``layout.raw_root`` (label files, three CSVs, arrivals by month)."""
    nation, supplier, orders, customer, lineitem = tables(
        spark, sf_dir, "nation", "supplier", "orders", "customer", "lineitem")
    from .plans.pipeline import run_concurrently
    run_concurrently([
        lambda: write_lines(state_labels(nation), layout.label_path("us_state")),
        lambda: write_lines(country_labels(nation), layout.label_path("country")),
        lambda: write_lines(port_labels(supplier), layout.label_path("us_ports")),
        lambda: write_lines(mode_labels(orders), layout.label_path("i94mode")),
        lambda: write_lines(visa_labels(customer), layout.label_path("i94visa")),
        lambda: write_csv(weather_rows(orders), layout.raw(layout.weather_file), ","),
        lambda: write_csv(airport_rows(supplier), layout.raw(layout.airports_file), ","),
        lambda: write_csv(demographic_rows(supplier), layout.raw(layout.demographics_file), ";"),
        lambda: write_arrival_months(arrival_rows(orders, customer, lineitem, supplier), layout),
    ], 4)


def write_arrival_months(arrivals_df: DataFrame, layout) -> None:
    """One folder per month (``file_month=<token>``), like one file per month."""
    from .functions.dates import period_token
    root = layout.raw(layout.arrivals_template.split("/file_month=")[0])
    token = period_token(F.make_date(F.col("i94yr").cast("int"), F.col("i94mon").cast("int"),
                                     F.lit(1)))
    (arrivals_df.withColumn("file_month", token).hint("rebalance", "file_month")
     .write.mode("overwrite").partitionBy("file_month").parquet(root))


def arrival_months(spark: SparkSession, sf_dir: str):
    """First and last month present in the orders (one aggregate row)."""
    from .periods import Period
    (orders,) = tables(spark, sf_dir, "orders")
    r = orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).first()
    return Period(r["lo"].year, r["lo"].month), Period(r["hi"].year, r["hi"].month)


def months_with_mode(spark: SparkSession, sf_dir: str) -> set[str]:
    """Months that have an order of the kept mode (a set of months, not of rows)."""
    from .functions.dates import period_key
    (orders,) = tables(spark, sf_dir, "orders")
    kept = orders.filter(F.substr(F.col("o_orderpriority"), F.lit(3)) == MODE_LABEL)
    return {r[0] for r in kept.select(period_key("o_orderdate")).distinct().collect()}


def analog_layout(root: str):
    from .config import Layout
    return Layout(raw_root=f"{root}/raw", processed_root=f"{root}/processed",
                  arrivals_template=ANALOG_ARRIVALS_TEMPLATE)
