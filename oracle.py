"""DuckDB oracle SQL for every registered query (see __spark_entry__.oracle_sql).

Written independently of the Spark code, in DuckDB's dialect, from the raw
test tables.  Dialect notes: DuckDB regexp_replace needs the 'g' flag to
replace all matches; cast(double as int) rounds, so trunc() first; year()/
month() are BIGINT, so cast to INTEGER; string_split(...)[n] is 1-based and
NULL out of range.
"""

from __future__ import annotations

WS = "chr(9) || chr(10) || chr(13) || ' '"


def nc(x: str) -> str:
    return f"translate(CAST({x} AS VARCHAR), '0123456789', 'ABCDEFGHIJ')"


def sc(x: str) -> str:
    return f"translate(CAST({x} AS VARCHAR), '0123456789', 'KLMNOPQRST')"


def key_double(x: str) -> str:
    return f"TRY_CAST(trim({x}, {WS}) AS DOUBLE)"


def iso_day(x: str) -> str:
    return (f"CASE WHEN {x} <> 0 THEN CAST(DATE '1960-01-01' + CAST(floor({x}) AS INTEGER) "
            f"AS VARCHAR) END")


STATE_LINES = f"""state_lines AS (
  SELECT chr(9) || '''' || CASE WHEN n_regionkey = 4 THEN CAST(n_nationkey AS VARCHAR)
                              ELSE {nc('n_nationkey')} || CAST(n_regionkey AS VARCHAR) END || '''' AS raw_code,
         '''' || n_name || '''' AS raw_label
  FROM nation)"""

US_STATE = f"""{STATE_LINES},
us_state AS (
  SELECT regexp_replace(raw_code, '[^A-Z]', '', 'g') AS state_code,
         trim(replace(raw_label, '''', '')) AS state_name
  FROM state_lines)"""

COUNTRY_LINES = f"""country_lines AS (
  SELECT '   ' || CAST(n_nationkey AS VARCHAR) || ' ' AS raw_code,
         '  ''' || CASE WHEN n_regionkey = 3 THEN 'Collapsed (' || n_name || ')'
                       WHEN n_regionkey = 4 THEN 'No Country Code (' || n_name || ')'
                       WHEN n_nationkey % 10 = 7 THEN 'INVALID: ' || n_name
                       ELSE n_name END || ' ''' AS raw_label
  FROM nation)"""

CUSTOMER_LINES = """customer_lines AS (
  SELECT '   ' || CAST(c_custkey AS VARCHAR) || ' ' AS raw_code,
         '  ''' || CASE WHEN c_custkey % 10 = 3 THEN 'Collapsed (' || c_name || ')'
                       WHEN c_custkey % 10 = 4 THEN 'No Country Code (' || c_name || ')'
                       WHEN c_custkey % 10 = 7 THEN 'INVALID: ' || c_name
                       ELSE c_name END || ' ''' AS raw_label
  FROM customer)"""

COUNTRY = f"""{COUNTRY_LINES},
country AS (
  SELECT trim(raw_code) AS country_code,
         regexp_replace(trim(replace(raw_label, '''', '')),
                        '^INVALID.*|Collapsed.*|No Country.*', 'INVALID', 'g') AS country_name
  FROM country_lines)"""

PORT_LINES = f"""port_lines AS (
  SELECT '   ''' || {sc('s_suppkey')} || CAST(s_suppkey % 3 AS VARCHAR) || '''' || chr(9) AS raw_code,
         chr(9) || '''' || upper(replace(s_name, '#', ' '))
           || CASE WHEN s_suppkey % 7 = 0 THEN ' ' ELSE ', ' END
           || {nc('s_nationkey')} || '      ''' AS raw_label
  FROM supplier)"""

US_PORTS = f"""{PORT_LINES},
ports_raw AS (
  SELECT regexp_replace(replace(raw_code, '''', ''), '[^A-Z]', '', 'g') AS port_code,
         trim(string_split(replace(raw_label, '''', ''), ',')[1]) AS city,
         regexp_replace(string_split(replace(raw_label, '''', ''), ',')[2], '[^A-Z]', '', 'g') AS state_code
  FROM port_lines),
us_ports AS (
  SELECT p.state_code, p.port_code, p.city, s.state_name
  FROM ports_raw p JOIN us_state s ON p.state_code = s.state_code)"""

MODE_LINES = """mode_lines AS (
  SELECT DISTINCT chr(9) || substr(o_orderpriority, 1, 1) || ' ' AS raw_code,
                  ' ''' || substr(o_orderpriority, 3) || '''' AS raw_label
  FROM orders)"""

I94MODE = f"""{MODE_LINES},
i94mode AS (
  SELECT replace(raw_code, '''', '') AS i94mode,
         regexp_replace(replace(raw_label, '''', ''), '[^A-Za-z]', '', 'g') AS mode
  FROM mode_lines)"""

VISA_LINES = """visa_lines AS (
  SELECT DISTINCT '   ' || CAST(ascii(c_mktsegment) - 64 AS VARCHAR) || ' ' AS raw_code,
                  ' ' || c_mktsegment AS raw_label
  FROM customer)"""

I94VISA = f"""{VISA_LINES},
i94visa AS (
  SELECT replace(raw_code, '''', '') AS i94visa,
         regexp_replace(replace(raw_label, '''', ''), '[^A-Za-z0-9]', '', 'g') AS visa
  FROM visa_lines)"""

WEATHER_ROWS = """weather_rows AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS dt,
         CAST(CAST(floor(o_totalprice / 10000) AS BIGINT) AS VARCHAR) AS AverageTemperature,
         CAST(o_custkey % 7 AS VARCHAR) AS AverageTemperatureUncertainty,
         substr(o_orderpriority, 3) AS City,
         CASE WHEN o_orderstatus = 'F' THEN 'United States' ELSE 'Canada' END AS Country,
         CAST(o_custkey AS VARCHAR) AS Latitude,
         CAST(o_orderkey AS VARCHAR) AS Longitude
  FROM orders)"""

WEATHER = f"""{WEATHER_ROWS},
weather AS (
  SELECT dt AS date,
         CAST(year(TRY_CAST(dt AS DATE)) AS INTEGER) AS Year,
         CAST(month(TRY_CAST(dt AS DATE)) AS INTEGER) AS Month,
         CAST(day(TRY_CAST(dt AS DATE)) AS INTEGER) AS DayOfMonth,
         AverageTemperature, AverageTemperatureUncertainty,
         upper(substr(City, 1, 1)) || lower(substr(City, 2)) AS city,
         Latitude, Longitude
  FROM weather_rows WHERE Country = 'United States')"""

AIRPORT_ROWS = f"""airport_rows AS (
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS ident,
         CASE WHEN s_acctbal < 0 THEN 'closed' WHEN s_suppkey % 5 = 0 THEN 'heliport'
              ELSE 'small_airport' END AS type,
         s_name AS name,
         CASE WHEN s_nationkey % 6 = 5 THEN 'CA' ELSE 'US' END AS iso_country,
         'US-' || {nc('s_nationkey')} AS iso_region,
         lower(s_name) AS municipality,
         'K' || {sc('s_suppkey')} AS gps_code,
         CASE WHEN s_suppkey % 11 = 3 THEN 'null' WHEN s_suppkey % 13 = 4 THEN NULL
              ELSE {sc('s_suppkey')} END AS iata_code,
         CAST(s_suppkey AS VARCHAR) AS local_code,
         CASE WHEN s_suppkey % 17 = 9 THEN NULL ELSE s_acctbal END AS lat_value,
         CASE WHEN s_suppkey % 17 = 9 THEN NULL ELSE CAST(s_nationkey AS DOUBLE) END AS lon_value
  FROM supplier)"""

AIRPORTS = f"""{AIRPORT_ROWS},
airports AS (
  SELECT p.port_code AS airport_code, a.ident, a.type, a.name, a.gps_code, a.local_code,
         a.lat_value AS latitude, a.lon_value AS longitude, p.state_code,
         lower(replace(p.city, chr(9), '')) AS city, p.state_name
  FROM airport_rows a JOIN us_ports p ON a.iata_code = p.port_code
  WHERE a.iso_country = 'US' AND a.type <> 'closed' AND a.iata_code <> 'null')"""

DEMOGRAPHIC_ROWS = f"""demographic_rows AS (
  SELECT '  Supplier ' || substr(s_name, 10) || ' ' AS City,
         CASE WHEN s_suppkey % 9 = 1 THEN 'ZZ' ELSE {nc('s_nationkey')} END AS state_code,
         CAST(s_suppkey % 40 + 20 AS VARCHAR) || '.5' AS median_age,
         CAST(s_suppkey * 1000 + 17 AS VARCHAR) AS population, 'A' AS race
  FROM supplier
  UNION ALL
  SELECT '  Supplier ' || substr(s_name, 10) || ' ',
         CASE WHEN s_suppkey % 9 = 1 THEN 'ZZ' ELSE {nc('s_nationkey')} END,
         CAST(s_suppkey % 40 + 20 AS VARCHAR) || '.5',
         CAST(s_suppkey * 1000 + 18 AS VARCHAR), 'B'
  FROM supplier WHERE s_suppkey % 4 = 0)"""

CITY = f"""{DEMOGRAPHIC_ROWS},
city AS (
  SELECT d.state_code, lower(trim(d.City)) AS city, d.median_age, d.population, s.state_name
  FROM demographic_rows d JOIN us_state s ON d.state_code = s.state_code)"""

ARRIVALS = f"""line_summary AS (
  SELECT l_orderkey, min(l_suppkey) AS first_supp, count(*) AS n_lines,
         sum(l_quantity) AS qty, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey),
arrivals AS (
  SELECT CAST(o.o_orderkey AS DOUBLE) AS cicid,
         CAST(year(o.o_orderdate) AS DOUBLE) AS i94yr,
         CAST(month(o.o_orderdate) AS DOUBLE) AS i94mon,
         CAST(s.s_nationkey AS DOUBLE) AS i94cit,
         CAST(c.c_nationkey AS DOUBLE) AS i94res,
         {sc('s.s_suppkey')} AS i94port,
         CAST(date_diff('day', DATE '1960-01-01', CAST(o.o_orderdate AS DATE)) AS DOUBLE) AS arrdate,
         CAST(substr(o.o_orderpriority, 1, 1) AS DOUBLE) AS i94mode,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE {nc('c.c_nationkey')} END AS i94addr,
         CASE WHEN l.n_lines = 1 THEN CAST(0 AS DOUBLE)
              ELSE CAST(date_diff('day', DATE '1960-01-01', CAST(l.last_ship AS DATE)) AS DOUBLE)
                   + CAST(0.25 AS DOUBLE) END AS depdate,
         l.qty / CAST(l.n_lines AS DOUBLE) AS i94bir,
         CAST(ascii(c.c_mktsegment) - 64 AS DOUBLE) AS i94visa,
         strftime(o.o_orderdate, '%Y%m%d') AS dtadfile,
         o.o_orderstatus AS visapost,
         substr(c.c_mktsegment, 1, 3) AS occup,
         o.o_orderstatus AS entdepa,
         substr(o.o_orderpriority, 1, 1) AS entdepd,
         CAST(NULL AS VARCHAR) AS entdepu,
         'M' AS matflag,
         CAST(year(o.o_orderdate) AS DOUBLE) - floor(l.qty / CAST(l.n_lines AS DOUBLE)) AS biryear,
         strftime(l.last_ship, '%m%d%Y') AS dtaddto,
         CASE WHEN o.o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(NULL AS VARCHAR) AS insnum,
         CAST(l.n_lines AS VARCHAR) AS airline,
         CAST(o.o_orderkey AS DOUBLE) * CAST(1000003 AS DOUBLE) + CAST(c.c_custkey AS DOUBLE) AS admnum,
         CAST(l.first_supp AS VARCHAR) AS fltno,
         substr(c.c_mktsegment, 1, 2) AS visatype
  FROM orders o
  JOIN line_summary l ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.first_supp = s.s_suppkey)"""

CONFORMED = f"""{US_STATE},
{COUNTRY},
{I94MODE},
{I94VISA},
{ARRIVALS},
conformed AS (
  SELECT a.cicid, a.i94yr AS year, a.i94mon AS month, a.i94port AS port_of_entry,
         {iso_day('a.arrdate')} AS arrival_date,
         {iso_day('a.depdate')} AS departure_date,
         a.i94bir AS age, a.dtadfile, a.visapost, a.occup, a.entdepa, a.entdepd, a.entdepu,
         a.matflag, a.biryear, a.dtaddto, a.gender, a.insnum, a.airline, a.admnum, a.fltno,
         a.visatype, m.mode, v.visa, st.state_code, st.state_name,
         rc.country_name AS residence_country, bc.country_name AS birth_country,
         CAST(CAST(a.i94yr AS INTEGER) AS VARCHAR)
           || lpad(CAST(CAST(a.i94mon AS INTEGER) AS VARCHAR), 2, '0') AS i94dt
  FROM arrivals a
  JOIN i94mode m ON a.i94mode = {key_double('m.i94mode')}
  JOIN i94visa v ON a.i94visa = {key_double('v.i94visa')}
  JOIN us_state st ON a.i94addr = st.state_code
  JOIN country rc ON a.i94res = {key_double('rc.country_code')}
  JOIN country bc ON a.i94cit = {key_double('bc.country_code')}
  WHERE m.mode = 'URGENT')"""

IMMIGRANT_COLS = """TRY_CAST(trunc(cicid) AS INTEGER) AS cicid, TRY_CAST(trunc(age) AS INTEGER) AS age,
         occup, TRY_CAST(trunc(biryear) AS INTEGER) AS birth_year, birth_country,
         residence_country, gender, visapost, visa, visatype, i94dt"""

IMMIGRATION_COLS = """TRY_CAST(trunc(cicid) AS INTEGER) AS cicid, TRY_CAST(trunc(year) AS INTEGER) AS year,
         TRY_CAST(trunc(month) AS INTEGER) AS month, port_of_entry, arrival_date,
         departure_date, dtadfile, entdepa, entdepd, entdepu, matflag, dtaddto, insnum,
         airline, admnum, TRY_CAST(trunc(admnum) AS BIGINT) AS admnuml, fltno, state_code,
         state_name, i94dt"""

FACTS = f"""{CONFORMED},
immigrant AS (SELECT {IMMIGRANT_COLS} FROM conformed),
immigration AS (SELECT {IMMIGRATION_COLS} FROM conformed)"""

MART = f"""{FACTS},
{US_PORTS},
{AIRPORTS},
{CITY},
airport_city AS (
  SELECT a.airport_code, a.name, a.city, c.population, c.median_age
  FROM airports a JOIN city c
    ON lower(a.city) = c.city AND a.state_code = c.state_code AND a.state_name = c.state_name),
events AS (
  SELECT i.cicid, i.arrival_date, i.departure_date, i.port_of_entry AS airport_code, ac.name,
         ac.city, i.state_code, i.state_name, ac.population, ac.median_age, i.i94dt
  FROM immigration i JOIN airport_city ac ON i.port_of_entry = ac.airport_code),
mart AS (
  SELECT p.cicid, p.age, p.birth_country, p.residence_country, p.gender, p.visatype, p.visa,
         p.i94dt, e.arrival_date, e.departure_date, e.airport_code, e.name, e.city,
         e.state_code, e.state_name, e.population, e.median_age
  FROM immigrant p JOIN events e ON p.cicid = e.cicid AND p.i94dt = e.i94dt)"""

DIMS = f"""{US_STATE},
{US_PORTS},
{AIRPORTS},
{CITY}"""


def w(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


# ------------------------------------------------------------------ queries
def _coords_sql() -> str:
    return """coords AS (
  SELECT s_suppkey,
         CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_suppkey AS DOUBLE) END AS latitude,
         CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_nationkey AS DOUBLE) END AS longitude
  FROM supplier)"""


def _day_numbers_sql() -> str:
    days = "CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE)"
    return f"""dn AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 10 = 0 THEN CAST(0 AS DOUBLE)
              WHEN o_orderkey % 10 = 1 THEN NULL
              WHEN o_orderkey % 10 = 2 THEN -{days} + CAST(0.5 AS DOUBLE)
              ELSE {days} + o_totalprice / CAST(1000000 AS DOUBLE) END AS day_number
  FROM orders)"""


def _run_counts() -> str:
    return """SELECT i94dt, CAST(count(*) AS BIGINT) AS rows, 'immigration' AS "table"
FROM immigration GROUP BY i94dt
UNION ALL
SELECT i94dt, CAST(count(*) AS BIGINT) AS rows, 'immigrant' AS "table"
FROM immigrant GROUP BY i94dt"""


PERIOD_KEY = "199701"

ORACLES = {
    # A sources
    "label_scan": w(CUSTOMER_LINES, """SELECT trim(raw_code) AS code,
       trim(replace(raw_label, '''', '')) AS label FROM customer_lines"""),
    "csv_semicolon_scan": w(DEMOGRAPHIC_ROWS, """SELECT City AS city, state_code, median_age,
       population, race FROM demographic_rows"""),
    "csv_comma_scan": w(AIRPORT_ROWS, """SELECT ident, type, iso_country, iata_code,
       lat_value AS latitude, lon_value AS longitude FROM airport_rows"""),
    "period_source": w(ARRIVALS, """SELECT CAST(cicid AS BIGINT) AS cicid,
       CAST(CAST(i94yr AS INTEGER) AS VARCHAR) || lpad(CAST(CAST(i94mon AS INTEGER) AS VARCHAR), 2, '0') AS i94dt,
       i94port, arrdate FROM arrivals"""),
    "table_scan": w(FACTS, "SELECT * FROM immigration"),
    "period_pruned_read": w(FACTS, f"SELECT * FROM immigration WHERE i94dt = '{PERIOD_KEY}'"),
    # B sinks
    "full_refresh": "SELECT * FROM part",
    "partitioned_refresh": w(WEATHER, "SELECT * FROM weather"),
    "period_rerun": w(FACTS, "SELECT * FROM immigrant"),
    # C
    "rename_select_cast": """SELECT CAST(o_orderkey AS INTEGER) AS order_id, o_totalprice AS total,
       CAST(trunc(o_totalprice) AS INTEGER) AS total_int,
       CAST(trunc(o_totalprice) AS BIGINT) AS total_long,
       strftime(o_orderdate, '%Y%m') AS i94dt, '199701' AS run_period FROM orders""",
    # D
    "conjunctive_filter": w(AIRPORT_ROWS, """SELECT ident, type, iata_code FROM airport_rows
WHERE iso_country = 'US' AND type <> 'closed' AND iata_code <> 'null'"""),
    "equality_filter": "SELECT event_id, user_id, value FROM events WHERE event_type = 'click'",
    "mode_filter": w(I94MODE, f"""SELECT o.o_orderkey, m.mode FROM orders o
JOIN i94mode m ON CAST(substr(o.o_orderpriority, 1, 1) AS DOUBLE) = {key_double('m.i94mode')}
WHERE m.mode = 'URGENT'"""),
    # E
    "using_join": """SELECT o_custkey AS custkey, o_orderkey, o_totalprice, c_name, c_nationkey
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "coerced_lookup": w(COUNTRY, f"""SELECT c.c_custkey, k.country_name FROM customer c
JOIN country k ON CAST(c.c_nationkey AS DOUBLE) = {key_double('k.country_code')}"""),
    "named_lookup": w(US_STATE, f"""SELECT c.c_custkey, s.state_code, s.state_name
FROM customer c JOIN us_state s
  ON (CASE WHEN c.c_acctbal < 0 THEN NULL ELSE {nc('c.c_nationkey')} END) = s.state_code"""),
    "role_playing_dim": w(f"{COUNTRY},\n{ARRIVALS}", f"""SELECT a.cicid,
       r.country_name AS residence_country, b.country_name AS birth_country
FROM arrivals a
JOIN country r ON a.i94res = {key_double('r.country_code')}
JOIN country b ON a.i94cit = {key_double('b.country_code')}"""),
    "multi_key_join": w(DIMS, """SELECT a.airport_code, a.name, a.city, c.population, c.median_age
FROM airports a JOIN city c
  ON lower(a.city) = c.city AND a.state_code = c.state_code AND a.state_name = c.state_name"""),
    "replace_side_columns": w(MART, """SELECT cicid, airport_code, city, state_code, state_name,
       i94dt FROM events"""),
    # F
    "strip_quotes": w(CUSTOMER_LINES, "SELECT replace(raw_label, '''', '') AS label FROM customer_lines"),
    "keep_class": """SELECT p_partkey,
       regexp_replace(p_brand, '[^A-Z]', '', 'g') AS upper_only,
       regexp_replace(p_name, '[^A-Za-z]', '', 'g') AS letters_only,
       regexp_replace(p_brand || ' ' || p_type, '[^A-Za-z0-9]', '', 'g') AS alnum_only
FROM part""",
    "invalid_labels": w(CUSTOMER_LINES, """SELECT trim(raw_code) AS country_code,
       regexp_replace(trim(replace(raw_label, '''', '')),
                      '^INVALID.*|Collapsed.*|No Country.*', 'INVALID', 'g') AS country_name
FROM customer_lines"""),
    "trim_spaces": """SELECT s_suppkey, trim('  ' || s_name || chr(9) || '  ') AS trimmed,
       trim(chr(9) || ' ' || s_name || ' ') AS tab_kept FROM supplier""",
    "split_item": """SELECT p_partkey, string_split(p_name, ' ')[1] AS word0,
       string_split(p_name, ' ')[2] AS word1, string_split(p_name, ' ')[3] AS word2 FROM part""",
    "lower_clean": """SELECT s_suppkey AS k, lower(replace(chr(9) || s_name || chr(9), chr(9), '')) AS v,
       'supplier' AS src FROM supplier
UNION ALL
SELECT c_custkey AS k, lower(trim('  ' || c_name || ' ')) AS v, 'customer' AS src FROM customer""",
    "day_number_date": w(_day_numbers_sql(), f"""SELECT o_orderkey, day_number,
       {iso_day('day_number')} AS iso_date FROM dn"""),
    "date_parts": """WITH d AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'not-a-date'
                          ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dt FROM orders)
SELECT o_orderkey, dt, CAST(year(TRY_CAST(dt AS DATE)) AS INTEGER) AS year,
       CAST(month(TRY_CAST(dt AS DATE)) AS INTEGER) AS month,
       CAST(day(TRY_CAST(dt AS DATE)) AS INTEGER) AS day FROM d""",
    "capitalise": """SELECT p_partkey AS k, upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS v,
       'part' AS src FROM part
UNION ALL
SELECT c_custkey, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)),
       'customer' FROM customer""",
    "coord_first": w(_coords_sql(), "SELECT s_suppkey, latitude FROM coords"),
    "coord_second": w(_coords_sql(), "SELECT s_suppkey, longitude FROM coords"),
    "region_state": f"""SELECT s_suppkey,
       CASE WHEN s_suppkey % 6 = 0 THEN NULL
            WHEN s_suppkey % 6 = 1 THEN {nc('s_nationkey')} || '-X'
            ELSE {nc('s_nationkey')} END AS state FROM supplier""",
    # G
    "us_state": w(US_STATE, "SELECT * FROM us_state"),
    "country": w(COUNTRY, "SELECT * FROM country"),
    "us_ports": w(f"{US_STATE},\n{US_PORTS}", "SELECT * FROM us_ports"),
    "mode": w(I94MODE, "SELECT * FROM i94mode"),
    "visa": w(I94VISA, "SELECT * FROM i94visa"),
    "weather_month": w(WEATHER, "SELECT * FROM weather"),
    "airports": w(DIMS, "SELECT * FROM airports"),
    "city": w(DIMS, "SELECT * FROM city"),
    "city_distinct": w(DIMS, """SELECT * FROM city QUALIFY row_number() OVER (
  PARTITION BY state_code, city ORDER BY median_age NULLS FIRST, population NULLS FIRST, state_name NULLS FIRST) = 1"""),
    "conform": w(CONFORMED, "SELECT * FROM conformed"),
    "immigrant": w(FACTS, "SELECT * FROM immigrant"),
    "immigration": w(FACTS, "SELECT * FROM immigration"),
    "arrivals_by_city": w(MART, "SELECT * FROM mart"),
    "arrivals_by_city_joined": w(MART, "SELECT * FROM mart"),
    "arrivals_by_city_one_pass": w(MART, "SELECT * FROM mart"),
    "stored_mart": w(MART, "SELECT * FROM mart"),
    "mart_duplicate_ids": w(MART, """SELECT p.cicid, p.age, p.birth_country, p.residence_country, p.gender, p.visatype,
       p.visa, p.i94dt, e.arrival_date, e.departure_date, e.airport_code, e.name, e.city,
       e.state_code, e.state_name, e.population, e.median_age
FROM (SELECT * FROM immigrant UNION ALL SELECT * REPLACE ('X' AS gender) FROM immigrant WHERE cicid % 3 = 0) p
JOIN (SELECT * FROM events UNION ALL SELECT * FROM events WHERE cicid % 3 = 0) e
  ON p.cicid = e.cicid AND p.i94dt = e.i94dt"""),
    "stored_us_state": w(US_STATE, "SELECT * FROM us_state"),
    "stored_country": w(COUNTRY, "SELECT * FROM country"),
    "stored_us_ports": w(f"{US_STATE},\n{US_PORTS}", "SELECT * FROM us_ports"),
    "stored_weather": w(WEATHER, "SELECT * FROM weather"),
    "stored_airports": w(DIMS, "SELECT * FROM airports"),
    "stored_city": w(DIMS, "SELECT * FROM city"),
    # H
    "nonempty_by_period": w(FACTS, "SELECT i94dt, CAST(count(*) AS BIGINT) AS rows FROM immigration GROUP BY i94dt"),
    "publication_check": w(f"{MART},\n{WEATHER}", """SELECT 'weather' AS "table", true AS has_marker,
       (SELECT count(*) FROM weather) AS rows
UNION ALL SELECT 'airports', true, (SELECT count(*) FROM airports)
UNION ALL SELECT 'city', true, (SELECT count(*) FROM city)
UNION ALL SELECT 'immigration', true, (SELECT count(*) FROM immigration)
UNION ALL SELECT 'immigrant', true, (SELECT count(*) FROM immigrant)
UNION ALL SELECT 'never_written', false, 0"""),
    "gate_after_empty_rerun": w(MART, """SELECT 'immigration' AS "table",
       (SELECT count(*) FROM immigration WHERE i94dt = '199701') AS rows_before,
       (SELECT count(*) FROM immigration WHERE i94dt = '199701') AS rows_after, true AS gate_failed
UNION ALL SELECT 'immigrant', (SELECT count(*) FROM immigrant WHERE i94dt = '199701'),
       (SELECT count(*) FROM immigrant WHERE i94dt = '199701'), true
UNION ALL SELECT 'immigration_demographics', (SELECT count(*) FROM mart WHERE i94dt = '199701'),
       (SELECT count(*) FROM mart WHERE i94dt = '199701'), true"""),
    "preview": w(FACTS, "SELECT * FROM immigration ORDER BY cicid LIMIT 5"),
    "period_params": """SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS period_key,
       lower(strftime(o_orderdate, '%b%y')) AS period_token FROM orders""",
    "run_month": w(MART, f"SELECT * FROM mart WHERE i94dt = '{PERIOD_KEY}'"),
    "backfill": w(FACTS, _run_counts()),
    # R
    "r1": w(MART, """SELECT i94dt, residence_country, CAST(count(*) AS BIGINT) AS visitors
FROM mart GROUP BY i94dt, residence_country"""),
    "r2": w(MART, """SELECT i94dt, city, state_code, CAST(count(*) AS BIGINT) AS visitors,
       CAST(count(DISTINCT airport_code) AS BIGINT) AS airports
FROM mart GROUP BY i94dt, city, state_code"""),
    "r3": w(MART, """SELECT city, state_code, CAST(count(*) AS BIGINT) AS visitors,
       max(TRY_CAST(population AS BIGINT)) AS population,
       max(TRY_CAST(median_age AS DOUBLE)) AS median_age
FROM mart GROUP BY city, state_code"""),
    "r4": w(WEATHER, """SELECT city, Month, avg(TRY_CAST(AverageTemperature AS DOUBLE)) AS avg_temperature,
       CAST(count(TRY_CAST(AverageTemperature AS DOUBLE)) AS BIGINT) AS readings
FROM weather GROUP BY city, Month"""),
    "r5": w(MART, """SELECT visa, visatype, city, CAST(count(*) AS BIGINT) AS travellers,
       avg(age) AS avg_age FROM mart GROUP BY visa, visatype, city"""),
}

ORACLES["stream_ingest"] = w(FACTS, "SELECT * FROM immigration")

# Records judged by membership, independent of the joins: the first code that is unknown.
JUDGED = f"""{CONFORMED},
judged AS (
  SELECT a.*, CAST(CAST(a.i94yr AS INTEGER) AS VARCHAR)
      || lpad(CAST(CAST(a.i94mon AS INTEGER) AS VARCHAR), 2, '0') AS i94dt,
    CASE WHEN i94mode IS NULL OR i94mode NOT IN (SELECT {key_double('i94mode')} FROM i94mode) THEN 'mode'
         WHEN i94mode NOT IN (SELECT {key_double('i94mode')} FROM i94mode WHERE mode = 'URGENT') THEN 'mode_label'
         WHEN i94visa IS NULL OR i94visa NOT IN (SELECT {key_double('i94visa')} FROM i94visa) THEN 'visa'
         WHEN i94addr IS NULL OR i94addr NOT IN (SELECT state_code FROM us_state) THEN 'state'
         WHEN i94res IS NULL OR i94res NOT IN (SELECT {key_double('country_code')} FROM country) THEN 'residence'
         WHEN i94cit IS NULL OR i94cit NOT IN (SELECT {key_double('country_code')} FROM country) THEN 'birth'
    END AS rejected_by
  FROM arrivals a)"""

URGENT_MONTHS = "SELECT DISTINCT strftime(o_orderdate, '%Y%m') FROM orders WHERE substr(o_orderpriority, 3) = 'URGENT'"

_CHANGED = f"""{MART},
{WEATHER},
changed AS (SELECT * FROM mart WHERE i94dt <> '{PERIOD_KEY}' OR cicid % 2 = 0)"""

_PUBLISHED = """SELECT '{step}' AS step, 'immigration' AS "table", CAST({version} AS INTEGER) AS version,
  (SELECT count(*) FROM immigration WHERE i94dt = '199701'{cut}) AS rows, {failed} AS gate_failed
UNION ALL SELECT '{step}', 'immigrant', {version}, (SELECT count(*) FROM immigrant WHERE i94dt = '199701'{cut}), {failed}
UNION ALL SELECT '{step}', 'immigration_demographics', {version},
  (SELECT count(*) FROM mart WHERE i94dt = '199701'{cut}), {failed}"""

_DELIVERIES = """kept AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
older AS (
  SELECT * FROM kept WHERE o_orderkey % 20 <> 1
  UNION ALL SELECT * FROM kept WHERE o_orderkey % 20 = 2 UNION ALL SELECT * FROM kept WHERE o_orderkey % 20 = 5),
newer AS (
  SELECT * REPLACE (CASE WHEN o_orderkey % 20 = 4 THEN 'X' ELSE o_orderstatus END AS o_orderstatus)
  FROM kept WHERE o_orderkey % 20 <> 3
  UNION ALL SELECT * REPLACE (CAST(NULL AS DOUBLE) AS o_totalprice) FROM kept WHERE o_orderkey % 20 = 5
  UNION ALL SELECT * FROM kept WHERE o_orderkey % 20 = 6),
gained AS (SELECT * FROM newer EXCEPT ALL SELECT * FROM older),
lost AS (SELECT * FROM older EXCEPT ALL SELECT * FROM newer),
new_keys AS (SELECT o_orderkey, count(*) AS n FROM gained GROUP BY o_orderkey),
old_keys AS (SELECT o_orderkey, count(*) AS n FROM lost GROUP BY o_orderkey)"""

ORACLES |= {
    "rejected_records": w(JUDGED, """SELECT cicid, i94dt, i94port, i94addr, rejected_by FROM judged
WHERE rejected_by IS NOT NULL"""),
    "reject_audit": w(JUDGED, """SELECT rejected_by, CAST(count(*) AS BIGINT) AS records, CAST(count(*) AS BIGINT) AS rows, i94dt
FROM judged GROUP BY rejected_by, i94dt"""),
    "reject_reconciliation": w(JUDGED, f"""SELECT i94dt, CAST(count(*) AS BIGINT) AS read,
  CAST(count(*) FILTER (rejected_by IS NULL) AS BIGINT) AS kept,
  CAST(count(*) FILTER (rejected_by IS NOT NULL) AS BIGINT) AS rejected, true AS balanced
FROM judged WHERE i94dt IN ({URGENT_MONTHS}) GROUP BY i94dt"""),
    "publish_cycle": w(MART, "\nUNION ALL ".join([
        _PUBLISHED.format(step="published", version=1, cut="", failed="false"),
        _PUBLISHED.format(step="broken rerun", version=1, cut="", failed="true"),
        _PUBLISHED.format(step="good rerun", version=2, cut=" AND cicid % 2 = 0", failed="false")])),
    "asof_temperature": w(f"{I94MODE},\n{ARRIVALS},\n{WEATHER}", f""",
readings AS (
  SELECT lower(city) AS city, CAST(date AS DATE) AS day, max(TRY_CAST(AverageTemperature AS DOUBLE)) AS temperature
  FROM weather WHERE TRY_CAST(AverageTemperature AS DOUBLE) IS NOT NULL GROUP BY ALL),
asked AS (
  SELECT a.cicid, m.mode AS city, {iso_day('a.arrdate')} AS arrival_date
  FROM arrivals a JOIN i94mode m ON a.i94mode = {key_double('m.i94mode')})
SELECT asked.cicid, asked.city, asked.arrival_date, readings.temperature, readings.day AS measured_on
FROM asked ASOF LEFT JOIN readings ON lower(asked.city) = readings.city AND CAST(asked.arrival_date AS DATE) >= readings.day"""),
    "presence_by_state": w(FACTS, """,
stays AS (
  SELECT state_code, CAST(arrival_date AS DATE) AS a, CAST(departure_date AS DATE) AS d FROM immigration
  WHERE arrival_date IS NOT NULL AND (departure_date IS NULL OR departure_date >= arrival_date)),
ends AS (SELECT min(a) AS lo, max(greatest(a, coalesce(d, a))) AS hi FROM stays),
days AS (
  SELECT state_code, CAST(unnest(range(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT DISTINCT state_code FROM stays), ends)
SELECT days.state_code, days.day, CAST(count(s.a) AS BIGINT) AS present, CAST(count(*) FILTER (s.a = days.day) AS BIGINT) AS arrived,
  CAST((SELECT count(*) FROM stays g WHERE g.state_code = days.state_code AND g.d + 1 = days.day) AS BIGINT) AS "left"
FROM days LEFT JOIN stays s ON s.state_code = days.state_code AND days.day BETWEEN s.a AND coalesce(s.d, DATE '9999-12-31')
GROUP BY days.state_code, days.day"""),
    "top_origins": w(MART, """SELECT i94dt, city, residence_country, CAST(count(*) AS BIGINT) AS visitors,
  CAST(row_number() OVER (PARTITION BY i94dt, city ORDER BY count(*) DESC, residence_country NULLS FIRST) AS INTEGER) AS place
FROM mart GROUP BY i94dt, city, residence_country QUALIFY place <= 5"""),
    "report_totals": w(MART, """SELECT i94dt, residence_country, city, state_code, visa, visatype,
  CAST(count(*) AS BIGINT) AS visitors, CAST(count(DISTINCT airport_code) AS BIGINT) AS airports, avg(age) AS avg_age,
  CAST(GROUPING(i94dt, residence_country, city, state_code, visa, visatype) AS BIGINT) AS grouping_id
FROM mart GROUP BY GROUPING SETS (
  (i94dt, residence_country), (i94dt), (), (i94dt, city, state_code), (i94dt, city),
  (visa, visatype, city), (visa, visatype), (visa))"""),
    "reports_by_parts": w(_CHANGED, """SELECT 'r1' AS report, i94dt AS key0, residence_country AS key1, CAST(NULL AS VARCHAR) AS key2,
  CAST(count(*) AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS value0, CAST(NULL AS DOUBLE) AS value1
FROM changed GROUP BY i94dt, residence_country
UNION ALL SELECT 'r2', i94dt, city, state_code, count(*), CAST(count(DISTINCT airport_code) AS DOUBLE), NULL
FROM changed GROUP BY i94dt, city, state_code
UNION ALL SELECT 'r3', city, state_code, NULL, count(*), CAST(max(TRY_CAST(population AS BIGINT)) AS DOUBLE),
  max(TRY_CAST(median_age AS DOUBLE)) FROM changed GROUP BY city, state_code
UNION ALL SELECT 'r4', city, CAST(Month AS VARCHAR), NULL, count(TRY_CAST(AverageTemperature AS DOUBLE)),
  avg(TRY_CAST(AverageTemperature AS DOUBLE)), NULL FROM weather GROUP BY city, Month
UNION ALL SELECT 'r5', visa, visatype, city, count(*), avg(age), NULL FROM changed GROUP BY visa, visatype, city"""),
    "sketch_estimates": w(MART, """SELECT city, CAST(count(*) AS BIGINT) AS visits,
  CAST(count(DISTINCT i94dt || '/' || CAST(cicid AS VARCHAR)) AS BIGINT) AS travellers, true AS distinct_within, true AS median_within
FROM mart GROUP BY city"""),
    "delivery_changes": w(_DELIVERIES, """SELECT CASE WHEN l.n IS NULL THEN 'added' ELSE 'corrected' END AS change,
  CAST(count(*) AS BIGINT) AS copies, g.o_orderkey, g.o_custkey, g.o_orderstatus, g.o_totalprice
FROM gained g LEFT JOIN old_keys l USING (o_orderkey) GROUP BY ALL
UNION ALL SELECT 'removed', CAST(count(*) AS BIGINT), l.o_orderkey, l.o_custkey, l.o_orderstatus, l.o_totalprice
FROM lost l LEFT JOIN new_keys g USING (o_orderkey) WHERE g.n IS NULL GROUP BY ALL"""),
    "event_windows": """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, CAST(count(*) AS BIGINT) AS events,
  min(value) AS lowest, max(value) AS highest, CAST(sum(CAST(value AS DECIMAL(28,4))) AS DOUBLE) AS total
FROM events GROUP BY ALL""",
}
