"""Hand-typed fixtures in the source file formats (tab shown as \\t)."""

STATE_LINES = [
    "\t'AL'='ALABAMA'",
    "\t'AK'='ALASKA'",
    "\t'NY'='NEW YORK'",
    "\t'99'='All Other Codes' ;",
    "",
]

COUNTRY_LINES = [
    "   236 =  'AFGHANISTAN'",
    "   101 =  'ALBANIA'",
    "   0 =  'INVALID: STATELESS'",
    "   103 =  'Collapsed Somewhere (should not show)'",
    "   730 =  'No Country Code (730)'",
    "   135 =  'UNITED KINGDOM'",
    "   438 =  'AUSTRALIA '",
    "   582 =  'MEXICO, LAND ONLY'",
]

PORT_LINES = [
    "   'ALC'\t=\t'ALCAN, AK             '",
    "   'NYC'\t=\t'NEW YORK, NY          '",
    "   '5KE'\t=\t'KETCHIKAN, AK         '",
    "   'XXX'\t=\t'NO COMMA PLACE        '",
    "   'DBL'\t=\t'TWO, COMMAS, NY'",
    "   'BPS'\t=\t'BOUNDARY, AL (BPS)'",
    "   'ARP'\t=\t'SOMEWHERE, AL #ARPT'",
    "   'CP '\t=\t'CAPE POINT, NY'",
    "   'FOR'\t=\t'PARIS, FRANCE'",
]

MODE_LINES = ["\t1 = 'Air'", "\t2 = 'Sea'", "\t3 = 'Land'", "\t9 = 'Not reported'"]
VISA_LINES = ["   1 = Business", "   2 = Pleasure", "   3 = Student"]

WEATHER_CSV = """dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude
1743-11-01,6.068,1.737,NEW YORK,United States,40.99N,74.56W
2013-01-01,,,NEW YORK,United States,40.99N,74.56W
2013-02-01,1.5,0.3,,United States,40.99N,74.56W
2013-03-01,9.1,0.2,Paris,France,48.87N,2.27E
2013-04-01,12.0,0.4,los angeles,United States,34.56N,118.70W
not-a-date,3.0,0.1,Anchorage,United States,61.88N,151.13W
"""

AIRPORTS_CSV = """ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,gps_code,iata_code,local_code,coordinates
K1,large_airport,Alcan Field,100,NA,US,US-AK,Alcan,PAAL,ALC,ALC,"-141.1, 62.9"
K2,closed,Old Field,10,NA,US,US-NY,New York,KOLD,NYC,,"-73.7, 40.6"
K3,,No Type Field,10,NA,US,US-NY,New York,KNTF,NYC,,"-73.8, 40.7"
K4,small_airport,No Iata,10,NA,US,US-NY,New York,KNOI,,,"-73.9, 40.8"
K5,small_airport,Null Text,10,NA,US,US-NY,New York,KNUL,null,,"-73.9, 40.8"
K6,medium_airport,Kennedy,13,NA,US,US-NY,New York,KJFK,NYC,JFK,"-73.77, 40.64"
K7,heliport,Kennedy Heli,13,NA,US,US-U-A,New York,KJFH,NYC,JFH,
K8,small_airport,Ketchikan,90,NA,US,US-AK,Ketchikan,PAKT,KE,KTN,-131.7
K9,small_airport,Elsewhere,90,NA,CA,CA-BC,Vancouver,CYVR,CP,,"-123.1, 49.2"
K10,small_airport,Cape Point,5,NA,US,US-NY,Cape Point,KCPT,CP,,"-70.1, 41.1"
"""

DEMOGRAPHICS_CSV = """City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count
  New York ;New York;36.0;1;1;8550405;1;1;2.6;NY;White;1
New York;New York;36.0;1;1;8550405;1;1;2.6;NY;Asian;1
Alcan;Alaska;40.0;1;1;120;1;1;2.1;AK;White;1
Ketchikan;Alaska;38.5;1;1;8000;1;1;2.2;AK;White;1
Gotham;Nowhere;30.0;1;1;10;1;1;2.0;ZZ;White;1
"""

# Arrival records: (cicid, i94yr, i94mon, i94cit, i94res, i94port, arrdate, i94mode, i94addr,
# depdate, i94bir, i94visa, biryear, admnum, gender, visatype)
ARRIVAL_ROWS = [
    (1.0, 2016.0, 1.0, 236.0, 101.0, "NYC", 20454.0, 1.0, "NY", 20460.0, 30.0, 1.0, 1986.0, 5.5e10, "F", "B1"),
    (2.0, 2016.0, 1.0, 135.0, 135.0, "NYC", 20455.0, 1.0, "NY", None, 41.0, 2.0, 1975.0, 1.0e9, "M", "WT"),
    (3.0, 2016.0, 1.0, 0.0, 103.0, "ALC", 20456.0, 1.0, "AK", 0.0, 25.7, 3.0, 1990.0, 3.0e11, "M", "F1"),
    (4.0, 2016.0, 1.0, 438.0, 438.0, "KE", 20457.0, 1.0, "AK", 20460.5, 60.0, 2.0, 1956.0, 4.0, "F", "WT"),
    (5.0, 2016.0, 1.0, 236.0, 236.0, "NYC", 20458.0, 2.0, "NY", 20470.0, 33.0, 1.0, 1983.0, 5.0, "F", "B1"),
    (6.0, 2016.0, 1.0, 236.0, 236.0, "NYC", 20458.0, 9.0, "NY", 20470.0, 33.0, 1.0, 1983.0, 6.0, "F", "B1"),
    (7.0, 2016.0, 1.0, 236.0, 236.0, "NYC", 20458.0, None, "NY", 20470.0, 33.0, 1.0, 1983.0, 7.0, "F", "B1"),
    (8.0, 2016.0, 1.0, 236.0, 236.0, "NYC", 20458.0, 1.0, None, 20470.0, 33.0, 1.0, 1983.0, 8.0, "F", "B1"),
    (9.0, 2016.0, 1.0, 236.0, 236.0, "NYC", 20458.0, 1.0, "99", 20470.0, 33.0, 1.0, 1983.0, 9.0, "F", "B1"),
    (10.0, 2016.0, 1.0, 236.0, 999.0, "NYC", 20458.0, 1.0, "NY", -5.5, 33.0, 1.0, 1983.0, 10.0, "F", "B1"),
    (11.0, 2016.0, 1.0, 730.0, 236.0, "ZZZ", 20458.0, 1.0, "NY", 20470.0, 33.0, 1.0, 1983.0, 11.0, "F", "B1"),
    (21.0, 2016.0, 2.0, 236.0, 101.0, "NYC", 20485.0, 1.0, "NY", 20490.0, 30.0, 1.0, 1986.0, 21.0, "F", "B1"),
    (22.0, 2016.0, 2.0, 101.0, 101.0, "CP", 20486.0, 1.0, "NY", 20490.0, 30.0, 2.0, 1986.0, 22.0, "M", "B2"),
]


def arrivals_df(spark, rows=ARRIVAL_ROWS):
    from pyspark.sql import functions as F
    from wayfare.schemas import ARRIVAL_ORDER, ARRIVALS
    cols = ["cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode",
            "i94addr", "depdate", "i94bir", "i94visa", "biryear", "admnum", "gender", "visatype"]
    df = spark.createDataFrame(rows, ", ".join(
        f"{c} {'string' if c in ('i94port', 'i94addr', 'gender', 'visatype') else 'double'}"
        for c in cols))
    extra = {c: F.lit(f"{c}_v") for c in ARRIVAL_ORDER if c not in cols}
    df = df.withColumns(extra)
    return df.select(*[F.col(c).cast(ARRIVALS[c].dataType) for c in ARRIVAL_ORDER])


def write_text(path, lines):
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
