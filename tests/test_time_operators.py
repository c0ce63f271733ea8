"""As-of join and presence per day against plain Python and DuckDB."""

import datetime as dt
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from wayfare.operators.asof import asof_join
from wayfare.operators.presence import presence_per_day
from wayfare.plans.temperature import arrivals_with_temperature

DAY0 = dt.date(2015, 12, 1)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def readings_and_questions(seed):
    rng = random.Random(seed)
    keys = ["hot", "a", "b", None, "only asked"]
    right = [(rng.choice(keys[:4]), day(rng.choice([None, *range(0, 300)])), rng.choice([None, 1.5, 2.5, -3.0]), rng.choice(["x", None]))
             for _ in range(150)] + [("quiet", day(-4000), 9.0, "old")]
    left = [(k, "hot" if k % 3 == 0 else rng.choice(keys), day(rng.choice([None, *range(-20, 330)]))) for k in range(300)]
    left += [(900, "quiet", day(5)), (901, "quiet", day(-4001)), (902, "quiet", day(-4000))] + left[:5]
    return left, right


def plain_asof(left, right, max_age=None):
    def order(r):
        return tuple((v is not None, v) for v in r[2:])

    out = []
    for k, key, at in left:
        fit = [r for r in right if key is not None and at is not None and r[0] == key and r[1] is not None and r[1] <= at]
        fit.sort(key=lambda r: (r[1], order(r)))
        best = fit[-1] if fit and (max_age is None or (at - fit[-1][1]).days <= max_age) else None
        out.append((k, key, at, *((best[2], best[3], best[1]) if best else (None, None, None))))
    return Counter(out)


@pytest.mark.parametrize(("width", "max_age"), [(None, None), (1, None), (7, 10), (100_000, 0)])
def test_asof_against_plain_python(spark, width, max_age):
    left, right = readings_and_questions(width or 3)
    l = spark.createDataFrame(left, "id int, city string, day date").repartition(3)
    r = spark.createDataFrame(right, "city string, taken date, t double, note string").repartition(3)
    got = asof_join(l, r, ["city"], "day", right_on="taken", range_width=width, max_age=max_age, time_name="taken")
    assert got.columns == ["id", "city", "day", "t", "note", "taken"]
    assert Counter(map(tuple, got.collect())) == plain_asof(left, right, max_age)
    inner = asof_join(l, r, ["city"], "day", right_on="taken", how="inner", range_width=width, max_age=max_age, time_name="taken")
    assert Counter(map(tuple, inner.collect())) == Counter({k: n for k, n in plain_asof(left, right, max_age).items() if k[5] is not None})


def test_asof_on_timestamps_and_numbers(spark):
    at = dt.datetime(2024, 1, 1, 12)
    left = spark.createDataFrame([(1, at), (2, at + dt.timedelta(microseconds=1)), (3, at - dt.timedelta(days=90))], "k int, at timestamp")
    right = spark.createDataFrame([(at + dt.timedelta(microseconds=1), "new"), (at - dt.timedelta(days=80), "old")], "at timestamp, v string")
    found = asof_join(left.withColumn("x", F.lit(1)), right.withColumn("x", F.lit(1)), ["x"], "at", range_width=60).collect()
    assert {r.k: r.v for r in found} == {1: "old", 2: "new", 3: None}
    aged = asof_join(left.withColumn("x", F.lit(1)), right.withColumn("x", F.lit(1)), ["x"], "at", max_age=86400).collect()
    assert {r.k: r.v for r in aged} == {1: None, 2: "new", 3: None}
    left = spark.createDataFrame([(1, 1.0), (1, float("nan")), (1, -7.5), (1, None)], "x int, at double")
    right = spark.createDataFrame([(1, -8.0, "a"), (1, float("nan"), "n"), (1, 1.0, "b")], "x int, at double, v string")
    found = asof_join(left, right, ["x"], "at").collect()
    assert sorted((str(r.at), r.v) for r in found) == [("-7.5", "a"), ("1.0", "b"), ("None", None), ("nan", None)]


def test_asof_refuses_and_bears_empty_sides(spark):
    left = spark.createDataFrame([("a", dt.date(2020, 1, 1), 1)], "city string, day date, t int")
    right = spark.createDataFrame([("a", dt.date(2020, 1, 1), 1.0)], "city string, day date, t double")
    with pytest.raises(ValueError, match="duplicate"):
        asof_join(left, right, ["city"], "day")
    with pytest.raises(ValueError, match="how"):
        asof_join(left.drop("t"), right, ["city"], "day", how="right")
    with pytest.raises(ValueError, match="text"):
        asof_join(left.drop("t").withColumn("day", F.lit("2020-01-01")), right, ["city"], "day")
    with pytest.raises(ValueError, match="kind"):
        asof_join(left.drop("t").withColumn("day", F.col("day").cast("timestamp")), right, ["city"], "day")
    assert [tuple(r) for r in asof_join(left.drop("t"), right.limit(0), ["city"], "day").collect()] == [("a", dt.date(2020, 1, 1), None)]
    assert asof_join(left.drop("t").limit(0), right, ["city"], "day").collect() == []


def test_asof_sorts_distinct_questions_in_ranges_of_a_key(spark):
    left, right = readings_and_questions(1)
    l = spark.createDataFrame(left, "id int, city string, day date")
    r = spark.createDataFrame(right, "city string, taken date, t double, note string")
    text = plan(asof_join(l, r, ["city"], "day", right_on="taken"))
    assert "hashpartitioning(__k0" in text and "__range" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_temperatures_of_arrivals(spark):
    weather = spark.createDataFrame(
        [("New york", "2012-01-01", "1.5", "0.2"), ("New york", "2013-01-01", None, None), ("New york", "not-a-date", "4", "1"),
         ("Alcan", "2015-12-31", "-7", "0.1"), ("Alcan", "2015-12-31", "-6.5", "0.3"), (None, "2015-12-31", "3", "0.1")],
        "city string, date string, AverageTemperature string, AverageTemperatureUncertainty string")
    arrivals = spark.createDataFrame([(1, "new york", "2016-01-05"), (2, "alcan", "2015-12-31"), (3, "alcan", "2015-12-30"),
                                      (4, None, "2016-01-01"), (5, "nowhere", "2016-01-01"), (6, "alcan", None)],
                                     "cicid int, city string, arrival_date string")
    found = {r.cicid: (r.temperature, r.uncertainty, r.measured_on) for r in arrivals_with_temperature(arrivals, weather).collect()}
    assert found == {1: (1.5, 0.2, dt.date(2012, 1, 1)), 2: (-6.5, 0.3, dt.date(2015, 12, 31)), 3: (None, None, None),
                     4: (None, None, None), 5: (None, None, None), 6: (None, None, None)}
    fresh = {r.cicid: r.temperature for r in arrivals_with_temperature(arrivals, weather, max_age_days=30).collect()}
    assert fresh[1] is None and fresh[2] == -6.5


# ------------------------------------------------------------------ presence
def stays_of(seed):
    rng = random.Random(seed)
    stays = []
    for k in range(400):
        start = rng.choice([None, *range(0, 200)])
        length = rng.choice([None, -3, 0, 0, 1, 5, 30, 150])
        stays.append(("hot" if k % 3 == 0 else rng.choice(["a", "b", None]), day(start),
                      None if start is None or length is None else day(start + length)))
    return stays + [("late", day(199), day(199)), ("bad", day(9), day(8)), ("nostart", None, day(8))] + stays[:7]


def plain_presence(stays, open_stays, first, last, inclusive):
    spans = [(k, a, b) for k, a, b in stays if a is not None and (b is None or b >= a) and not (b is None and open_stays == "drop")]
    if not spans:
        return {}
    lo = first or min(a for _, a, _ in spans)
    hi = last or max(max(a, b or a) for _, a, b in spans)
    out = {}
    groups = {k for k, a, b in spans}
    for k in groups:
        for n in range((hi - lo).days + 1):
            d = lo + dt.timedelta(days=n)
            here = sum(1 for g, a, b in spans if g == k and a <= d and (b is None or (d <= b if inclusive else d < b)))
            came = sum(1 for g, a, b in spans if g == k and a == d)
            gone = sum(1 for g, a, b in spans if g == k and b is not None and b + dt.timedelta(days=int(inclusive)) == d)
            out[k, d] = (here, came, gone)
    return out


@pytest.mark.parametrize(("open_stays", "first", "last", "inclusive"), [
    ("to_last", None, None, True), ("drop", None, None, False), ("to_last", day(50), day(120), True), ("drop", day(190), day(500), True),
    ("to_last", day(10), day(9), True)])
def test_presence_against_plain_python(spark, open_stays, first, last, inclusive):
    stays = stays_of(4)
    df = spark.createDataFrame(stays, "city string, arrived_on date, left_on date").repartition(3)
    got = presence_per_day(df, "arrived_on", "left_on", ["city"], open_stays=open_stays, first_day=first and first.isoformat(),
                           last_day=last and last.isoformat(), count_last_day=inclusive).collect()
    found = {(r.city, r.day): (r.present, r.arrived, r.left) for r in got}
    assert len(found) == len(got)
    assert found == plain_presence(stays, open_stays, first, last, inclusive)


def test_presence_without_groups_as_text_and_empty(spark):
    stays = spark.createDataFrame([("2016-01-01", "2016-01-03"), ("2016-01-03", None), ("oops", "2016-01-03")], "a string, b string")
    got = [tuple(r) for r in presence_per_day(stays, "a", "b").orderBy("day").collect()]
    assert [(str(d), n, i, o) for d, n, i, o in got] == [("2016-01-01", 1, 1, 0), ("2016-01-02", 1, 0, 0), ("2016-01-03", 2, 1, 0)]
    assert presence_per_day(stays.limit(0), "a", "b").collect() == []
    with pytest.raises(ValueError, match="duplicate"):
        presence_per_day(stays.withColumn("day", F.lit(1)), "a", "b", ["day"])


def test_presence_never_spreads_stays_over_their_days(spark):
    """Half a million days of stay from a thousand stays: no operator makes that many rows."""
    stays = spark.range(1000).select(F.lit("2000-01-01").cast("date").alias("a"), F.date_add(F.lit("2000-01-01").cast("date"), F.lit(499)).alias("b"))
    df = presence_per_day(stays, "a", "b")
    assert df.agg(F.sum("present")).first()[0] == 500_000
    text = plan(df)
    assert "NestedLoop" not in text and "CartesianProduct" not in text and "partial_sum" in text


def test_presence_equals_a_range_join(spark):
    stays = stays_of(11)
    got = presence_per_day(spark.createDataFrame(stays, "city string, a date, b date"), "a", "b", ["city"], open_stays="drop")
    con = duckdb.connect()
    con.execute("CREATE TABLE stays (city VARCHAR, a DATE, b DATE)")
    con.executemany("INSERT INTO stays VALUES (?, ?, ?)", stays)
    want = con.execute("""
        WITH s AS (SELECT * FROM stays WHERE a IS NOT NULL AND b >= a),
        days AS (SELECT DISTINCT city, unnest(range((SELECT min(a) FROM s)::TIMESTAMP, (SELECT max(b) FROM s)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS d FROM s)
        SELECT days.city, d, count(s.a) FROM days LEFT JOIN s ON s.city IS NOT DISTINCT FROM days.city AND d BETWEEN a AND b GROUP BY ALL""").fetchall()
    assert {(r.city, r.day): r.present for r in got.collect()} == {(c, d): n for c, d, n in want}
