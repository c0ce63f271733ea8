"""Top k, grouping sets, deliveries, sketches and report parts against plain Python and full rebuilds."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wayfare.operators.deliveries import compare_deliveries
from wayfare.operators.topk import top_k_per_group
from wayfare.operators.totals import cube_sets, grouped_totals, rollup_sets
from wayfare.plans import report_parts, reports, sketches
from wayfare.sinks.parquet import write_period
from wayfare.sources.tables import read_table


def plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def visits(rng, n=600):
    return [("hot" if k % 3 == 0 else rng.choice(["a", "b", None]), rng.choice(["X", "Y", "Z", None]), rng.choice([None, 1, 2, 3]),
             rng.choice([None, -1, 0, 5, 7])) for k in range(n)]


VISITS = "city string, origin string, airport int, age int"


# ------------------------------------------------------------------- top k
@pytest.mark.parametrize("ties", ["rows", "rank", "dense"])
def test_top_k_against_plain_python(spark, ties):
    rows = visits(random.Random(1), 200)
    df = spark.createDataFrame(rows, VISITS)
    got = top_k_per_group(df, ["city"], [F.desc_nulls_last("age"), F.asc_nulls_first("origin"), F.asc_nulls_first("airport")], 4, ties=ties)
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    wanted = Counter()
    for own in groups.values():
        def key(r):
            return (-(r[3] if r[3] is not None else -100), r[1] or "", r[2] or 0)
        own.sort(key=key)
        distinct = sorted({key(r) for r in own})
        for at, r in enumerate(own):
            place = {"rows": at, "rank": [key(x) for x in own].index(key(r)), "dense": distinct.index(key(r))}[ties] + 1
            if place <= 4:
                wanted[(*r, place)] += 1
    assert Counter(map(tuple, got.collect())) == wanted


def test_top_k_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), "id")
    text = plan(top_k_per_group(df, ["g"], [F.desc("id")], 3))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text
    assert top_k_per_group(df.limit(0), ["g"], [F.desc("id")], 3).collect() == []
    for wrong in ({"ties": "x"}, {"name": "ID"}, {"k": 0}):
        with pytest.raises(ValueError):
            top_k_per_group(df, ["g"], [F.desc("id")], **({"k": 3} | wrong))


def test_top_origins_tie_rule(spark):
    rows = [("201601", "ny", c) for c in ["B", "A", "C", "C", None]]
    got = reports.top_origins(spark.createDataFrame(rows, "i94dt string, city string, residence_country string"), 3)
    assert [(r.residence_country, r.visitors, r.place) for r in got.orderBy("place").collect()] == [("C", 2, 1), (None, 1, 2), ("A", 1, 3)]


# ----------------------------------------------------------------- totals
def plain_totals(rows, dims, sets):
    out = {}
    for s in {tuple(c for c in dims if c in own) for own in sets}:
        groups = defaultdict(list)
        for r in rows:
            groups[tuple(r[dims.index(c)] if c in s else None for c in dims)].append(r)
        mask = sum(1 << (len(dims) - 1 - i) for i, c in enumerate(dims) if c not in s)
        for key, own in groups.items():
            ages = [r[3] for r in own if r[3] is not None]
            out[(*key, mask)] = (len(own), len(ages), sum(ages) if ages else None, min(ages, default=None), max(ages, default=None),
                                 sum(ages) / len(ages) if ages else None, len({r[2] for r in own} - {None}))
    return out


@pytest.mark.parametrize("sets", [cube_sets(["city", "origin"]), rollup_sets(["city", "origin"]), [["origin"], ["origin"], []], [["city"]]])
def test_totals_against_plain_python(spark, sets):
    rows = visits(random.Random(2))
    got = grouped_totals(spark.createDataFrame(rows, VISITS), ["city", "origin"], sets, {
        "n": ("count", "*"), "known": ("count", "age"), "total": ("sum", "age"), "lo": ("min", "age"), "hi": ("max", "age"),
        "mean": ("avg", "age"), "airports": ("distinct", "airport")}).collect()
    found = {(r.city, r.origin, r.grouping_id): (r.n, r.known, r.total, r.lo, r.hi, r["mean"], r.airports) for r in got}
    assert len(found) == len(got) and found == plain_totals(rows, ["city", "origin"], sets)


def test_totals_read_the_rows_once_and_expand_the_aggregate(spark, tmp_root):
    spark.createDataFrame(visits(random.Random(3)), VISITS).write.parquet(f"{tmp_root}/v")
    df = grouped_totals(spark.read.parquet(f"{tmp_root}/v"), ["city", "origin"], cube_sets(["city", "origin"]), {"n": ("count", "*")})
    text = plan(df)
    assert text[:text.index("== Initial Plan ==")].count("FileScan parquet") == 1 if "== Initial Plan ==" in text else True
    final = text.split("== Initial Plan ==")[0]
    # from the scan upwards: aggregate, and only then the expansion
    assert final.index("Expand") < final.rindex("partial_count") < final.rindex("FileScan")


def test_totals_of_nothing_and_wrong_names(spark):
    df = spark.createDataFrame([], VISITS)
    assert grouped_totals(df, ["city"], [["city"]], {"n": ("count", "*")}).collect() == []
    for sets, measures in (([["nope"]], {"n": ("count", "*")}), ([["city"]], {"City": ("count", "*")}), ([["city"]], {"n": ("median", "age")})):
        with pytest.raises(ValueError):
            grouped_totals(df, ["city"], sets, measures)


# ------------------------------------------------------------- deliveries
def plain_changes(old, new, key):
    gained, lost = Counter(new) - Counter(old), Counter(old) - Counter(new)
    by_key = defaultdict(lambda: [0, 0])
    for r, n in gained.items():
        by_key[r[key]][0] += n
    for r, n in lost.items():
        by_key[r[key]][1] += n
    return gained, lost, {k: min(v) for k, v in by_key.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deliveries_against_multisets(spark, seed):
    rng = random.Random(seed)

    def delivery():
        return [(rng.choice([1, 2, 3, None, *range(4, 30)]), rng.choice(["x", "y", None]), rng.choice([1.5, None, -0.5])) for _ in range(150)]

    old = delivery()
    new = old[:100] + delivery()[:60] + old[:5]
    schema = "id int, v string, w double"
    got = compare_deliveries(spark.createDataFrame(old, schema).repartition(3), spark.createDataFrame(new, schema).select("w", "id", "v"), ["id"]).collect()
    gained, lost, pairs = plain_changes(old, new, 0)
    found = defaultdict(Counter)
    for r in got:
        found[r.change][(r.id, r.v, r.w)] += r.copies
    assert found["added"] + found["corrected"] == gained
    assert not found["removed"] - lost
    corrected = Counter()
    for r, n in found["corrected"].items():
        corrected[r[0]] += n
    assert corrected == Counter({k: n for k, n in pairs.items() if n})
    assert sum(found["removed"].values()) == sum(lost.values()) - sum(pairs.values())


def test_equal_empty_and_wrong_deliveries(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (None, None)], "id int, v string")
    assert compare_deliveries(a, a, ["id"]).collect() == []
    assert compare_deliveries(a.limit(0), a.limit(0), ["id"]).collect() == []
    assert sorted(tuple(r) for r in compare_deliveries(a.limit(0), a, ["id"]).filter("id is not null").collect()) == [("added", 2, 1, "x")]
    with pytest.raises(ValueError):
        compare_deliveries(a, a.drop("v"), ["id"])
    with pytest.raises(ValueError):
        compare_deliveries(a, a, ["nope"])


def test_null_and_text_null_are_different_records(spark):
    old = spark.createDataFrame([(1, None), (2, "null"), (3, "")], "id int, v string")
    new = spark.createDataFrame([(1, "null"), (2, None), (3, None)], "id int, v string")
    assert {(r.change, r.id, r.v) for r in compare_deliveries(old, new, ["id"]).collect()} == {
        ("corrected", 1, "null"), ("corrected", 2, None), ("corrected", 3, None)}


# --------------------------------------------------- sketches, report parts
MART = ("cicid int, age int, residence_country string, visatype string, visa string, airport_code string, city string, state_code string, "
        "population string, median_age string, i94dt string")


def mart_rows(seed, n=3000):
    rng = random.Random(seed)
    return [(k // 2, rng.choice([None, *range(1, 90)]), rng.choice(["A", "B", "INVALID"]), rng.choice(["B1", "WT"]), rng.choice(["Business", "Pleasure"]),
             rng.choice(["P1", "P2"]), "hot" if k % 3 == 0 else rng.choice(["ny", "la"]), rng.choice(["NY", "CA"]), rng.choice(["100", "x", None]),
             rng.choice(["30.5", None]), rng.choice(["201601", "201602", "201603"])) for k in range(n)]


def stored_mart(spark, root, rows):
    df = spark.createDataFrame(rows, MART)
    full = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in (
        (f.name, f.dataType) for f in __import__("wayfare.schemas", fromlist=["x"]).IMMIGRATION_DEMOGRAPHICS)])
    write_period(full, f"{root}/mart")
    return read_table(spark, f"{root}/mart", "immigration_demographics")


def test_sketches_are_within_their_bounds_and_mergeable(spark, tmp_root):
    rows = mart_rows(5, 40_000)
    mart = stored_mart(spark, tmp_root, rows)
    sketches.store_sketches(mart, f"{tmp_root}/sk", ["201601", "201602", "201603"])
    stored = sketches.read_sketches(spark, f"{tmp_root}/sk")
    for first, last in ((None, None), ("201602", "201603"), ("201601", "201601")):
        wanted = [r for r in rows if (first or "0") <= r[10] <= (last or "9")]
        for r in sketches.merged_estimates(stored, ["city"], first, last).collect():
            own = [x for x in wanted if x[6] == r.city]
            exact = len({(x[10], x[0]) for x in own})
            ages = sorted(x[1] for x in own if x[1] is not None)
            assert r.visits == len(own) and r.n_ages == len(ages)
            assert abs(r.travellers - exact) <= sketches.DISTINCT_ERROR * exact
            for q, value in ((0.25, r.age_25), (0.5, r.age_50), (0.75, r.age_75)):
                below, up_to = sum(a < value for a in ages) / len(ages), sum(a <= value for a in ages) / len(ages)
                assert below - sketches.RANK_ERROR <= q <= up_to + sketches.RANK_ERROR
    # a month that is run again replaces its rows and no others
    sketches.store_sketches(mart.filter("cicid < 50"), f"{tmp_root}/sk", ["201602"])
    again = {r.i94dt: r.visits for r in sketches.read_sketches(spark, f"{tmp_root}/sk").groupBy("i94dt").agg(F.sum("visits").alias("visits")).collect()}
    counts = Counter(r[10] for r in rows)
    assert again == {"201601": counts["201601"], "201603": counts["201603"], "201602": sum(r[10] == "201602" and r[0] < 50 for r in rows)}


def test_sketches_of_unknown_ages_and_of_nothing(spark, tmp_root):
    mart = stored_mart(spark, tmp_root, [(1, None, "A", "B1", "Business", "P1", "ny", "NY", None, None, "201601")])
    sketches.store_sketches(mart, f"{tmp_root}/sk", ["201601"])
    merged = sketches.merged_estimates(sketches.read_sketches(spark, f"{tmp_root}/sk"), ["city"])
    assert [tuple(r) for r in merged.collect()] == [("ny", 1, 1, 0, None, None, None)]
    assert sketches.merged_estimates(sketches.read_sketches(spark, f"{tmp_root}/sk"), ["city"], "201701").collect() == []


def same(a, b):
    def rows(df):
        return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*a.columns).collect())
    assert rows(a) == rows(b)


def test_reports_from_parts_equal_a_rebuild_after_a_rerun(spark, tmp_root):
    rows = mart_rows(6)
    mart = stored_mart(spark, tmp_root, rows)
    months = ["201601", "201602", "201603"]
    report_parts.store_parts(mart, f"{tmp_root}/r", months)
    changed = [r for r in rows if r[10] != "201602"] + [r for r in mart_rows(7) if r[10] == "201602"][:100]
    now = stored_mart(spark, f"{tmp_root}/again", changed)
    report_parts.store_parts(now, f"{tmp_root}/r", ["201602"])
    root = f"{tmp_root}/r"
    same(report_parts.visitors_by_country(spark, root), reports.visitors_by_country(now))
    same(report_parts.visitors_by_city(spark, root), reports.visitors_by_city(now))
    same(report_parts.city_demographics(spark, root), reports.city_demographics(now))
    same(report_parts.traveller_types(spark, root), reports.traveller_types(now))
    # a month that has lost all its rows has no part left
    report_parts.store_parts(now.filter("i94dt <> '201603'"), root, ["201603"])
    same(report_parts.traveller_types(spark, root), reports.traveller_types(now.filter("i94dt <> '201603'")))
    weather = spark.createDataFrame([("ny", 1, "2.5"), ("ny", 1, None), ("la", 2, "x")], "city string, Month int, AverageTemperature string")
    report_parts.store_temperature_part(weather, root)
    same(report_parts.monthly_temperature(spark, root), reports.monthly_temperature(weather))


def test_a_rerun_reads_one_month_of_the_mart(spark, tmp_root):
    mart = stored_mart(spark, tmp_root, mart_rows(8, 300))
    own = mart.filter(F.col("i94dt").isin(["201602"]))
    text = plan(report_parts.PARTS["types"](own))
    assert re.search(r"PartitionFilters: \[[^\]]*201602", text)
    assert "ReadSchema: struct<age:int,visatype:string,visa:string,city:string>" in text
