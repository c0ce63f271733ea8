"""Visitor sketches by month and city, merged for any months without reading the mart again.

A stored row has two mergeable sketches: HyperLogLog of the travellers (distinct
records, which the mart repeats for each airport and city row) and KLL of their
ages.  Their sizes are fixed by ``LG_K`` and ``KLL_K``, however many rows a city
has; a month that is run again replaces its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.parquet import write_period

LG_K = 12          # 2**12 registers: relative standard error 1.04 / sqrt(4096), 1.6 %
KLL_K = 200        # rank error 1.65 % with 99 % confidence
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)     # three standard errors
RANK_ERROR = 0.0165

SKETCHES = "i94dt string, city string, state_code string, visits long, travellers binary, ages binary, n_ages long"


def traveller() -> Column:
    """A record of the mart: its id counts within its month."""
    return F.concat_ws("/", "i94dt", F.col("cicid").cast("string"))


def build_sketches(mart: DataFrame) -> DataFrame:
    """A row per month, city and state; per-task sketches are merged, so a hot city is one row of each task."""
    return mart.groupBy("i94dt", "city", "state_code").agg(
        F.count(F.lit(1)).alias("visits"), F.hll_sketch_agg(traveller(), LG_K).alias("travellers"),
        F.kll_sketch_agg_bigint(F.col("age").cast("long"), KLL_K).alias("ages"), F.count("age").alias("n_ages"))


def store_sketches(mart: DataFrame, path: str, periods: list[str]) -> None:
    """Write the sketches of these months; only their part of the mart is read."""
    built = build_sketches(mart.filter(F.col("i94dt").isin(periods)))
    write_period(built.select("city", "state_code", "visits", "travellers", "ages", "n_ages", "i94dt"), path, periods=periods)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SKETCHES).parquet(path)


def merged_estimates(sketches: DataFrame, by: list[str], first: str | None = None, last: str | None = None,
                     quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Visits, estimated travellers and age quantiles by ``by`` for the months ``first`` to ``last`` (yyyyMM).

    Quantiles are null where no age is known.  The estimate of travellers is
    within ``DISTINCT_ERROR`` of the count with 99.7 % confidence, a quantile's
    rank within ``RANK_ERROR`` with 99 %.
    """
    if first is not None:
        sketches = sketches.filter(F.col("i94dt") >= first)
    if last is not None:
        sketches = sketches.filter(F.col("i94dt") <= last)
    known = F.when(F.col("n_ages") > 0, F.col("ages"))
    merged = sketches.groupBy(*by).agg(
        F.sum("visits").alias("visits"), F.hll_sketch_estimate(F.hll_union_agg("travellers")).alias("travellers"),
        F.kll_merge_agg_bigint(known, KLL_K).alias("__ages"), F.sum("n_ages").alias("n_ages"))
    return merged.select(*by, "visits", "travellers", "n_ages", *[
        F.when(F.col("n_ages") > 0, F.kll_sketch_get_quantile_bigint("__ages", F.lit(q))).alias(f"age_{round(q * 100)}")
        for q in quantiles])
