"""Dropped arrival records, kept with the first lookup that dropped them.

The conform (G9) is five inner lookups and a filter on the travel mode: a
record that fails one of them is gone without a trace.  Here the same lookups
are left outer joins of one pass; each record ends either among the accepted
rows, which are those of ``facts.conform_arrivals``, or once among the rejected
ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import outer_lookup
from ..schemas import AUDIT
from .facts import decode_arrivals, record_period

# The lookups in the order in which the conform applies them.
REASONS = ("mode", "mode_label", "visa", "state", "residence", "birth")
LOOKED_UP = ["mode", "visa", "state_code", "state_name", "residence_country", "birth_country"]


def classify_arrivals(arrivals: DataFrame, modes: DataFrame, visas: DataFrame, states: DataFrame,
                      countries: DataFrame, *, mode_label: str = "Air") -> DataFrame:
    """Every record with what its lookups found, and why it is dropped.

    Adds the looked-up columns, ``rejected_by`` (one of ``REASONS``; null: kept)
    and ``first_copy``.  A code that occurs several times in its table multiplies
    the record, as an inner lookup does; exactly one of the copies of a record
    has ``first_copy``, so copies never count as records.  A record is dropped by
    ``mode`` if its mode code is null or unknown, by ``mode_label`` if the code
    means another travel mode, by the other reasons if that code is null or
    unknown; the first reason counts.  Repeated records are records of their own.
    """
    mode_codes = modes.select("i94mode").distinct()
    name = {"country_name": "residence_country"}
    steps = [
        ("mode", mode_codes, "i94mode", "i94mode", {}),
        ("mode_label", modes.filter(F.col("mode") == mode_label), "i94mode", "i94mode", {"mode": "mode"}),
        ("visa", visas, "i94visa", "i94visa", {"visa": "visa"}),
        ("state", states, "i94addr", "state_code", {"state_code": "state_code", "state_name": "state_name"}),
        ("residence", countries, "i94res", "country_code", name),
        ("birth", countries, "i94cit", "country_code", {"country_name": "birth_country"}),
    ]
    df = arrivals
    for reason, dim, fact_key, dim_key, columns in steps:
        df = outer_lookup(df, dim, fact_key, dim_key, columns, f"__found_{reason}")
    found = {reason: F.col(f"__found_{reason}") for reason in REASONS}
    first_failed = F.coalesce(*[F.when(nth.isNull(), F.lit(reason)) for reason, nth in found.items()])
    first_copy = reduce(lambda a, b: a & b, [F.coalesce(nth, F.lit(1)) == 1 for nth in found.values()])
    return df.withColumns({"rejected_by": first_failed, "first_copy": first_copy}).drop(
        *[f"__found_{reason}" for reason in REASONS])


def accepted(classified: DataFrame, period: str | None = None) -> DataFrame:
    """The rows and columns of ``facts.conform_arrivals``; ``i94dt`` is taken from the rows where they have it."""
    kept = classified.filter("rejected_by is null").drop("rejected_by", "first_copy")
    stamped = F.col("i94dt") if "i94dt" in kept.columns else F.lit(period) if period else record_period()
    df = decode_arrivals(kept).drop("i94mode", "i94visa", "i94addr", "i94res", "i94cit").withColumn("i94dt", stamped)
    source = [c for c in df.columns if c not in LOOKED_UP and c != "i94dt"]
    return df.select(*source, *LOOKED_UP, "i94dt")


def rejected(classified: DataFrame) -> DataFrame:
    """Each dropped record once, as it was read, with the reason and its month."""
    dropped = classified.filter("rejected_by is not null and first_copy")
    if "i94dt" not in dropped.columns:
        dropped = dropped.withColumn("i94dt", record_period("i94yr", "i94mon"))
    return dropped.select(*AUDIT["rejected_arrivals"].names)


def audit(classified: DataFrame) -> DataFrame:
    """Records (copies once) and rows of each month by reason; reason null: kept.  Combined per task."""
    if "i94dt" not in classified.columns:
        classified = classified.withColumn("i94dt", record_period("i94yr", "i94mon"))
    return classified.groupBy("rejected_by", "i94dt").agg(
        F.count_if("first_copy").alias("records"), F.count(F.lit(1)).alias("rows")).select(
        *AUDIT["arrival_audit"].names)


def reconcile(audited: DataFrame, read: DataFrame) -> DataFrame:
    """Per month: records read from the files, kept and rejected ones, and whether they add up.

    ``read`` has i94dt and ``records``, counted on the files themselves; a month
    that only one side knows does not add up.
    """
    totals = audited.groupBy("i94dt").agg(
        F.coalesce(F.sum(F.when(F.col("rejected_by").isNull(), F.col("records"))), F.lit(0)).alias("kept"),
        F.coalesce(F.sum(F.when(F.col("rejected_by").isNotNull(), F.col("records"))), F.lit(0)).alias("rejected"))
    both = read.select("i94dt", F.col("records").alias("read")).join(
        totals, read["i94dt"].eqNullSafe(totals["i94dt"]), "full").select(
        F.coalesce(read["i94dt"], totals["i94dt"]).alias("i94dt"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("read", "kept", "rejected")])
    return both.withColumn("balanced", F.col("read") == F.col("kept") + F.col("rejected"))
