"""What changed between two deliveries of the same records, repeated rows counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_digest(columns: list[str]) -> Column:
    """Digest of a row that tells nulls, types of text and column borders apart."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}), 256)


def compare_deliveries(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Records that one delivery has more often than the other: change, copies and the record.

    Both have the same columns.  As in EXCEPT ALL, a record that occurs 3 times
    in one and once in the other differs by 2 copies; nulls equal nulls.  Rows say
    ``added`` or ``removed``; where a key has both, as many of them as can be
    paired are ``corrected``: such a row is the new record of a key, ``removed``
    none of it.  (Of several new records of a key the ones with the smallest
    digests are the corrections.)  Null keys are keys like others.

    Only keys and digests of all rows are shuffled, counted per task first; whole
    records are read again for those that differ.  Equal deliveries and empty
    ones give an empty result.
    """
    columns = old.columns
    if sorted(columns) != sorted(new.columns):
        raise ValueError("deliveries differ in their columns")
    missing = [c for c in key if c not in columns]
    if missing:
        raise ValueError(f"no key column {missing}")
    new = new.select(*[F.col(f"`{c}`") for c in columns])
    keys = [f"__k{i}" for i in range(len(key))]

    def marked(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(key, keys)], row_digest(columns).alias("__digest"),
                         F.lit(sign).alias("__sign"))

    differs = (marked(old, -1).unionByName(marked(new, 1)).groupBy(*keys, "__digest").agg(F.sum("__sign").alias("__more"))
               .filter("__more <> 0"))
    # Which copies of a key can be paired: counts by key, and for each digest how many copies of its
    # side stand before it.  The running count has two levels, so that one key can be many tasks.
    own, side, slices = F.abs("__more"), F.signum("__more").cast("int"), F.substring("__digest", 1, 2)
    differs = differs.withColumns({"__own": own, "__side": side, "__slice": slices})
    counts = differs.groupBy(*keys, "__side", "__slice").agg(F.sum("__own").alias("__n"))
    earlier = Window.partitionBy(*keys, "__side").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__offset", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n").alias("o")
    sides = counts.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("__side") > 0, F.col("__n"))), F.lit(0)).alias("__gained"),
        F.coalesce(F.sum(F.when(F.col("__side") < 0, F.col("__n"))), F.lit(0)).alias("__lost")).alias("s")
    inside = Window.partitionBy(*keys, "__side", "__slice").orderBy("__digest").rowsBetween(Window.unboundedPreceding, -1)
    ranked = differs.withColumn("__before", F.coalesce(F.sum("__own").over(inside), F.lit(0))).alias("d")
    at_slice = [F.col(f"d.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [*keys, "__side", "__slice"]]
    of_key = [F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in keys]
    left_over = F.least("__gained", "__lost") - F.col("__before") - F.col("__offset")
    paired = ranked.join(offsets, at_slice).join(sides, of_key).select(
        "__digest", "__more", "__own", F.greatest(F.lit(0), F.least(F.col("__own"), left_over)).alias("__paired"))
    split = paired.select("__digest", "__more", F.explode(F.array(
        F.struct(F.when(F.col("__more") > 0, F.lit("corrected")).alias("change"), F.col("__paired").alias("copies")),
        F.struct(F.when(F.col("__more") > 0, F.lit("added")).otherwise(F.lit("removed")).alias("change"),
                 (F.col("__own") - F.col("__paired")).alias("copies")))).alias("c")).select("__digest", "__more", "c.*")
    split = split.filter("change is not null and copies > 0")

    def records(df: DataFrame, sign: int) -> DataFrame:
        wanted = split.filter(F.signum("__more") == sign).drop("__more")
        one = df.withColumn("__digest", row_digest(columns)).join(
            wanted.select("__digest").distinct(), "__digest", "left_semi").dropDuplicates(["__digest"])
        return one.join(wanted, "__digest").select("change", "copies", *[F.col(f"`{c}`") for c in columns])

    return records(new, 1).unionByName(records(old, -1))
