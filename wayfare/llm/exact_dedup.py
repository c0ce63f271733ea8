"""Exact deduplication of texts, with frequent texts taken out of the shuffle.

Texts are equal when they are identical without ASCII white space.  A
Misra-Gries pass (``freqItems``) over the digests names the ones that may hold
more than a small share of all rows; at most ``1 / support`` of them exist.
Their exact sizes and winners are computed by a map-side aggregation and
broadcast, so that their rows are decided where they are; all other digests go
through an ordinary shuffle.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import free_name, stage

# The characters [\x20\x09-\x0D], deleted before texts are compared.
WHITE_SPACE = " \t\n\x0b\x0c\r"
SUPPORT = 1 / 512  # share of all rows above which a digest counts as frequent


def normalised(text: Column) -> Column:
    """The text without its ASCII white space; null counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    for char in WHITE_SPACE:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, lowercase hex."""
    return F.sha2(normalised(text), 256)


def _order() -> Column:
    """Smaller is better: most code points, then smallest id (null last), then first row."""
    return F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"),
                    F.col("doc_id"), F.col("row"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     support: float = SUPPORT) -> DataFrame:
    """Decide for every row whether it stays.

    Of the rows with equal texts the one with the most code points in its
    original text stays, then the one with the smallest doc_id.  Null and empty
    texts are equal.  Null ids lose against others.  Of rows that agree in id and
    text (repeated rows) exactly one stays.  Other columns are not looked at.  An
    empty table gives an empty result.

    Returns one row per input row: doc_id, keep_id (doc_id of the row that
    stays), group_size, kept, text_sha256.
    """
    text = F.col(text_col).cast("string")
    rows = stage(docs.select(
        F.col(id_col).alias("doc_id"),
        F.char_length(F.coalesce(text, F.lit(""))).alias("chars"),
        F.unhex(text_digest(F.col(text_col))).alias("digest"),
        F.monotonically_increasing_id().alias("row")), "digests")

    # Counters of the Misra-Gries pass: at most 1 / support of them.
    hashed = rows.withColumn("h", F.xxhash64("digest"))
    candidates = hashed.stat.freqItems(["h"], support).select(F.explode("h_freqItems").alias("h"))
    frequent = stage(
        hashed.join(F.broadcast(candidates), "h", "left_semi")
        .groupBy("digest").agg(F.count("*").alias("group_size"), F.min(_order()).alias("best"))
        .filter(F.col("group_size") > rows.count() * support), "frequent")

    decided_here = rows.join(F.broadcast(frequent), "digest")
    same = Window.partitionBy("digest")
    shuffled = (rows.join(F.broadcast(frequent.select("digest")), "digest", "left_anti")
                .withColumn("group_size", F.count("*").over(same))
                .withColumn("best", F.min(_order()).over(same)))
    columns = ["doc_id", F.col("best.doc_id").alias("keep_id"), F.col("group_size"),
               (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")]
    return decided_here.select(columns).unionByName(shuffled.select(columns))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row is recognised by id and digest; of several rows with the id and digest
    of the row that stays, the first by length and text is taken.
    """
    digest, rank, kept_id, kept_digest = (free_name(docs, c) for c in ("digest", "rank", "kept_id", "kept_digest"))
    kept = (exact_duplicates(docs, id_col, text_col).filter("kept")
            .select(F.col("doc_id").alias(kept_id), F.unhex("text_sha256").alias(kept_digest)))
    keyed = docs.withColumn(digest, F.unhex(text_digest(F.col(text_col))))
    stays = keyed.join(kept, F.col(digest).eqNullSafe(F.col(kept_digest))
                       & F.col(id_col).eqNullSafe(F.col(kept_id)), "left_semi")
    first = Window.partitionBy(digest, id_col).orderBy(
        F.char_length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).desc(), F.col(text_col))
    return stays.withColumn(rank, F.row_number().over(first)).filter(F.col(rank) == 1).drop(digest, rank)
