"""A training corpus from raw documents, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import decontaminate, exact_dedup, jaccard_join, language_id, packing
from wayfare.llm.staging import free_name, stage

# A stage that searches for near copies says "similar" by five words and 0.8.
NEAR_WORDS, NEAR_PERCENT = 5, 80


# What predict_language calls its own columns.
PREDICTED = ("lang_pred", "score", "entropy", "accepted")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that no language model accepts go, and those without a letter (null and empty ones).

    Each row is judged by its own text; repeated rows stay or go together, null
    ids and languages are fine (a null language is not learned from), columns of
    any name come back as they were, an empty table gives an empty one.
    """
    model = language_id.train_language_model(docs.filter(~language_id.held_out(F.col("doc_id"))))
    aside = {c: free_name(docs, f"own_{c}") for c in docs.columns if c.lower() in PREDICTED}
    found = language_id.predict_language(docs.withColumnsRenamed(aside), model).filter("accepted")
    return found.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays: most code points, then smallest id (null last).

    Null and empty texts are equal; of repeated rows one stays; columns of any
    name come back; an empty table gives an empty one.
    """
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Null ids come last, equal ids go by their texts' digests; rows equal in id and
    text are one document; texts without words stay; columns of any name come
    back; an empty table gives an empty one.
    """
    return jaccard_join.keep_one_per_group(docs, NEAR_WORDS, NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one word in twenty is benchmark text go.

    Texts are judged, whatever their ids; null and empty texts stay, as do all
    where the benchmark is empty; repeated rows stay or go together; columns of
    any name come back.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, in sequences of at most 2048 tokens; a row per piece.

    A null or empty text is its end id alone; null ids are kept, repeated rows are
    packed as often as they occur; an empty table gives no piece.
    """
    return packing.pack_documents(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "tier", "step_group")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("packing", pack),
]

#: The models, the similarity components and the tokenizer are beyond SQL;
#: tests/llm/test_pipeline.py holds the stages against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is a staged table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
