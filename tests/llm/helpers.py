"""Small tables with the awkward cases that every operator must bear."""

import random

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "xx", "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def with_clashes(docs):
    """Extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F
    names = ["token", "hi", "lo", "cid", "row", "digest", "rank", "key", "shard", "cell", "spans", "items", "read",
             "lang_pred", "ids", "start", "gone_id", "kept_id", "mark", "n"]
    return docs.select("*", *[F.lit("z").alias(n) for n in names])


def words(rng: random.Random, count: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(count)]


def awkward(rng: random.Random) -> list[tuple]:
    """Null, empty, wordless, short, very long, tied and repeated rows."""
    long = " ".join(words(rng, 30_000))
    return [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (6, long), (7, long), (8, "!!! ???"),
            (9, "Ünï cödé tèxt ßß"), (9, "Ünï cödé tèxt ßß"), (None, "no id here"), (None, None), (10, "one two ")]
