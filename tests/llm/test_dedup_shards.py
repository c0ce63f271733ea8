import hashlib
import random
import re
import zlib

import pytest

from wayfare.llm import exact_dedup, histogram_shards

from .helpers import DOCS, awkward, documents, with_clashes


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = awkward(rng)
    for k in range(300):  # one group of copies holds a third of the rows
        out.append((100 + k, f"hot  text{' ' * (k % 3)}" if k % 3 == 0 else f"text {k % 90} of {k % 7}"))
    return out


def test_exact_duplicates_against_plain_python(spark, rows):
    got = exact_dedup.exact_duplicates(with_clashes(documents(spark, rows))).collect()
    groups = {}
    for doc_id, text in rows:
        key = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()
        groups.setdefault(key, []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    assert len(got) == len(rows)
    for row in got:
        own = groups[row["text_sha256"]]
        assert row["group_size"] == len(own)
        assert row["keep_id"] == min(own)[3]
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_kept_rows_are_whole_rows(spark, rows):
    docs = with_clashes(documents(spark, rows))
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == exact_dedup.exact_duplicates(docs).filter("kept").count()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert exact_dedup.drop_exact_duplicates(empty).count() == 0
    assert histogram_shards.histogram_shards(empty).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_shards_are_near_equal_and_whole(spark, hot):
    rng = random.Random(7)
    rows = [(k, "x" * rng.randrange(1, 400) if not (hot and k % 3 == 0) else "the same text" * 9) for k in range(3000)]
    got = histogram_shards.histogram_shards(with_clashes(documents(spark, rows)), 8).collect()
    texts = dict(rows)
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    sizes, slots = [0] * 8, [[] for _ in range(8)]
    for r in got:
        text = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    ideal = sum(sizes) / 8
    assert max(abs(s - ideal) for s in sizes) <= 0.01 * ideal + 400
    assert all(sorted(s) == list(range(len(s))) for s in slots)


def test_shards_of_awkward_rows(spark, rows):
    got = histogram_shards.histogram_shards(documents(spark, rows), 4).collect()
    assert len(got) == len(rows)
    assert [r["size"] for r in got if r["doc_id"] == 1] == [1]
    for shard in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(
            range(sum(r["shard"] == shard for r in got)))


def test_copies_stay_together_where_that_is_near_enough(spark):
    rows = [(k, f"text number {k // 2} " * 5) for k in range(4000)]
    got = histogram_shards.histogram_shards(documents(spark, rows), 4).collect()
    shards = {}
    for r in got:
        shards.setdefault(r["doc_id"] // 2, set()).add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) == 0


def test_write_shards_reads_back(spark, tmp_path, rows):
    docs = documents(spark, [(k, f"t{k}") for k in range(50)])
    histogram_shards.write_shards(docs, histogram_shards.histogram_shards(docs, 4), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 50 and set(docs.columns) <= set(back.columns)
