import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.llm import packing, token_files

from .helpers import DOCS, awkward, documents, with_clashes, words

tokenizers = pytest.importorskip("tokenizers")


def letters():
    """An encoder for tests: a character is a token."""
    return lambda text: [ord(c) % 50_000 + 2 for c in text]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    return awkward(rng) + [(100 + k, "x" * rng.randrange(0, 5000)) for k in range(400)] + [
        (900 + k, "same" * 300) for k in range(150)]


@pytest.mark.parametrize("block_tokens", [4_000_000, 3000])
def test_every_id_lies_in_one_piece(spark, rows, block_tokens):
    docs = with_clashes(documents(spark, rows)).repartition(3)
    pieces = [r.asDict() for r in packing.pack_documents(docs, letters, block_tokens=block_tokens).collect()]
    whole = {}
    for doc_id, text in rows:
        ids = np.array([*letters()(text or ""), 1], "<u4").tobytes()
        whole.setdefault(doc_id, []).append(ids)
    by_doc = {}
    for p in pieces:
        assert p["length"] * 4 == len(p["ids"])
        by_doc.setdefault(p["doc_id"], []).append(p)
    for doc_id, own in by_doc.items():
        if len(whole[doc_id]) > 1:  # repeated ids: compare lengths alone
            assert sum(p["length"] for p in own) * 4 == sum(map(len, whole[doc_id]))
            continue
        own.sort(key=lambda p: p["start"])
        assert b"".join(p["ids"] for p in own) == whole[doc_id][0]
        assert all(p["doc_tokens"] * 4 == len(whole[doc_id][0]) for p in own)
    assert by_doc.keys() == whole.keys()
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
    padding = 0
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= own[0]["tier"] <= 2048
        padding += own[0]["tier"] - at
    assert padding < 2048
    budget = {}
    for own in sequences.values():
        budget[own[0]["step_group"]] = budget.get(own[0]["step_group"], 0) + own[0]["tier"]
    assert max(budget.values()) <= packing.STEP_TOKENS + 2048


def test_fill_finds_exact_sums():
    counts = np.zeros(2049, np.int64)
    counts[[1500, 500, 48, 1000, 600, 300]] = 1
    assert sorted(packing._fill(counts, 1500, 548)) == [48, 500, 1500]
    assert packing._fill(counts, 1000, 1048) is None or sum(packing._fill(counts, 1000, 1048)) == 2048
    counts[1024] = 2
    assert packing._fill(counts, 1024, 1024) == [1024, 1024]
    counts[1024] = 1
    assert packing._fill(counts, 1024, 1024) != [1024, 1024]


def test_fast_encoder_gives_the_ids_of_the_tokenizer_file():
    public = pytest.importorskip("public_tokenizers")
    reference = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    encode, ordinary = packing.public_encoder(), packing.ordinary_encoder()
    rng = random.Random(3)
    alphabet = "aeinst AEI  \n\t\r.,!?'’ßéñ漢字ж😀👩‍👩‍👧\u200b\u00a0\x00\x1c0123456789-_=<|>"
    texts = ["", " ", "<|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", " x<|endoftext|>  y\n<|endoftext|>",
             "<|endoftext|", "<|<|endoftext|>|>", "it's we'll DON'T", "a" * 3000] + [
        "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200))) for _ in range(500)]
    texts += [rng.choice(texts)[:40] + "<|endoftext|>" + rng.choice(texts)[:40] for _ in range(200)]
    for text in texts:
        assert encode(text) == reference.encode(text, add_special_tokens=False).ids
        assert 50256 not in ordinary(text)
    reference.encode_special_tokens = True
    assert all(ordinary(text) == reference.encode(text, add_special_tokens=False).ids for text in texts)


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert packing.pack_documents(empty, letters).count() == 0
    assert token_files.document_token_counts(empty, letters).count() == 0


@pytest.mark.parametrize("block_tokens", [7, 1 << 18])
def test_token_counts_of_every_document(spark, rows, block_tokens):
    own = [r for r in rows if len(r[1] or "") < 300] + [(5000, "long " * 500)]
    docs = with_clashes(documents(spark, own)).repartition(3)
    got = token_files.document_token_counts(docs, letters, separator=1, block_tokens=block_tokens).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted((str(d), len(t or "")) for d, t in own)


def test_separators_at_block_edges(spark):
    rng = random.Random(8)
    for size in (1, 2, 3, 5):
        stream = [rng.choice([0, 0, 5, 6, 7]) for _ in range(40)]
        blocks = [("f", k // size, np.array(stream[k:k + size], "<u2").tobytes()) for k in range(0, 40, size)]
        blocks += [("g", 0, b""), ("g", 1, None), ("h", 0, np.array([4, 4], "<u2").tobytes())]
        table = spark.createDataFrame(blocks, "file string, block long, tokens binary").repartition(3)
        got = token_files.count_tokens(table, separator=0).orderBy("file", "ordinal").collect()
        parts, held = [], 0
        for token in stream:
            if token:
                held += 1
            else:
                parts.append((held, True))
                held = 0
        parts += [(held, False)] if held else []
        assert [(r["n_tokens"], r["complete"]) for r in got if r["file"] == "f"] == parts
        assert [r["ordinal"] for r in got if r["file"] == "f"] == list(range(len(parts)))
        assert [(r["n_tokens"], r["complete"]) for r in got if r["file"] == "h"] == [(2, False)]


def test_raw_files(spark, tmp_path):
    np.array([5, 6, 0, 7, 0, 8, 8, 8, 0], "<u2").tofile(tmp_path / "a.bin")
    blocks = token_files.read_flat_files(spark, str(tmp_path), block_tokens=2)
    got = token_files.count_tokens(blocks, separator=0).orderBy("ordinal").collect()
    assert [r["n_tokens"] for r in got] == [2, 1, 3]


def test_raw_files_beyond_the_limit_of_one_row(spark, tmp_path, monkeypatch):
    """A file that Spark refuses to read as one row is read by several tasks."""
    monkeypatch.setattr(token_files, "TASK_BYTES", 2000)
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 9, 5000)
    ids.astype("<u4").tofile(tmp_path / "a b%20c.bin")
    (tmp_path / "empty.bin").touch()
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")
    try:
        blocks = token_files.read_flat_files(spark, str(tmp_path), block_tokens=64, dtype="<u4")
        assert blocks.select(F.spark_partition_id()).distinct().count() > 4
        got = token_files.count_tokens(blocks, separator=0, dtype="<u4").orderBy("ordinal").collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    ends = np.flatnonzero(ids == 0)
    want = (np.diff(ends, prepend=-1) - 1).tolist()
    assert [r["n_tokens"] for r in got if r["complete"]] == want
    assert sum(r["n_tokens"] for r in got if not r["complete"]) == len(ids) - ends[-1] - 1


def test_documents_are_written_as_flat_files(spark, rows, tmp_path):
    blocks, places = token_files.write_token_files(documents(spark, rows[:40]).repartition(2), letters, separator=1)
    stored = {r["file"]: bytes(r["tokens"]) for r in blocks.collect()}
    assert len(stored) == 2 and places.count() == 40
    for file, tokens in stored.items():
        (tmp_path / str(file)).write_bytes(tokens)
    raw = token_files.count_tokens(token_files.read_flat_files(spark, str(tmp_path)), separator=1)
    assert sorted(r["n_tokens"] for r in raw.collect()) == sorted(len(t or "") for _, t in rows[:40])


def test_checksum_column_is_that_of_the_ids(spark):
    docs = documents(spark, [(1, " ".join(words(random.Random(0), 50)))])
    row = packing.pack_documents(docs, letters).withColumn("crc", F.crc32("ids")).first()
    assert row["crc"] == zlib.crc32(bytes(row["ids"]))
