"""The stages of corpus_pipeline against plain Python, on rows with awkward ids, texts and column names."""

import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline

from .helpers import DOCS, LOWER

CLASHES = ["score", "lang_pred", "entropy", "accepted", "row", "text_sha256", "digest", "rank", "gone_text", "gone_id", "key", "n"]


def corpus():
    """(doc_id, text): ordinary texts of two languages, noise, copies, near copies, contaminated ones."""
    rng = random.Random(21)
    syllables = {"aa": ["la", "mi", "so", "ne", "tu", "ri"], "bb": ["gra", "stro", "kven", "plok", "zhu", "brin"]}

    def prose(lang, count):
        return " ".join("".join(rng.choices(syllables[lang], k=rng.randrange(1, 4))) for _ in range(count))

    rows = [(k, prose(lang, rng.randrange(40, 120)), lang) for k, lang in enumerate(["aa", "bb"] * 150)]
    item = prose("aa", 30)
    rows += [(1000 + k, "".join(rng.choice("qxwjvfcyd ") for _ in range(300)), None) for k in range(5)]     # noise, not learned from
    rows += [(2000, None, "aa"), (2001, "", None), (2002, " \n ", "aa"), (2003, "123 !!", "aa")]
    copies = [(3000 + k, rows[k][1] + " " * (k % 3), rows[k][2]) for k in range(0, 60, 3)]
    near = []
    for k in range(60, 120, 2):
        own = rows[k][1].split(" ")
        own[rng.randrange(len(own))] = "".join(syllables[rows[k][2]][:3])
        near.append((4000 + k, " ".join(own), rows[k][2]))
    dirty = [(5000, prose("aa", 20) + " " + item, "aa"), (None, prose("aa", 25) + " " + item.upper(), "aa"),
             (7, prose("aa", 30) + " " + item, "aa")]
    again = [rows[10], rows[11], (None, rows[20][1], "aa"), (None, prose("bb", 60), "bb"), (5, prose("aa", 60), None)]
    return rows + copies + near + dirty + again, [("i1", item), ("i2", None), (None, "")]


def table(spark, rows):
    docs = spark.createDataFrame([(r[0], r[1], r[2], "s", len(r[1] or "")) for r in rows], DOCS)
    return docs.select("*", *[F.lit(7.5).alias(c) for c in CLASHES])


def shingles(text, n=5):
    own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(own[k:k + n]) for k in range(max(1, len(own) - n + 1))} if own else set()


def plain_exact(rows):
    best = {}
    for at, (doc_id, text, *_) in enumerate(rows):
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        rank = (-len(text or ""), doc_id is None, doc_id or 0, at)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, (doc_id, text))
    return sorted((v for _, v in best.values()), key=str)


def plain_near(rows):
    sets, root = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)

    def rank(k):
        digest = xxhash.xxh64((rows[k][1] or "").encode(), seed=42).intdigest()
        return rows[k][0] is None, rows[k][0] or 0, digest - (digest >> 63 << 64)

    first = {}
    for k in range(len(rows)):
        if find(k) not in first or rank(k) < rank(first[find(k)]):
            first[find(k)] = k
    chosen = {(rows[k][0], rows[k][1]) for k in first.values()}
    return sorted(((r[0], r[1]) for k, r in enumerate(rows) if not sets[k] or (r[0], r[1]) in chosen), key=str)


def plain_clean(rows, items):
    def own(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    windows = set()
    for _, text in items:
        w = own(text)
        windows |= {tuple(w[k:k + 13]) for k in range(max(1, len(w) - 12))} if w else set()
    out = []
    for r in rows:
        w, hit = own(r[1]), set()
        for window in windows:
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k:k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
        if not (hit and 20 * len(hit) >= len(w)):
            out.append((r[0], r[1]))
    return sorted(out, key=str)


def kept(df, docs):
    assert df.dtypes == docs.dtypes
    got = df.collect()
    assert all(r[c] == 7.5 for r in got for c in CLASHES)
    return sorted(((r["doc_id"], r["text"]) for r in got), key=str)


@pytest.fixture(scope="module")
def benchmark_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("bench"))
    spark.createDataFrame(corpus()[1], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stage_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontaminate", "packing"]


def test_language_stage_drops_noise_and_keeps_columns(spark, benchmark_dir):
    rows, _ = corpus()
    docs = table(spark, rows)
    got = kept(corpus_pipeline.identify_language(spark, docs, benchmark_dir), docs)
    wanted = sorted(((r[0], r[1]) for r in rows if r[0] is None or not 1000 <= r[0] < 3000), key=str)
    assert not [x for x in got if x[0] is not None and 1000 <= x[0] < 3000]
    assert len(got) >= 0.98 * len(wanted) and set(got) <= set(wanted)


def test_exact_near_and_benchmark_stages(spark, benchmark_dir):
    rows, items = corpus()
    docs = table(spark, rows)
    assert kept(corpus_pipeline.drop_copies(spark, docs, benchmark_dir), docs) == plain_exact(rows)
    assert kept(corpus_pipeline.drop_near_copies(spark, docs, benchmark_dir), docs) == plain_near(rows)
    clean = plain_clean(rows, items)
    assert kept(corpus_pipeline.drop_contaminated(spark, docs, benchmark_dir), docs) == clean
    assert not [x for x in clean if x[0] == 5000 or (x[0] == 7 and x[1] != rows[7][1])]


def test_packing_stage_holds_every_token_once(spark, benchmark_dir):
    public = pytest.importorskip("public_tokenizers")
    import numpy as np
    import tokenizers
    own = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rows = [r for r in corpus()[0] if r[0] is not None][:150] + [(9000, "a <|endoftext|> b", "aa")]
    rows = list({r[0]: r for r in rows}.values())
    pieces = corpus_pipeline.pack(spark, table(spark, rows), benchmark_dir).collect()
    by_doc = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        by_doc.setdefault(p["doc_id"], []).append(p)
    assert set(by_doc) == {r[0] for r in rows}
    for doc_id, text, *_ in rows:
        ids = np.array(own.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in by_doc[doc_id]:
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)


def test_run_is_its_stages_one_after_the_other(spark, tmp_path):
    rows, items = corpus()
    folder = str(tmp_path)
    spark.createDataFrame([(r[0], r[1], r[2], "s", len(r[1] or "")) for r in rows], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    pieces = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.identify_language(spark, docs, folder).collect()]
    left = plain_clean(plain_near(plain_exact(left)), items)
    assert sorted((str(p["doc_id"]) for p in pieces if p["start"] == 0)) == sorted(str(d) for d, _ in left)


def test_empty_documents(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
