import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wayfare.llm import spelling

from .helpers import LOWER, awkward, documents, with_clashes

LETTERS = "abcàéÿ"


def brute_counts(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-counts[v], v.encode()))
            if counts[best] >= 2 * counts[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, n, len(near[w]), form.get(w), counts.get(form.get(w)), root(w)) for w, n in counts.items()}


def family(rng, size, length):
    """Words around one base, most of them one edit from others."""
    words, base = set(), [rng.choice(LETTERS) for _ in range(length)]
    while len(words) < size:
        word = list(base)
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(word) + 1)
            word[k:k + 1] = rng.choice([[], [rng.choice(LETTERS)], [*word[k:k + 1], rng.choice(LETTERS)]])
        if word:
            words.add("".join(word))
    return words


@pytest.mark.parametrize(("bucket", "tile", "codes"), [(512, 256, 1 << 20), (3, 4, 40), (1, 2, 1)])
def test_variants_against_all_pairs(spark, monkeypatch, bucket, tile, codes):
    monkeypatch.setattr(spelling, "BUCKET_WORDS", bucket)
    monkeypatch.setattr(spelling, "BUCKET_CODES", codes)
    rng = random.Random(bucket)
    words = set().union(*[family(rng, 40, length) for length in (1, 4, 5, 6, 9, 17)])
    words |= {"a" * k for k in (1, 2, 3, 40, 41, 42)} | {"b" + "a" * 40, "a" * 3000, "a" * 2999 + "b", "a" * 3001, "😀é", "😀"}
    counts = {w: rng.choice([3, 4, 6, 9, 12, 30, 100, 1000, 10 ** 6]) for w in sorted(words)}

    def small_tiles(batches, plain=spelling._near_by_word):
        spelling.TILE_ROWS, spelling.TILE_CODES = tile, max(codes, 64)
        return plain(batches)

    monkeypatch.setattr(spelling, "_near_by_word", small_tiles)
    rows = [(w, n, "z") for w, n in counts.items()] + [(None, 5, "z"), ("", 5, "z"), ("nnnnn", None, "z"), ("aaa", 1, "z")]
    table = spark.createDataFrame(rows, "word string, n long, key string").repartition(3)
    got = spelling.spelling_variants(table).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert {tuple(r) for r in got} == brute_variants(counts) and len(got) == len(counts)


def test_counts_and_variants_of_texts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SEGMENT_BYTES", 700)
    rng = random.Random(9)
    vocabulary = sorted(set().union(*[family(rng, 60, length) for length in (5, 7, 12)])) + ["x" * 50, "É×÷ñÿab", "A" * 33]
    rows = awkward(rng) + [(100 + k, rng.choice([" ", "-", "\n", "9"]).join(
        rng.choice([str.upper, str.title, str])(rng.choice(vocabulary)) for _ in range(rng.randrange(1, 90)))) for k in range(120)]
    rows += [(1, "zzzzz" * 2000), (2, "zzzzz" * 2000 + " tail tail"), (3, "zzzzz" * 2000), (None, "Ā ab Čde nullid nullid nullid")]
    got = {r["word"]: r["n"] for r in spelling.word_counts(with_clashes(documents(spark, rows))).collect()}
    assert got == brute_counts(rows)
    assert spelling.word_counts(documents(spark, [])).collect() == []
    assert spelling.spelling_variants(spelling.word_counts(documents(spark, []))).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=1, max_size=7), min_size=2, max_size=30, unique=True))
def test_buckets_count_each_pair_once(words):
    """The rule of cuts, in plain Python: of all buckets that two words share, one counts them."""
    def buckets(word, longer, front, back, below):
        yield (longer, front, back, below, word[:front], word[len(word) - back:])
        free = longer - front - back
        if free > 1:
            step = free // 2
            yield from buckets(word, longer, front + step, back, below)
            yield from buckets(word, longer, front, back + step, min(below, front + step))

    def prefix(a, b):
        return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    for a in words:
        for b in words:
            if a < b and one_edit(a, b):
                longer = max(len(a), len(b))
                shared = set(buckets(a, longer, 0, 0, longer + 1)) & set(buckets(b, longer, 0, 0, longer + 1))
                last = [s for s in shared if s[0] - s[1] - s[2] == 1 and prefix(a, b) < s[3]]
                assert len(last) == 1
