import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.llm import language_id, toxicity

from .helpers import DOCS, awkward, documents, with_clashes

SYLLABLES = {"aa": "ka to mi ne su ra".split(), "bb": "sch ung ber ein keit der".split(),
             "cc": "ñar ción que los ado ez".split()}


def speak(rng, lang, count):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(count))


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(2)
    return [(k, speak(rng, lang, rng.randrange(20, 80)), lang) for k, lang in enumerate(list(SYLLABLES) * 120)]


@pytest.fixture(scope="module")
def model(spark, spoken):
    docs = documents(spark, spoken)
    return language_id.train_language_model(docs.filter(~language_id.held_out(F.col("doc_id"))))


def test_held_out_texts_get_their_language(spark, spoken, model):
    found = language_id.predict_language(documents(spark, spoken), model).withColumn(
        "held_out", language_id.held_out(F.col("doc_id"))).filter("held_out").collect()
    assert len(found) > 40
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.98 * len(found)
    assert all(r["accepted"] and 0 <= r["score"] <= 1 for r in found)


def test_awkward_texts(spark, model):
    rows = awkward(random.Random(1)) + [(70, "𝔘𝔫𝔦 ㊙ 漢字"), (71, "12 34 --")]
    docs = with_clashes(documents(spark, rows))
    found = language_id.predict_language(docs, model)
    assert [c for c in docs.columns if c != "lang_pred"] == found.columns[:len(docs.columns) - 1]
    got = found.select("doc_id", "text", "lang_pred", "score", "accepted").collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert letters or not r["accepted"] and r["score"] == 0


def test_far_text_is_rejected(spark, model):
    far = documents(spark, [(1, "жшгц йфъы щэюя " * 20), (2, "kato mine sura toka " * 20)])
    got = {r["doc_id"]: r["accepted"] for r in language_id.predict_language(far, model).collect()}
    assert got == {1: False, 2: True}


def test_no_training_text(spark):
    empty = spark.createDataFrame([], DOCS)
    nothing = language_id.train_language_model(empty)
    got = language_id.predict_language(documents(spark, [(1, "words here")]), nothing).first()
    assert (got["lang_pred"], got["accepted"]) == ("und", False)
    assert language_id.predict_language(empty, nothing).count() == 0


def test_probabilities_sum_to_one(model):
    # After any context the seen symbols and the unseen one share all probability.
    symbols = np.unique(np.concatenate([g for g in [model.grams[0].hashes * np.uint64(pow(int(language_id._HASH), -1, 2 ** 64))]]))
    for context in (0x61006B0061, 0x20006B0061, 0x7A007A007A):
        keys = np.uint64(context << 16) | symbols
        sums = np.exp(model._scores(keys, language_id.ORDER).astype(float)).sum(axis=0)
        assert (sums <= 1 + 1e-3).all() and (sums > 0.8).all()


def plain_kneser_ney(texts, n_symbols):
    """Probability of gram[-1] after gram[:-1], counted from whole texts with dictionaries."""
    counts = [{}]
    for text in texts:
        padded = "\x01" * (language_id.ORDER - 1) + text
        for k in range(len(text)):
            gram = padded[k:k + language_id.ORDER]
            counts[0][gram] = counts[0].get(gram, 0) + 1
    while len(counts) < language_id.ORDER:
        lower = {}
        for gram in counts[0]:
            lower[gram[1:]] = lower.get(gram[1:], 0) + 1
        counts.insert(0, lower)
    discounts, totals, kinds = [], [], []
    for own in counts:
        ones, twos = (sum(n == x for n in own.values()) for x in (1, 2))
        discounts.append(min(0.95, max(0.1, ones / (ones + 2 * twos) if ones else 0.5)))
        totals.append({})
        kinds.append({})
        for gram, n in own.items():
            totals[-1][gram[:-1]] = totals[-1].get(gram[:-1], 0) + n
            kinds[-1][gram[:-1]] = kinds[-1].get(gram[:-1], 0) + 1

    def p(gram):
        if not gram:
            return 1 / (n_symbols + 1)
        order, context = len(gram) - 1, gram[:-1]
        if context not in totals[order]:
            return p(gram[1:])
        total = totals[order][context]
        share = max(counts[order].get(gram, 0) - discounts[order], 0) / total
        return share + min(discounts[order] * kinds[order][context], total) / total * p(gram[1:])

    return p, counts


@pytest.mark.parametrize("piece", [1000, 1 << 20])
def test_a_large_alphabet_is_learned_whole(spark, monkeypatch, piece):
    """Over 200,000 n-grams, most of them met once, beside a small language: no count is lost."""
    monkeypatch.setattr(language_id, "PIECE_ENTRIES", piece)
    rng = random.Random(5)
    large = ["".join(chr(0x4E00 + int(rng.random() ** 2 * 3000)) for _ in range(2000)) for _ in range(105)]
    large += large[:2]
    small = [speak(rng, "aa", 30) for _ in range(20)]
    docs = documents(spark, [(k, t, "zz") for k, t in enumerate(large)] + [(k, t, "aa") for k, t in enumerate(small)])
    model = language_id.train_language_model(docs)
    assert model.languages == ["aa", "zz"]
    n_symbols = len(set("".join(large + small)))
    for k, (lang, texts) in enumerate((("aa", small), ("zz", large))):
        p, counts = plain_kneser_ney(texts, n_symbols)
        assert lang == "aa" or len(counts[3]) > 200_000
        for order in range(1, 5):
            assert sum(x.size for x in model.pieces[lang, order, False]) == len(counts[order - 1])
        seen = rng.sample(sorted(counts[3]), 300)
        grams = seen + ["".join(rng.choice(large[0] + "kato ") for _ in range(4)) for _ in range(300)]
        keys = np.array([sum(ord(c) << 16 * j for j, c in enumerate(reversed(g))) for g in grams], np.uint64)
        got = model._scores(keys, language_id.ORDER)[:, k]
        assert np.allclose(got, [np.log(p(g)) for g in grams], atol=1e-4)


def test_every_language_is_learned(spark):
    rows = [(k, f"{chr(0x4E00 + 3 * k)}{chr(0x4E01 + 3 * k)}{chr(0x4E02 + 3 * k)} " * 10, f"l{k:03}") for k in range(230)]
    model = language_id.train_language_model(documents(spark, rows))
    assert model.languages == [r[2] for r in rows]
    found = language_id.predict_language(documents(spark, rows), model).collect()
    assert all(r["lang_pred"] == r["lang"] for r in found)


def test_rejection_in_rare_languages_and_lengths(spark):
    """Random letters and an unlearned language of the same letters go; texts of a language with 25 texts stay."""
    rng = random.Random(6)
    rows = [(k, speak(rng, "aa", rng.randrange(20, 80)), "aa") for k in range(300)]
    rows += [(400 + k, speak(rng, "aa", 1)[:2], "aa") for k in range(8)]
    rows += [(500 + k, speak(rng, "bb", rng.randrange(20, 80)), "bb") for k in range(25)]
    model = language_id.train_language_model(documents(spark, rows))
    assert all(np.isfinite(model.limits[lang, size]) for lang in ("aa", "bb") for size in range(17))
    noise = [(k, " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(n)))
             for k, n in enumerate((10, 50, 400, 5000))]
    other = ["ak", "ot", "im", "en", "us", "ar", "hcs", "gnu", "reb", "nie"]
    noise += [(50 + k, " ".join("".join(rng.choice(other) for _ in range(3)) for _ in range(n)))
              for k, n in enumerate((50, 400, 5000))]
    clean = [(100 + k, speak(rng, lang, n)) for k, (lang, n) in enumerate(
        (lang, n) for lang in ("aa", "bb") for n in (3, 10, 50, 400, 5000) for _ in range(4))]
    got = {r["doc_id"]: r["accepted"] for r in language_id.predict_language(documents(spark, noise + clean), model).collect()}
    assert got == {k: False for k, _ in noise} | {k: True for k, _ in clean}


def test_hash_array_finds_all_and_only_its_keys():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2 ** 63, 5000).astype(np.uint64))
    table = language_id.HashArray(keys, np.arange(len(keys), dtype=float)[:, None])
    assert (table.rows[table.find(keys)][:, 0] == np.arange(len(keys))).all()
    assert (table.find(np.setdiff1d(rng.integers(0, 2 ** 63, 5000).astype(np.uint64), keys)) == -1).all()
    none = language_id.HashArray(np.empty(0, np.uint64), np.empty((0, 1)))
    assert none.find(keys[:5]).tolist() == [-1] * 5


def insults(rng, k):
    text = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 120))]
    grade = k % 4
    for _ in range(grade):
        text.insert(rng.randrange(len(text)), rng.choice(["scum", "fool", "trash"]))
    return " ".join(text), grade


def test_ordered_grades_are_learned(spark):
    rng = random.Random(4)
    texts = [(k, *insults(rng, k)) for k in range(1200)]
    docs = documents(spark, [t[:2] for t in texts])
    labels = spark.createDataFrame([(k, int(g > 0) + int(g > 2)) for k, _, g in texts] + [(None, 1), (3, None)],
                                   "doc_id long, toxic int")
    model = toxicity.train_severity(docs, labels.filter("doc_id is null or doc_id >= 200"))
    assert (np.diff(model.thresholds) > 0).all()
    got = {r["doc_id"]: r for r in toxicity.score_severity(with_clashes(docs), model).collect()}
    held = [(got[k], g) for k, _, g in texts[:200]]
    assert sum(r["toxic"] == (g > 0) for r, g in held) >= 195
    means = [np.mean([r["severity"] for r, g in held if g == x]) for x in range(4)]
    assert means[0] < 0.2 < means[1] < means[3]


def test_toxicity_of_awkward_rows(spark):
    rows = awkward(random.Random(1)) + [(80, "fine " * 20_000 + "scum fool")]
    docs = documents(spark, rows + [(200 + k, "scum fool" if k % 3 == 0 else "fine words") for k in range(60)])
    labels = spark.createDataFrame([(200 + k, int(k % 3 == 0)) for k in range(60)], "doc_id long, toxic int")
    model = toxicity.train_severity(docs, labels)
    got = toxicity.score_severity(documents(spark, rows), model).collect()
    assert len(got) == len(rows)
    assert [r["doc_id"] for r in got if r["toxic"]] == [80]
    empty = spark.createDataFrame([], DOCS)
    untrained = toxicity.train_severity(empty, labels)
    assert toxicity.score_severity(empty, untrained).count() == 0
    assert not any(r["toxic"] for r in toxicity.score_severity(documents(spark, rows), untrained).collect())


def test_rows_that_share_an_id_come_to_the_driver_once(spark, monkeypatch):
    docs = documents(spark, [(k % 7, f"text {k} fool" if k % 2 else "fine words") for k in range(2000)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(7)], "doc_id long, toxic int")
    seen = []
    fit = toxicity.fit_ordinal
    monkeypatch.setattr(toxicity, "fit_ordinal", lambda texts, *rest: (seen.append(len(texts)), fit(texts, *rest))[1])
    toxicity.train_severity(docs, labels, rows=5)
    assert seen == [5]
