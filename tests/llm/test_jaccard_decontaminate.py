import random
import re
import tracemalloc
import types

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from wayfare.llm import components, decontaminate, fm_index, jaccard_join, wordscan
from wayfare.llm.components import connected_components

from .helpers import DOCS, awkward, documents, with_clashes, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near_copies(rng):
    """A base text and copies of it with more and more words changed, beside unrelated texts."""
    rows, base = [], words(rng, 120)
    for k in range(60):
        copy = list(base)
        for _ in range(rng.randrange(0, 9)):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10 ** 6)}"
        rows.append((1000 + k, " ".join(copy)))
    rows += [(2000 + k, " ".join(words(rng, rng.randrange(3, 60)))) for k in range(60)]
    rows += [(3000 + k, "the MIT license text is here " + " ".join(words(rng, k % 6))) for k in range(30)]
    return rows + [(r[0] + 5000, r[1].upper()) for r in rows[::7]]


def brute_components(rows, n, percent):
    sets = []
    for _, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(own[k:k + n]) for k in range(max(1, len(own) - n + 1))} if own else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    lowest = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            lowest[find(k)] = min(lowest.get(find(k), doc_id), doc_id)
    return sorted(((d, len(sets[k]), lowest.get(find(k)) if sets[k] else d) for k, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (1, 60)])
def test_components_against_all_pairs(spark, n, percent):
    rng = random.Random(n)
    rows = awkward(rng) + near_copies(rng)
    got = jaccard_join.jaccard_components(with_clashes(documents(spark, rows)), n=n, percent=percent).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows, n, percent)


def near_misses(rng, texts, length=100, replaced=1):
    """Copies of one text, each with another word replaced: most pairs are just under 0.85."""
    base, rows = words(rng, length), []
    for k in range(texts):
        copy = list(base)
        for _ in range(replaced):
            copy[rng.randrange(length)] = f"new{rng.randrange(10 ** 9)}"
        rows.append((k, " ".join(copy)))
    return rows


@pytest.mark.parametrize(("classes", "sample", "grams", "n", "percent"), [
    (2, 33, 1 << 21, 4, 85), (2, 3, 200, 5, 80), (5, 1, 1, 4, 85), (32, 33, 1 << 21, 5, 80)])
def test_families_of_near_misses_against_all_pairs(spark, monkeypatch, classes, sample, grams, n, percent):
    for name, value in (("FAMILY_CLASSES", classes), ("FAMILY_SAMPLE", sample), ("FAMILY_GRAMS", grams), ("FAMILY_COST", 0)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(classes + sample)
    rows = near_misses(rng, 90) + [(1000 + k, t) for k, t in near_misses(rng, 60, 60, 2)]
    rows += [(2000 + k, t + " " + " ".join(words(rng, k % 9))) for k, t in near_misses(rng, 50, 40, 1)] + near_copies(rng)[:60]
    rows += awkward(rng)
    rng.shuffle(rows)
    got = jaccard_join.jaccard_components(documents(spark, rows), n=n, percent=percent).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows, n, percent)


def test_near_misses_do_not_cost_all_their_pairs(spark, monkeypatch):
    """Of 1500 texts just under the threshold of one another, few pairs are looked at, and one component comes out."""
    rows = near_misses(random.Random(2), 1500)
    looked_at = []
    checked = jaccard_join._checked
    monkeypatch.setattr(jaccard_join, "_checked", lambda pairs, *rest: (looked_at.append(pairs.count()), checked(pairs, *rest))[1])
    got = jaccard_join.jaccard_components(documents(spark, rows), n=4, percent=85).collect()
    assert {r["component_id"] for r in got} == {0}
    assert sum(looked_at) < 20 * len(rows)


@pytest.mark.parametrize(("size", "share", "percent"), [(1000, 100_000, 85), (7, 0, 85), (7, 10 ** 9, 60)])
def test_links_against_all_pairs(spark, monkeypatch, size, share, percent):
    """Every pair of a group of near copies is there, not only what joins its members to the group."""
    monkeypatch.setattr(jaccard_join, "LIST_CLASSES", size)
    monkeypatch.setattr(jaccard_join, "HOT_SHARE", share)
    rng = random.Random(7)
    base = words(rng, 200)
    group = [(0, " ".join([*base[:k], f"changed{k}", *base[k + 1:]])) for k in range(50, 90)]
    rows = [(20_000 + k, t) for k, (_, t) in enumerate(awkward(rng) + near_copies(rng) + group)]
    links, members = jaccard_join.jaccard_links(with_clashes(documents(spark, rows)).repartition(3), n=4, percent=percent)
    of_class, of_doc = {}, dict(map(tuple, members.collect()))
    for doc_id, class_id in of_doc.items():
        of_class.setdefault(class_id, []).append(doc_id)
    between = [tuple(r) for r in links.collect()]
    assert all(a < b for a, b in between) and len(set(between)) == len(between)
    got = {(min(x, y), max(x, y)) for a, b in between for x in of_class[a] for y in of_class[b]}
    got |= {(x, y) for c, own in of_class.items() if c is not None for x in own for y in own if x < y}
    assert len(of_doc) == len(rows)
    sets = {}
    for doc_id, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[doc_id] = {tuple(own[k:k + 4]) for k in range(max(1, len(own) - 3))} if own else set()
    want = {(x, y) for x in sets for y in sets if x < y and (both := len(sets[x] & sets[y]))
            and 100 * both >= percent * len(sets[x] | sets[y])}
    assert got == want and len(between) >= len(group) * (len(group) - 1) // 2


@pytest.mark.parametrize("share", [0, 10 ** 9])
def test_components_do_not_depend_on_what_is_hot(spark, monkeypatch, share):
    """No n-gram is hot at share 0, every one at a high share; copies are met by several tasks."""
    monkeypatch.setattr(jaccard_join, "HOT_SHARE", share)
    rng = random.Random(9)
    rows = near_copies(rng) + [(None, "the same words for many rows " * 3)] * 20
    rows += [(7000 + k, "the same words for many rows " * 3) for k in range(20)]
    got = jaccard_join.jaccard_components(documents(spark, rows).repartition(3), n=4, percent=85).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows, 4, 85)


def test_one_of_each_group_stays(spark):
    rng = random.Random(3)
    rows = awkward(rng)[:6] + near_copies(rng)
    kept = jaccard_join.keep_one_per_group(documents(spark, rows))
    want = {d for d, _, c in brute_components(rows, 5, 80) if d == c}
    assert {r["doc_id"] for r in kept.collect()} == want
    assert kept.columns == documents(spark, rows[:1]).columns


def test_filters_lose_no_linked_pair():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2 ** 63, 200).astype(np.uint64))
    b = np.unique(np.concatenate([a[10:], rng.integers(0, 2 ** 63, 10).astype(np.uint64)]))
    common = len(np.intersect1d(a, b))
    left, right = (np.frombuffer(jaccard_join._parts(x), np.uint8) for x in (a, b))
    assert np.minimum(left, right).sum() >= common
    assert jaccard_join.linked(a, b, 100 * common // len(np.union1d(a, b)))
    assert not jaccard_join.linked(a, b, 100 * common // len(np.union1d(a, b)) + 1)


@pytest.mark.parametrize("values", [[0, 0, 3, 0], [1] * 50, list(range(70_000, 70_050)), [2 ** 40, 0, 0, 0, 0, 0]])
def test_packed_counts_read_back(values):
    counts = np.array(values, np.int64)
    total = np.zeros(len(values), np.int64)
    jaccard_join._add_packed(total, jaccard_join._packed(counts))
    assert total.tolist() == values


def test_connected_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).distinct().collect())
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_that_are_stars_cost_no_step(spark, monkeypatch):
    steps, star = [], components._star
    monkeypatch.setattr(components, "_star", lambda edges, larger: (steps.append(larger), star(edges, larger))[1])
    edges = [(1, 5), (6, 1), (7, 2), (None, 1), (3, None), (4, 4)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {1: 1, 5: 1, 6: 1, 2: 2, 7: 2} and not steps
    got = dict(connected_components(spark.createDataFrame([*edges, (5, 6)], "a long, b long")).collect())
    assert got == {1: 1, 5: 1, 6: 1, 2: 2, 7: 2} and steps == [True, False]


def test_few_rows_are_dealt_out_few_times(spark):
    """Every shuffle runs as many tasks as there are partitions, however small the lists of a few groups are."""
    rng, partitions = random.Random(12), 30
    rows = near_misses(rng, 150)
    rows += [(1000 + k, " ".join(words(rng, 60, 10_000))) for k in range(100)]
    rows += [(2000 + k, f"{text} more") for k, text in rows[-100:]]
    docs = documents(spark, rows).repartition(3)
    held = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    tracker = spark.sparkContext.statusTracker()
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("dealt out", "")
        got = jaccard_join.jaccard_components(docs, n=4, percent=85).collect()
        jobs = [tracker.getJobInfo(k) for k in tracker.getJobIdsForGroup("dealt out")]
        stages = [tracker.getStageInfo(k) for k in {k for job in jobs for k in job.stageIds}]
        tasks = sum(stage.numCompletedTasks for stage in stages if stage)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got), key=str) == brute_components(rows, 4, 85)
    assert tasks < 36 * partitions


def test_fm_index_finds_every_place():
    rng = np.random.default_rng(1)
    for _ in range(25):
        text = rng.integers(0, 4, rng.integers(2, 200))
        text[-1] = 0
        index = fm_index.FMIndex(text)
        patterns, lengths = rng.integers(1, 5, (20, 3)), rng.integers(1, 4, 20)
        for p, size, low, high in zip(patterns, lengths, *index.ranges(patterns, lengths), strict=True):
            want = [k for k in range(len(text) - size + 1) if (text[k:k + size] == p[:size]).all()]
            assert sorted(index.locate(np.arange(low, high)).tolist()) == want


def brute_hits(rows, items, window=13):
    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    phrases = {}
    for item, text in items:
        own = split(text)
        for k in range(max(1, len(own) - window + 1) if own else 0):
            phrases.setdefault(tuple(own[k:k + window]), set()).add(str(item))
    out = []
    for doc_id, text in rows:
        own, hit, found = split(text), set(), set()
        for size in {len(p) for p in phrases}:
            for k in range(len(own) - size + 1):
                if tuple(own[k:k + size]) in phrases:
                    hit |= set(range(k, k + size))
                    found |= phrases[tuple(own[k:k + size])]
        out.append((doc_id, len(own), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def contaminated():
    rng = random.Random(11)
    items = [(k, " ".join(words(rng, rng.randrange(1, 30), 60))) for k in range(12)] + [
        (50, None), (51, "..."), (52, "a b"), (53, "A, b!")]
    rows = awkward(rng)[:5] + awkward(rng)[7:]
    for k in range(60):
        own = words(rng, 40, 60)
        if k % 2:
            own[5:5] = items[k % 12][1].upper().split()
        rows.append((100 + k, ", ".join(own)))
    return rows, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_hits_against_plain_search(spark, contaminated, block_bytes):
    rows, items = contaminated
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    hits = decontaminate.benchmark_hits(with_clashes(documents(spark, rows)), benchmark, block_bytes=block_bytes)
    got = [(r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), tuple(r["items"]))
           for r in hits.collect()]
    assert sorted(got, key=str) == brute_hits(rows, items)


def test_contaminated_documents_go_and_clean_ones_stay(spark, contaminated):
    rows, items = contaminated
    kept = decontaminate.drop_contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    want = sorted((d for d, n, hit, _ in brute_hits(rows, items) if not hit or 20 * hit < n), key=str)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == want


def test_empty_tables(spark):
    empty, docs = spark.createDataFrame([], DOCS), documents(spark, [(1, "a b c")])
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert jaccard_join.jaccard_components(empty).count() == 0
    assert decontaminate.benchmark_hits(empty, no_items).count() == 0
    assert decontaminate.contamination(decontaminate.benchmark_hits(docs, no_items)).first()["contaminated"] is False


def test_merged_spans(spark):
    from pyspark.sql import functions as F
    rows = [([(5, 7), (1, 3), (3, 4), (6, 9)],), ([],), ([(1, 9), (2, 3), (11, 12)],), ([(k, k + 1) for k in range(500, 0, -2)],)]
    df = spark.createDataFrame(rows, "spans array<struct<start:long,end:long>>")
    got = [[tuple(s) for s in r[0]] for r in df.select(decontaminate.merged_spans(F.col("spans"))).collect()]
    assert got == [[(1, 4), (5, 9)], [], [(1, 9), (11, 12)], [(k, k + 1) for k in range(2, 501, 2)]]


def test_several_blocks_with_repeated_rows_and_shared_ids(spark):
    rng = random.Random(12)
    items = [(f"i{k % 9}", " ".join(words(rng, 20, 50))) for k in range(30)]
    rows = [(rng.choice([1, 2, None]), " ".join(words(rng, 8, 50) + items[rng.randrange(30)][1].split()[:rng.randrange(21)]
                                               + items[rng.randrange(30)][1].split())) for _ in range(20)]
    rows += rows[:6] + [(1, None), (1, None), (None, "")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    hits = decontaminate.benchmark_hits(documents(spark, rows), benchmark, block_bytes=200)
    got = [(r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), tuple(r["items"])) for r in hits.collect()]
    assert sorted(got, key=str) == brute_hits(rows, items)
    assert all(a["end"] < b["start"] for r in hits.collect() for a, b in zip(r["spans"], r["spans"][1:]))


def test_phrases_of_many_windows_are_small():
    import pickle
    items = [(str(k), " ".join(words(random.Random(k), 100, 20_000))) for k in range(500)]
    phrases = decontaminate.Phrases(items, 13)
    assert len(phrases.rows) == 500 * 88 and len(pickle.dumps(phrases)) < 90 * len(phrases.rows)


class Unplanned:
    """Stands for documents: mapInArrow gives the function that a task would run."""

    schema = {"doc_id": types.SimpleNamespace(dataType=T.LongType())}
    sparkSession = types.SimpleNamespace(sparkContext=types.SimpleNamespace(
        broadcast=lambda value: types.SimpleNamespace(value=value)))

    def select(self, *columns):
        return self

    def mapInArrow(self, task, schema):
        return task


@pytest.mark.parametrize("vocabulary", [50, 100_000])
def test_a_task_needs_memory_for_pieces_of_its_texts(monkeypatch, vocabulary):
    """19 or 34 MB of texts, all of benchmark words or few: the work beside them stays small, and cuts change no result."""
    rng = random.Random(13)
    items = [(str(k), " ".join(words(rng, 20, 50))) for k in range(40)]
    texts = [" ".join([*words(rng, 400, vocabulary), *(items[k % 40][1].split()[3:] if k % 3 else [])]) for k in range(300)]
    batch = pa.record_batch({"doc_id": np.arange(12_000), "text": texts * 40})
    task = decontaminate._scan(Unplanned(), decontaminate.Phrases(items, 13))
    tracemalloc.start()
    found = [(part.num_rows, part.slice(0, 300)) for part in task([batch])]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(n for n, _ in found) == 12_000 and peak < 100e6
    monkeypatch.setattr(decontaminate, "PIECE_BYTES", 3000, raising=False)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 5000, raising=False)
    small = pa.Table.from_batches(task([batch.slice(0, 300)])).to_pylist()
    assert small == found[0][1].to_pylist() and sum(len(r["items"]) > 0 for r in small) >= 200


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_text_slices_of_cut_columns_with_nulls(kind):
    texts = ["äb", None, "", "cdef", None, "g" * 9, "h"] * 5
    column = pa.array(["before", *texts, "after"], kind).slice(1, len(texts))
    for size in (1, 4, 10, 1000):
        got, last = [], 0
        for row, end, data, offsets in wordscan.text_slices(column, size):
            assert row == last and end > row and (len(data) <= size or end == row + 1)
            got += [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])]
            last = end
        assert got == [t or "" for t in texts]
    assert list(wordscan.text_slices(column.slice(0, 0))) == []
