import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.llm import centroids, epsilon_grid

VECTORS = "vec_id long, embedding array<double>, label int"


def table(spark, rows, schema=VECTORS):
    return spark.createDataFrame(rows, schema).select("*", *[F.lit("z").alias(n) for n in (
        "id", "x", "digest", "class_id", "size", "dims", "cluster", "distance", "run", "task")])


def awkward():
    return [(900, None, 1), (901, [], 1), (902, [0.0, 0.0, 0.0], 1), (903, [1.0, None, 0.0], 1),
            (904, [1.0, math.nan, 0.0], 1), (905, [math.inf, 0.0, 0.0], 1), (906, [1.0, 0.0, 0.0], None),
            (907, [1.0, 0.0], 1), (908, [1.0, 1e-9], 1), (909, [1e300, 0.0, 0.0], 1), (910, [1e-300, 0.0, 0.0], 1),
            (911, [-1.0, 0.0, 0.0], 1), (912, [1.0, 0.0, 0.0], 2), (None, [0.0, 1.0, 0.0], 3), (None, [0.0, 2.0, 0.0], 3),
            (913, [0.0, 0.0, 1.0], 4), (913, [0.0, 0.0, 1.0], 4)]


def families(rng, dims=24):
    rows, numbers = [], iter(range(100_000))
    for label in (0, 1):
        for size in (1, 1, 2, 5, 120, 40):
            centre = rng.normal(size=dims)
            rows += [(next(numbers), (centre + spread * rng.normal(size=dims)).tolist(), label)
                     for spread in [0.02] * (size // 2) + [0.12] * (size - size // 2)]
        rows += [(next(numbers), rng.normal(size=dims).tolist(), label) for _ in range(60)]
    chain = np.linspace(0, 3, 40)     # neighbours are near, the ends are opposite
    rows += [(next(numbers), [math.cos(t), math.sin(t)] + [0.0] * (dims - 2), 7) for t in chain]
    rows += [(next(numbers), row[1], row[2]) for row in rows[::9]] + rows[3:5]
    return rows


def brute_links(rows, least):
    def usable(x):
        return x and all(v is not None and math.isfinite(v) for v in x) and any(x)

    root, links = list(range(len(rows))), [0] * len(rows)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    unit = [np.array(x) / np.abs(x).max() if usable(x) and label is not None else None for _, x, label in rows]
    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is None or unit[b] is None or rows[a][2] != rows[b][2] or len(unit[a]) != len(unit[b]):
                continue
            if unit[a] @ unit[b] / math.sqrt((unit[a] @ unit[a]) * (unit[b] @ unit[b])) >= least:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    lowest = {}
    for k, row in enumerate(rows):
        if row[0] is not None:
            lowest[find(k)] = min(lowest.get(find(k), row[0]), row[0])
    return sorted(((row[0], links[k], lowest.get(find(k)), row[0] is not None and row[0] == lowest.get(find(k)))
                   for k, row in enumerate(rows)), key=str)


@pytest.mark.parametrize(("run_rows", "leaf_rows"), [(2048, 256), (16, 4)])
def test_near_vectors_against_all_pairs(spark, monkeypatch, run_rows, leaf_rows):
    monkeypatch.setattr(epsilon_grid, "RUN_ROWS", run_rows)
    rows = families(np.random.default_rng(5)) + awkward()
    random.Random(1).shuffle(rows)

    def small_leaves(one, two, limit, epsilon, join=epsilon_grid._forest):
        epsilon_grid.LEAF_ROWS = leaf_rows
        return join(one, two, limit, epsilon)

    monkeypatch.setattr(epsilon_grid, "_forest", small_leaves)
    got = epsilon_grid.near_vectors(table(spark, rows), 0.98).collect()
    assert sorted(map(tuple, got), key=str) == brute_links(rows, 0.98)


def test_distant_runs_are_skipped_and_near_ones_kept(spark, monkeypatch):
    monkeypatch.setattr(epsilon_grid, "RUN_ROWS", 8)
    rows = [(k, [math.cos(k / 100), math.sin(k / 100)], 0) for k in range(600)]
    asked = []
    links = epsilon_grid._links
    monkeypatch.setattr(epsilon_grid, "_links", lambda runs, pairs, *rest: (
        asked.append((runs.count(), pairs.count())), links(runs, pairs, *rest))[1])
    got = epsilon_grid.near_vectors(spark.createDataFrame(rows, VECTORS), 0.98).collect()
    (runs, pairs), = asked
    assert pairs < runs * runs / 4
    assert {(r["vec_id"], r["component_id"]) for r in got} == {(k, 0) for k in range(600)}


def test_near_vectors_at_the_limit_and_empty(spark):
    # 3-4-5 triangles: the cosine is 24/25 exactly
    rows = [(1, [3.0, 4.0], 0), (2, [4.0, 3.0], 0)]
    assert [r["n_links"] for r in epsilon_grid.near_vectors(table(spark, rows), 0.96).collect()] == [1, 1]
    assert epsilon_grid.near_vectors(table(spark, []), 0.98).collect() == []


def brute_clusters(rows, k, rounds, dims, scale):
    kept = [(i, [math.floor(scale * v) for v in x]) for i, x, _ in rows
            if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) and abs(scale * v) < 2 ** 27 for v in x)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)
    centres = [x for _, x in named[:k]]

    def nearest(x):
        return min((sum((p - q) ** 2 for p, q in zip(x, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        found = [(nearest(x)[1], x) for _, x in kept]
        for n in range(len(centres)):
            own = [x for m, x in found if m == n]
            if own:
                centres[n] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    last = [(i, *nearest(x)) for i, x in kept] if centres else []
    whole = sum(d for _, d, _ in last)
    return sorted(((i, n, d, sum(e for _, e, m in last if m == n), whole,
                    hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest()) for i, d, n in last), key=str)


@pytest.mark.parametrize(("k", "rounds", "block"), [(16, 3, 4096), (5, 1, 7), (400, 2, 64)])
def test_clusters_against_plain_python(spark, monkeypatch, k, rounds, block):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=6).tolist(), 0) for i in range(150)]
    rows += [(1000 + i, [0.0] * 6, 0) for i in range(60)] + [(7, [0.5] * 6, 0), (7, [-0.5] * 6, 0)] + rows[:9]
    rows += [(None, [0.25] * 6, 1), (2000, [1.0] * 5 + [math.nan], 0), (2001, [1.0] * 5 + [None], 0), (2002, None, 0),
             (2003, [1.0] * 7, 0), (2004, [1e30] * 6, 0), (2005, [-0.01] * 6, 0), (2006, [2e6] * 6, 0)]
    got = centroids.cluster_vectors(table(spark, rows), k=k, rounds=rounds, dims=6).collect()
    assert sorted(map(tuple, got), key=str) == brute_clusters(rows, k, rounds, 6, 64)


def test_clusters_of_nothing(spark):
    assert centroids.cluster_vectors(table(spark, []), dims=6).collect() == []
    assert centroids.cluster_vectors(table(spark, [(None, [1.0] * 6, 0), (3, None, 0)]), dims=6).collect() == []
