"""Centroid clustering of integer vectors through scalar lookup tables.

Vectors are cut into blocks of a few thousand rows; a block keeps, for each
dimension, the sorted list of the integer values that occur in it and one code
per vector.  In every round each task tabulates, for each dimension, occurring
value and centroid, the squared difference; the distance of a vector to a
centroid is then a sum of table entries that its codes gather.  All arithmetic
is on integers, so results do not depend on order or partitioning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage

BLOCK_ROWS = 4096        # vectors of a block: what a task holds at once, with its tables
VALUE_LIMIT = 1 << 27    # components below it in size: 64 squared differences fit 64 bits


def integer_components(vector: Column, dims: int, scale: int) -> Column:
    """floor(scale * x) of each component as longs; null unless the vector is whole (see ``cluster_vectors``)."""
    scaled = F.transform(vector, lambda x: x.cast("double") * F.lit(float(scale)))
    whole = (F.size(vector) == dims) & F.forall(
        scaled, lambda x: F.coalesce((x < float(VALUE_LIMIT)) & (x >= float(-VALUE_LIMIT)), F.lit(False)))
    return F.when(whole, F.transform(scaled, lambda x: F.floor(x).cast("long")))


def _blocks(kept: DataFrame, dims: int) -> DataFrame:
    """Rows of up to ``BLOCK_ROWS`` vectors: ids, occurring values by dimension, codes by dimension."""
    ids = f"array<{kept.schema[0].dataType.simpleString()}>"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                ints = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims)
                values, codes = zip(*(np.unique(ints[:, d], return_inverse=True) for d in range(dims)), strict=True)
                own = part.column(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
                     pa.array([np.concatenate(values).astype("<i4").tobytes()], pa.binary()),
                     pa.array([np.array([len(v) for v in values], "<i4").tobytes()], pa.binary()),
                     pa.array([np.concatenate(codes).astype("<u2").tobytes()], pa.binary())],
                    names=["ids", "occurring", "widths", "codes"])

    return kept.mapInArrow(pack, f"ids {ids}, occurring binary, widths binary, codes binary")


def _nearest(row_count: int, occurring: bytes, widths: bytes, codes: bytes, centroids: np.ndarray):
    """Cluster and squared distance of each vector of a block, and its component values by dimension."""
    values = np.frombuffer(occurring, "<i4").astype(np.int64)
    start = np.concatenate([[0], np.cumsum(np.frombuffer(widths, "<i4"))])
    by_dim = np.frombuffer(codes, "<u2").reshape(-1, row_count)
    distance = np.zeros((row_count, len(centroids)), np.int64)
    for d, code in enumerate(by_dim):
        table = (values[start[d]:start[d + 1], None] - centroids[None, :, d]) ** 2
        distance += table[code]
    cluster = distance.argmin(axis=1)      # the first of equals: the smaller number
    picked = [values[start[d]:start[d + 1]][code] for d, code in enumerate(by_dim)]
    return cluster, distance[np.arange(row_count), cluster], picked


def _round(blocks: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The next centroids; at most clusters x dimensions sums of each task are shuffled."""
    k, dims = len(centroids), len(centroids[0])

    def sums(batches):
        table, total, counts = np.array(centroids, np.int64), np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for ids, *packed in zip(*batch.columns, strict=True):
                cluster, _, picked = _nearest(len(ids), *[p.as_py() for p in packed], table)
                counts += np.bincount(cluster, minlength=k)
                for d, values in enumerate(picked):   # exact: a block's sums are below 2**53
                    total[:, d] += np.bincount(cluster, weights=values, minlength=k).astype(np.int64)
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used, dims), pa.int32()), pa.array(np.tile(np.arange(dims), len(used)), pa.int32()),
                 pa.array(total[used].ravel(), pa.int64()), pa.array(np.repeat(counts[used], dims), pa.int64())],
                names=["cluster", "dim", "total", "n"])

    found = (blocks.mapInArrow(sums, "cluster int, dim int, total long, n long").groupBy("cluster", "dim")
             .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect())
    moved = [list(c) for c in centroids]
    for row in found:
        moved[row["cluster"]][row["dim"]] = int(row["total"]) // row["n"]
    return moved


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Assign every vector to the nearest of ``k`` centroids after ``rounds`` rounds.

    A component x counts as the integer floor(scale * x), x as double.  Centroids
    start as the ``k`` vectors with the smallest sha256 of ``1:<id>`` (equal ids:
    smallest components first), in that order.  A round assigns each vector to
    the nearest centroid (squared Euclidean distance, ties to the smaller number)
    and moves each centroid that has vectors to floor(sum / count) of each
    component.  Vectors are assigned once more at the end.

    Left out: vectors that are null, have another number of components than
    ``dims``, or a component that is null, not finite or, scaled, not below 2**27
    in size (its squares would leave 64 bits).  Rows with a null id are assigned
    but are no first centroid.  Repeated rows count as often as they occur; fewer
    than ``k`` usable ids give fewer centroids, none give an empty result.  Other
    columns are not looked at.

    Returns id_col, cluster, distance, cluster_inertia, inertia (both as long, null
    where the sum is beyond it) and centroid_sha256.  The driver holds k x dims
    integers and no more; tasks hold a block each.
    """
    kept = (vectors.select(F.col(id_col).alias("vec_id"), integer_components(F.col(vector_col), dims, scale).alias("x"))
            .filter("x is not null"))
    first = (kept.filter("vec_id is not null").orderBy(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256),
                                                       "x").limit(k).collect())
    centroids = [list(row["x"]) for row in first]
    blocks = stage(_blocks(kept, dims), "vector-blocks")
    for _ in range(rounds if centroids else 0):
        centroids = _round(blocks, centroids)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def assign(batches):
        table = np.array(centroids, np.int64)
        for batch in batches:
            for ids, *packed in zip(*batch.columns, strict=True):
                cluster, distance, _ = _nearest(len(ids), *[p.as_py() for p in packed], table)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    kind = kept.schema[0].dataType.simpleString()
    if not centroids:
        blocks = blocks.limit(0)
    found = stage(blocks.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "vector-clusters")
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()
    as_long = [(row["cluster"], int(row["own"])) for row in inertia]     # k rows at most
    whole, limit = sum(own for _, own in as_long), (1 << 63) - 1
    facts = vectors.sparkSession.createDataFrame(
        [(c, own if own <= limit else None, whole if whole <= limit else None, digests[c]) for c, own in as_long],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (found.join(F.broadcast(facts), "cluster")
            .select(F.col("vec_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia",
                    "centroid_sha256"))
