"""Embedding near-duplicates by an epsilon grid order join.

Cosine at least c between unit vectors is a distance of at most
sqrt(2 - 2c) = epsilon.  Vectors are turned onto the leading principal
dimensions, cut into grid cells of width epsilon and sorted by their cells,
first dimension first; two vectors within epsilon of each other differ by one
cell at most in each dimension.  The sorted sequence is cut into runs, runs
into a tree of intervals, and pairs of intervals are joined from the top down:
a pair whose boxes are farther apart than epsilon in the leading dimensions is
skipped with all that lies below it.  Pairs of runs that are left are joined in
tasks, which go on halving the intervals and compare the last ones by the
cosine of the whole vectors in double precision.

Equal vectors of a label are one class.  A pair of runs gives each class its
number of links there and a spanning forest of the links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .staging import stage

AXES = 16                # leading principal dimensions that order and skip
FIT_ROWS = 4096          # vectors that the dimensions are fitted on; they decide the speed, not the result
RUN_ROWS = 2048          # classes of a run, and
RUN_BYTES = 4 << 20      # bytes of its vectors
LEAF_ROWS = 256          # an interval of a task that is not halved further
FAN_BITS = 4             # an interval of the tree has 16 parts
SLACK = 1e-9             # for rounding in the turned coordinates
DOUBT = 1e-12            # cosines so close to the limit are taken again in extended precision


def usable(vector: Column) -> Column:
    """The components as doubles; null for a vector without direction (null, empty, zero, null or non-finite parts)."""
    parts = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(parts, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.when(finite & F.exists(parts, lambda x: x != 0), parts)


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _axes(classes: DataFrame) -> np.ndarray:
    """Orthonormal leading directions (``AXES`` columns at most), shorter vectors counting as filled up with zeros."""
    rows = [np.array(r["x"]) for r in classes.select("x").orderBy(F.xxhash64("digest"), "digest").limit(FIT_ROWS).collect()]
    if not rows:
        return np.zeros((0, 0))
    filled = np.zeros((len(rows), max(map(len, rows))))
    for k, row in enumerate(rows):
        filled[k, :len(row)] = _units(row[None, :])[0]
    return np.linalg.svd(filled, full_matrices=False)[2][:AXES].T


def _matrix(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """Runs of rows whose vectors have one length, as matrices."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    ends = [*np.flatnonzero(np.diff(size)) + 1, len(size)]
    at = 0
    for end in ends:
        if end > at:
            yield at, end, column.slice(at, end - at).flatten().to_numpy(zero_copy_only=False).reshape(end - at, size[at])
        at = end


def _placed(classes: DataFrame, axes: np.ndarray, epsilon: float) -> DataFrame:
    """Each class with its place on the axes and its grid cells; the part of an axis that a vector lacks is zero."""
    def place(batches):
        for batch in batches:
            places = np.zeros((batch.num_rows, axes.shape[1]))
            for at, end, vectors in _matrix(batch.column(batch.schema.get_field_index("x"))):
                dims = min(vectors.shape[1], len(axes))
                places[at:end] = _units(vectors)[:, :dims] @ axes[:dims]
            cells = np.floor(places / epsilon).astype(np.int32)
            starts = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * axes.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(starts, pa.array(cells.ravel()))], names=[*batch.schema.names, "cell"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(place, f"{fields}, cell array<int>")


def _runs(ordered: DataFrame, axes: np.ndarray) -> DataFrame:
    """Sorted classes as rows of a run: its group, number, box on the axes, class ids, sizes and vectors."""
    schema = f"label {ordered.schema['label'].dataType.simpleString()}, dims int, task long, nth long, low array<double>, " \
             "high array<double>, n int, ids binary, sizes binary, vectors binary"

    def cut(batches):
        nth, held = 0, None

        def run(part: pa.Table) -> pa.RecordBatch:
            dims, vectors = part["dims"][0].as_py(), next(_matrix(part["x"]))[2]
            own = min(dims, len(axes))
            places = _units(vectors)[:, :own] @ axes[:own]
            values = [part["label"][0].as_py(), dims, TaskContext.get().partitionId(), nth, places.min(axis=0).tolist(),
                      places.max(axis=0).tolist(), len(part), part["class_id"].to_numpy().astype("<i8").tobytes(),
                      part["size"].to_numpy().astype("<i8").tobytes(), vectors.astype("<f8").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

        for batch in batches:
            part = pa.Table.from_batches([batch])
            types = [part.schema.field("label").type, pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float64()),
                     pa.list_(pa.float64()), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            names = ["label", "dims", "task", "nth", "low", "high", "n", "ids", "sizes", "vectors"]
            held = pa.concat_tables([held, part]) if held is not None else part
            while len(held):
                most = max(1, min(RUN_ROWS, RUN_BYTES // (8 * held["dims"][0].as_py())))
                same = _same_group(held, most)
                if same == len(held) < most:
                    break
                yield run(held.slice(0, same))
                nth, held = nth + 1, held.slice(same)
        if held is not None and len(held):
            yield run(held)

    return ordered.select("label", "dims", "class_id", "size", "x").mapInArrow(cut, schema)


def _same_group(table: pa.Table, most: int) -> int:
    """How many rows at the start, ``most`` at most, have the first row's label and length."""
    head = table.slice(0, most)
    label, dims = head["label"].to_pylist(), head["dims"].to_numpy()
    return next((k for k in range(len(head)) if label[k] != label[0] or dims[k] != dims[0]), len(head))


def _run_pairs(runs: DataFrame, epsilon: float) -> DataFrame:
    """Pairs of runs (a <= b) of a group whose boxes come within epsilon, from the top of the interval tree down."""
    top = runs.agg(F.max("run")).first()[0]
    if top is None:
        return runs.select("label", "dims", F.col("run").alias("a"), F.col("run").alias("b")).limit(0)
    boxes = runs.select("label", "dims", "run", "low", "high")

    def level(up: int) -> DataFrame:
        """Intervals of 16**up run numbers, with their boxes."""
        node = boxes.select("label", "dims", F.shiftright("run", FAN_BITS * up).alias("node"),
                            F.posexplode(F.arrays_zip("low", "high")).alias("axis", "r"))
        ends = node.groupBy("label", "dims", "node", "axis").agg(F.min("r.low").alias("low"), F.max("r.high").alias("high"))
        return ends.groupBy("label", "dims", "node").agg(F.sort_array(F.collect_list(F.struct("axis", "low", "high"))).alias("box"))

    height = -(-int(top).bit_length() // FAN_BITS)
    pairs = boxes.select("label", "dims", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).distinct()
    for up in range(height - 1, -1, -1):
        nodes = stage(level(up), "epsilon-nodes")
        parts = nodes.select("label", "dims", F.shiftright("node", FAN_BITS).alias("a"), F.col("node").alias("part_a"),
                             F.col("box").alias("box_a"))
        others = nodes.select("label", "dims", F.shiftright("node", FAN_BITS).alias("b"), F.col("node").alias("part_b"),
                              F.col("box").alias("box_b"))
        gap = F.aggregate(F.zip_with("box_a", "box_b", lambda p, q: F.greatest(
            p["low"] - q["high"], q["low"] - p["high"], F.lit(0.0))), F.lit(0.0), lambda total, x: total + x * x)
        pairs = stage(pairs.join(parts, ["label", "dims", "a"]).join(others, ["label", "dims", "b"])
                      .filter((F.col("part_a") <= F.col("part_b")) & (gap <= (epsilon + SLACK) ** 2))
                      .select("label", "dims", F.col("part_a").alias("a"), F.col("part_b").alias("b")), "epsilon-pairs")
    return pairs


class _Side:
    """A run in a task: ids, sizes, unit vectors, places on the axes."""

    def __init__(self, row: dict, axes: np.ndarray):
        self.ids, self.sizes = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["sizes"], "<i8")
        self.raw = np.frombuffer(row["vectors"], "<f8").reshape(row["n"], -1)
        self.unit = _units(self.raw)
        own = min(self.raw.shape[1], len(axes))
        self.place = self.unit[:, :own] @ axes[:own]
        self.links = np.zeros(len(self.ids), np.int64)


def _join_intervals(one: _Side, two: _Side, limit: float, epsilon: float, found) -> None:
    """Hand every linked pair of the two runs to ``found`` in blocks; of a run with itself each pair once."""
    itself, todo = one is two, [(0, len(one.ids), 0, len(two.ids))]
    while todo:
        a, b, c, d = todo.pop()
        if itself and c < a:
            continue
        p, q = one.place[a:b], two.place[c:d]
        gap = np.maximum(0, np.maximum(p.min(0) - q.max(0), q.min(0) - p.max(0)))
        if gap @ gap > (epsilon + SLACK) ** 2:
            continue
        if max(b - a, d - c) > LEAF_ROWS:
            # equal halves keep intervals of one run aligned, so that c < a tells the mirrored ones
            ab, cd = (a + b + 1) // 2, (c + d + 1) // 2
            halves_a = [(a, ab), (ab, b)] if b - a > LEAF_ROWS else [(a, b)]
            halves_c = [(c, cd), (cd, d)] if d - c > LEAF_ROWS else [(c, d)]
            todo += [(*x, *y) for x in halves_a for y in halves_c]
            continue
        cosine = one.unit[a:b] @ two.unit[c:d].T
        if itself:
            cosine[np.arange(a, b)[:, None] >= np.arange(c, d)[None, :]] = -2
        linked = cosine >= limit
        doubt = np.nonzero(np.abs(cosine - limit) <= DOUBT)
        for k in range(0, len(doubt[0]), 4096):
            i, j = doubt[0][k:k + 4096], doubt[1][k:k + 4096]
            x, y = (_units(s.raw[at].astype(np.longdouble)) for s, at in ((one, a + i), (two, c + j)))
            linked[i, j] = np.einsum("ij,ij->i", x, y).astype(np.float64) >= limit
        i, j = np.nonzero(linked)
        if len(i):
            found(a + i, c + j)


def _forest(one: _Side, two: _Side, limit: float, epsilon: float) -> list[tuple[int, int]]:
    """Count the links of each class of the two runs and keep as few of them as connect the same classes."""
    root = np.arange(len(one.ids) + (0 if one is two else len(two.ids)))
    shift = 0 if one is two else len(one.ids)
    edges: list[tuple[int, int]] = []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = int(root[x])
        return x

    def found(i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(one.links, i, two.sizes[j])
        np.add.at(two.links, j, one.sizes[i])
        # most links join what is joined already: only those between different roots are looked at one by one
        while len(i):
            flat = _flat(root)
            apart = flat[i] != flat[j + shift]
            i, j = i[apart], j[apart]
            if not len(i):
                return
            first = np.unique(i, return_index=True)[1]
            for x, y in zip(i[first].tolist(), j[first].tolist(), strict=True):
                p, q = find(x), find(y + shift)
                if p != q:
                    root[max(p, q)] = min(p, q)
                    edges.append((int(one.ids[x]), int(two.ids[y])))

    _join_intervals(one, two, limit, epsilon, found)
    return edges


def _flat(root: np.ndarray) -> np.ndarray:
    while True:
        further = root[root]
        if (further == root).all():
            return further
        root = further


def near_vectors(vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """Links between vectors of one label with at least that cosine, as one row per vector.

    Returns id_col, n_links (other rows linked directly), component_id (smallest
    id reachable by links, its own included) and kept (the row has that id).
    Rows whose label is null, or whose vector is null, empty, zero or holds null
    or non-finite components, link with nothing; nor do vectors of different
    lengths.  Equal vectors of a label are compared once and link with each
    other.  Repeated rows and ids count as often as they occur; of a component
    without any id the component_id is null and nothing is kept.  ``cosine`` is
    above 0.  Other columns are not looked at; an empty table gives an empty
    result.
    """
    epsilon = float(np.sqrt(2 - 2 * cosine))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), usable(F.col(vector_col)).alias("x"))
    rows = rows.withColumn("x", F.when(F.col("label").isNotNull(), F.col("x"))).withColumn(
        "digest", F.sha2(F.col("x").cast("string"), 256))
    alone = rows.filter("x is null")
    rows = rows.filter("x is not null")
    classes = stage(rows.groupBy("label", "digest").agg(F.min("id").alias("id"), F.count("*").alias("size"), F.min("x").alias("x"))
                    .withColumn("dims", F.size("x")).withColumn("class_id", F.monotonically_increasing_id()), "epsilon-classes")
    axes = _axes(classes)
    placed = _placed(classes.select("label", "dims", "class_id", "size", "x"), axes, epsilon)
    # the id comes last, so that a cell with many vectors is spread over tasks as well
    order = ["label", "dims", *[F.col("cell")[k] for k in range(axes.shape[1])], "class_id"]
    runs = stage(_runs(placed.repartitionByRange(*order).sortWithinPartitions(*order), axes), "epsilon-runs")
    nth = runs.agg(F.max("nth")).first()[0] or 0
    runs = runs.withColumn("run", F.shiftleft("task", int(nth).bit_length()) + F.col("nth"))
    pairs = _run_pairs(runs, epsilon)
    links = _links(runs, pairs, axes, cosine, epsilon)

    roots = connected_components(links.filter("other is not null").select(
        F.col("class_id").alias("a"), F.col("other").alias("b")))
    counts = links.groupBy("class_id").agg(F.sum("links").alias("links"))
    known = (classes.select("label", "digest", "class_id", "size", "id")
             .join(counts, "class_id", "left").join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
             .withColumn("root", F.coalesce("root", "class_id"))
             .withColumn("n_links", F.coalesce("links", F.lit(0).cast("long")) + F.col("size") - 1))
    lowest = known.groupBy("root").agg(F.min("id").alias("component_id"))
    known = known.join(lowest, "root").select("label", "digest", "n_links", "component_id")
    out = rows.select("id", "label", "digest").join(known, ["label", "digest"]).select("id", "n_links", "component_id")
    out = out.unionByName(alone.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _links(runs: DataFrame, pairs: DataFrame, axes: np.ndarray, cosine: float, epsilon: float) -> DataFrame:
    """Rows (class_id, other, links): links of a class in a pair of runs, or an edge of the pair's forest."""
    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("run"))
    both = sides.join(runs.select("run", "n", "ids", "sizes", "vectors"), "run")

    def compare(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["run"])
        one = _Side(rows[0], axes)
        two = _Side(rows[1], axes) if len(rows) > 1 else one
        edges = _forest(one, two, cosine, epsilon)
        ids = np.concatenate([s.ids[s.links > 0] for s in ({id(one): one, id(two): two}).values()])
        links = np.concatenate([s.links[s.links > 0] for s in ({id(one): one, id(two): two}).values()])
        return pa.table({
            "class_id": pa.array([*ids.tolist(), *[e[0] for e in edges]], pa.int64()),
            "other": pa.array([None] * len(ids) + [e[1] for e in edges], pa.int64()),
            "links": pa.array([*links.tolist(), *[0] * len(edges)], pa.int64())})

    return stage(both.groupBy("a", "b").applyInArrow(compare, "class_id long, other long, links long"), "epsilon-links")
