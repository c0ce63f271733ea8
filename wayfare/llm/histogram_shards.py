"""Shards of near-equal bytes by histogram sort.

The rows have a total order: hash of the text, hash of the id, id.  Splitters
between the shards are found by counting exact bytes below candidate keys over
all partitions, and by refining the candidates around each wanted position
until one is close enough; then the rows are exchanged once.  A group of equal
texts is cut only where no group edge is close enough, so copies stay together
unless a group is large, and then it is cut by the hash of the id.  DataFrame
functions only; every round sends a table of fixed size to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage

TOLERANCE = 0.005   # of a shard's ideal bytes, between a splitter and its wanted position
PROBES = 256        # candidate keys between two neighbours, for each splitter and round
CELLS = 4096        # parts of the hash range in which slots are numbered
CELL_SHARE = 1 / 2048  # a cell with a larger share of the rows is sliced by the hash of the id


@dataclass(frozen=True)
class Splitter:
    """Rows with (hash, id hash) at or above this key lie behind the splitter."""
    text: int
    id: int


def _keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 1).alias("t"),
        F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string")), 1).alias("i"))


@dataclass
class _Search:
    """Where one splitter is looked for: keys low to high of one level."""
    wanted: float
    below: int           # bytes below the interval
    low: int
    high: int            # inclusive
    text: int | None     # None: the keys are text hashes; else id hashes within this text hash
    best: tuple[float, Splitter] | None = None

    def offer(self, bytes_below: int, key: Splitter) -> None:
        off = abs(bytes_below - self.wanted)
        if self.best is None or off < self.best[0]:
            self.best = (off, key)


def _counts(keys: DataFrame, searches: dict[int, _Search]) -> dict[int, list]:
    """For each search, (probe, bytes, least key, greatest key) in order of the probes."""
    which, probe, key = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("long")
    for k, s in searches.items():
        at = "t" if s.text is None else "i"
        inside = F.col(at).between(s.low, s.high) & (F.lit(True) if s.text is None else F.col("t") == s.text)
        width = (s.high - s.low) // PROBES + 1
        which = F.when(inside, F.lit(k)).otherwise(which)
        probe = F.when(inside, F.expr(f"({at} - {s.low}L) div {width}L")).otherwise(probe)
        key = F.when(inside, F.col(at)).otherwise(key)
    found = (keys.select(which.alias("search"), probe.alias("probe"), key.alias("key"), "size")
             .filter("search is not null").groupBy("search", "probe")
             .agg(F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high")).collect())
    out: dict[int, list] = {}
    for row in sorted(found, key=lambda r: (r["search"], r["probe"])):
        out.setdefault(row["search"], []).append((row["bytes"], row["low"], row["high"]))
    return out


def find_splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[Splitter]:
    """The ``shards - 1`` splitters of a table with the columns t, i and size."""
    span = keys.agg(F.sum("size").alias("bytes"), F.min("t").alias("low"), F.max("t").alias("high")).first()
    if span["bytes"] is None:
        return [Splitter(0, 0)] * (shards - 1)
    close = tolerance * span["bytes"] / shards
    every = [_Search(span["bytes"] * (k + 1) / shards, 0, span["low"], span["high"], None) for k in range(shards - 1)]
    open_ones = list(every)
    while open_ones:
        # Splitters that look in the same interval share its counts.
        shared = {(s.text, s.low, s.high): k for k, s in reversed(list(enumerate(open_ones)))}
        counted = _counts(keys, {k: open_ones[k] for k in shared.values()})
        left = []
        for s in open_ones:
            below = s.below
            cells = counted[shared[(s.text, s.low, s.high)]]
            for at, (size, low, high) in enumerate(cells):
                s.offer(below, Splitter(low, 0) if s.text is None else Splitter(s.text, low))
                if below + size >= s.wanted or at == len(cells) - 1:
                    break
                below += size
            behind = cells[at + 1][1] if at + 1 < len(cells) else high + 1
            s.offer(below + size, Splitter(behind, 0) if s.text is None else Splitter(s.text, behind))
            if s.best[0] <= close:
                continue
            if low < high:
                s.below, s.low, s.high = below, low, high
                left.append(s)
            elif s.text is None:  # one text hash holds the place: look among its ids
                s.below, s.low, s.high, s.text = below, 0, (1 << 63) - 1, low
                left.append(s)
        open_ones = left
    return sorted((s.best[1] for s in every), key=lambda x: (x.text, x.id))


def _shard(splitters: list[Splitter]) -> Column:
    behind = [(F.col("t") > s.text) | ((F.col("t") == s.text) & (F.col("i") >= s.id)) for s in splitters]
    return sum((b.cast("int") for b in behind), F.lit(0))


def histogram_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                     tolerance: float = TOLERANCE) -> DataFrame:
    """Put every row into a shard so that the shards' bytes are near equal.

    Size of a row: UTF-8 bytes of its text plus 1; a null text counts as empty
    (checksum 0).  Rows with equal id and text are interchangeable, and lie next
    to one another; a null id hashes like any other value.  A text larger than a
    shard's share makes its shard larger by what it has too much.  Other columns
    are not looked at.  An empty table gives an empty result.

    Returns doc_id, size, text_crc32, shard (0 to shards - 1), slot (gapless from
    0 in each shard, in the order of the sort within cells).
    """
    keys = stage(_keys(docs, id_col, text_col), "shard-keys")
    splitters = find_splitters(keys, shards, tolerance)
    cell = F.shiftright("t", 63 - CELLS.bit_length() + 1).cast("int")
    placed = keys.withColumn("shard", _shard(splitters)).withColumn("cell", cell)

    # Cells with many rows are sliced by the hash of the id, into slices of a bounded share.
    per_cell = keys.groupBy(cell.alias("cell")).agg(F.count("*").alias("rows"))
    most = max(1.0, keys.count() * CELL_SHARE)
    slices = per_cell.filter(F.col("rows") > most).select("cell", F.ceil(F.col("rows") / most).alias("slices"))
    # One row per cell at most, and at most 1 / CELL_SHARE of them are that large.
    placed = (placed.join(F.broadcast(slices), "cell", "left")
              .withColumn("slice", F.when(F.col("slices").isNull(), 0).otherwise(F.col("i") % F.col("slices"))))
    numbers = placed.groupBy("shard", "cell", "slice").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("cell", "slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = numbers.select("shard", "cell", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard", "cell", "slice").orderBy("t", "i", "doc_id", "size")
    return (placed.withColumn("n", F.row_number().over(within))
            .join(bases, ["shard", "cell", "slice"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("n") - 1).alias("slot")))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the rows of ``docs`` into one folder per shard, in the order of the slots.

    Ids must be distinct.  Columns of ``docs`` named shard, slot or placed_id are left out.
    """
    spread = placed.select(F.col("doc_id").alias("placed_id"), "shard", "slot")
    docs = docs.drop("shard", "slot", "placed_id")
    (docs.join(spread, docs[id_col].eqNullSafe(spread["placed_id"])).drop("placed_id")
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))

