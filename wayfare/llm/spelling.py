"""Spelling variants: words that differ by one code point, found by dense tiles.

Two words are one edit apart exactly if the length of their common prefix plus
that of their common suffix reaches the longer length minus one.  So they share
the first or the last half of what an edit leaves; words meet in buckets of
such halves, by the longer length.  A bucket that is too large is cut again in
the same way: what is not yet shared has one edit in it, so one of its halves
is shared as well.  At the last cut one code point is left, and a bucket holds
at most one word for each letter and one without it: no bucket stays large and
no pair is lost.  Of all buckets that two words share, the one that follows
their common prefix at each cut counts them, once.

Buckets are laid side by side into tiles, padded matrices of the code points
that are not shared; each pair of tiles that have a bucket in common is
compared whole, position by position from either end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordscan as ws
from .staging import stage

BUCKET_WORDS = 512       # larger buckets are cut again
BUCKET_CODES = 1 << 20   # and those whose code points that are not shared are more
TILE_ROWS = 256          # words of a tile
TILE_CODES = 1 << 20     # code points of a tile, padding included
SEGMENT_BYTES = 4 << 20  # longer texts are read in such parts
TABLE_BYTES = 32         # of longer runs the checksum is taken one by one

_CRC = np.arange(256, dtype=np.uint32)      # the CRC-32 table, by its rule
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


def _letter_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to [A-Za-z\\u00C0-\\u00FF]: those letters of ASCII, and 0xC3 with the byte after it."""
    inside = ((data | 32) >= 97) & ((data | 32) <= 122) & (data < 128)
    lead = data == 0xC3
    inside |= lead
    inside[1:] |= lead[:-1]
    return inside


def _checksums(prefix: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each run, continued from its row's checksum; all runs a byte at a step."""
    state = prefix ^ np.uint32(0xFFFFFFFF)
    length = ends - starts
    left = np.flatnonzero(length <= TABLE_BYTES)
    for at in range(TABLE_BYTES):
        left = left[length[left] > at]
        if not len(left):
            break
        state[left] = _CRC[(state[left] ^ data[starts[left] + at]) & 0xFF] ^ (state[left] >> 8)
    out = state ^ np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(length > TABLE_BYTES):
        out[k] = zlib.crc32(data[starts[k]:ends[k]].tobytes(), int(prefix[k]))
    return out


def _results(ids: list[bytes], data: np.ndarray, offsets: np.ndarray, least: int, damage: int) -> pa.Array:
    """The words of a slice of rows, with repeats; runs too short to count are left out."""
    data = ws.LOWER_AZ[data]
    inside = _letter_bytes(data)
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before, now = np.zeros(len(data) + 1, dtype=bool), np.zeros(len(data) + 1, dtype=bool)
    before[1:], now[:-1] = inside, inside
    starts, ends = np.flatnonzero(now & (~before | first)), np.flatnonzero(before & (~now | first))
    code_points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    length = code_points[ends] - code_points[starts]
    long_enough = length >= least
    starts, ends, length = starts[long_enough], ends[long_enough], length[long_enough]
    if not len(starts):
        return pa.array([], pa.string())
    row = np.searchsorted(offsets, starts, side="right") - 1      # of rows that start there, the last holds it
    prefix = np.array([zlib.crc32(i + b":") for i in ids], np.uint32)
    checksum = _checksums(prefix[row], data, starts, ends)
    hit = checksum % damage == 0
    sizes = (ends - starts)[~hit]
    byte_at = np.repeat(starts[~hit] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    whole = pa.LargeStringArray.from_buffers(
        len(sizes), pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype("<i8")), pa.py_buffer(data[byte_at]))
    cut = []
    for k in np.flatnonzero(hit):
        if length[k] > least:
            word, at = data[starts[k]:ends[k]].tobytes().decode(), int(checksum[k]) % int(length[k])
            cut.append(word[:at] + word[at + 1:])
    return pa.concat_arrays([whole, pa.array(cut, pa.large_string())])


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Cut a very long text between words: (bytes, first row, row offsets into them)."""
    at = 0
    while len(data) - at > 2 * SEGMENT_BYTES:
        end = at + SEGMENT_BYTES
        while end < len(data) and data[end] not in (10, 32):     # a byte that no word and no code point holds
            end += 1
        row = int(np.searchsorted(offsets, at, side="right")) - 1
        yield data[at:end], row, np.clip(offsets[row:] - at, 0, end - at)
        at = end
    if at < len(data):
        row = int(np.searchsorted(offsets, at, side="right")) - 1
        yield data[at:], row, np.clip(offsets[row:] - at, 0, len(data) - at)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5,
                least_count: int = 3, damage: int = 97) -> DataFrame:
    """Words of all texts and how often they occur: (word, n).

    A run is a maximal ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased.  Where
    ``damage`` divides h, the CRC-32 of ``<id>:<run>``, the run loses its code
    point h % length.  Words are the results of at least ``least_length`` code
    points that occur ``least_count`` times or more.  Null and empty texts have
    none; a null id counts as empty; repeated rows count as often as they occur;
    other columns are not looked at.  Counts are combined by slice of text and by
    task before the exchange, so a word that is everywhere is a row of each task.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [i.encode() for i in batch.column(0).to_pylist()]
            for row, end, data, offsets in ws.text_slices(batch.column(1)):
                for part, first_row, own in _segments(data, offsets):
                    found = pc.value_counts(_results(ids[row + first_row:end], part, own, least_length, damage))
                    if len(found):
                        yield pa.RecordBatch.from_arrays(
                            [found.field(0).cast(pa.string()), found.field(1)], names=["word", "n"])

    return (rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least_count))


KEY = ["longer", "front", "back", "below", "key"]


def _cut(rows: DataFrame) -> DataFrame:
    """Each row once with the first and once with the last half of the rest shared."""
    step = F.expr("int((longer - front - back) / 2)")
    first = F.struct((F.col("front") + step).alias("front"), F.col("back"), F.col("below"))
    last = F.struct(F.col("front"), (F.col("back") + step).alias("back"),
                    F.least("below", F.col("front") + step).alias("below"))
    cut = rows.select("word", "n", "longer", F.explode(F.array(first, last)).alias("p")).select(
        "word", "n", "longer", "p.*")
    return cut.withColumn("key", F.concat(F.expr("substring(word, 1, front)"), F.lit("\0"),
                                          F.expr("substring(word, length(word) - back + 1, back)")))


def _buckets(words: DataFrame) -> DataFrame:
    """Every word in its buckets of at most ``BUCKET_WORDS`` words; words alone in a bucket are left out.

    ``longer`` is the length of a bucket's longer words (the others have one code
    point less), ``front`` and ``back`` say how many code points at the ends are
    shared; pairs whose common prefix is not below ``below`` belong elsewhere.
    """
    length = F.length("word")
    rows = _cut(words.select("word", "n", F.explode(F.array(length, length + 1)).alias("longer")).select(
        "*", F.lit(0).alias("front"), F.lit(0).alias("back"), (F.col("longer") + 1).alias("below")))
    ready = None
    while True:
        free = F.col("longer") - F.col("front") - F.col("back")
        sizes = rows.groupBy(*KEY).agg(F.count("*").alias("size")).filter("size > 1").withColumn(
            "cut", (free > 1) & ((F.col("size") > BUCKET_WORDS) | (F.col("size") * free > BUCKET_CODES)))
        met = stage(rows.join(stage(sizes.drop("size"), "spelling-sizes"), KEY), "spelling-met")
        small = met.filter("not cut").drop("cut")
        ready = small if ready is None else ready.unionByName(small)
        if met.filter("cut").isEmpty():
            return ready
        rows = _cut(met.filter("cut"))


class _Rows:
    """Rows of whole buckets, sorted by bucket: code points, windows and ranks of their words."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        word = table["word"].combine_chunks().cast(pa.large_string())
        _, offsets, data = word.buffers()
        at = np.frombuffer(offsets, np.int64)[word.offset:word.offset + len(word) + 1]
        text = data.to_pybytes()[at[0]:at[-1]].decode()
        self.codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        self.length = pc.utf8_length(word).to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.word, self.n = word, table["n"].to_numpy()
        self.longer, self.front, self.back, self.below = (
            table[c].to_numpy().astype(np.int64) for c in ("longer", "front", "back", "below"))
        self.free = self.longer - self.front - self.back
        self.bucket = _bucket_numbers(table)
        spelt = word.cast(pa.large_binary()).to_pylist()
        self.rank = np.empty(len(spelt), np.int64)
        self.rank[sorted(range(len(spelt)), key=spelt.__getitem__)] = np.arange(len(spelt))

    def tiles(self) -> list[tuple[int, int]]:
        out, at = [], 0
        while at < len(self.free):
            end = min(at + TILE_ROWS, len(self.free))
            while end - at > 1 and (end - at) * int(self.free[at:end].max()) > TILE_CODES:
                end = at + (end - at) // 2
            out.append((at, end))
            at = end
        return out

    def windows(self, at: int, end: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``free`` code points after the shared front, and those before the shared back from right to left."""
        rows = slice(at, end)
        place = np.arange(int(self.free[rows].max()))[None, :]
        left = self.front[rows, None] + place
        right = (self.length - self.back)[rows, None] - 1 - place
        inside = place < self.free[rows, None]
        out = []
        for where in (left, right):
            there = inside & (where >= 0) & (where < self.length[rows, None])
            out.append(np.where(there, self.codes[np.where(there, self.start[rows, None] + where, 0)], pad))
        return out[0], out[1]

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of near words (i < j), each from the one bucket that counts it."""
        tiles = self.tiles()
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k, (at, end) in enumerate(tiles):
            mine = self.windows(at, end, 0)
            for other_at, other_end in tiles[k:]:
                if self.bucket[other_at] > self.bucket[end - 1]:
                    break
                theirs = self.windows(other_at, other_end, 1)
                i, j = self._compare((at, end, mine), (other_at, other_end, theirs))
                left.append(i)
                right.append(j)
        return np.concatenate(left), np.concatenate(right)

    def _compare(self, one, two) -> tuple[np.ndarray, np.ndarray]:
        (at, end, mine), (other_at, other_end, theirs) = one, two
        a, b = np.arange(at, end)[:, None], np.arange(other_at, other_end)[None, :]
        wanted = (self.bucket[a] == self.bucket[b]) & (a < b) & (
            np.maximum(self.length[a], self.length[b]) == self.longer[a])
        shared = []
        for x, y in zip(mine, theirs, strict=True):
            alive, count = wanted.copy(), np.zeros(wanted.shape, np.int32)
            for p in range(min(x.shape[1], y.shape[1])):
                alive &= x[:, p, None] == y[None, :, p]
                if not alive.any():
                    break
                count += alive
            shared.append(count)
        prefix, suffix = shared[0] + self.front[at:end, None], shared[1] + self.back[at:end, None]
        i, j = np.nonzero(wanted & (prefix < self.below[at:end, None])
                          & (prefix + suffix >= self.longer[at:end, None] - 1))
        return i + at, j + other_at


def _bucket_numbers(table: pa.Table) -> np.ndarray:
    new = np.zeros(len(table), dtype=bool)
    for name in KEY:
        column = table[name].combine_chunks()
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return np.cumsum(new)


NEAR = "word string, n_near long, best_n long, best string"


def _near_by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word of a run of buckets: how many near words it has there, and the most frequent of them."""
    held: pa.Table | None = None

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not len(table):
            return
        rows = _Rows(table)
        i, j = rows.near()
        own, other = np.concatenate([i, j]), np.concatenate([j, i])
        if len(own):
            order = np.lexsort((rows.rank[other], -rows.n[other], own))
            word, first, count = np.unique(own[order], return_index=True, return_counts=True)
            best = other[order][first]
            yield pa.RecordBatch.from_arrays(
                [rows.word.take(pa.array(word)).cast(pa.string()), pa.array(count, pa.int64()),
                 pa.array(rows.n[best], pa.int64()), rows.word.take(pa.array(best)).cast(pa.string())],
                names=["word", "n_near", "best_n", "best"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        bucket = _bucket_numbers(held)
        whole = int(np.searchsorted(bucket, bucket[-1])) if len(bucket) else 0     # the last bucket may go on
        yield from found(held.slice(0, whole))
        held = held.slice(whole)
    if held is not None:
        yield from found(held)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by doubling: each round a word looks at where its last stop points; n doubles at each form."""
    reached = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        jump = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if reached.join(jump, "root", "left_semi").isEmpty():
            return reached
        reached = stage(reached.join(jump, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root")), "spelling-roots")


def spelling_variants(words: DataFrame) -> DataFrame:
    """Near words of each word, its form and its root.

    ``words`` has a string ``word`` and a long ``n``; words are distinct (of a
    repeated word the largest n counts), rows with a null word or n and empty
    words are left out, other columns are not looked at, an empty table gives an
    empty result.  Two words are near if they differ by exactly one inserted,
    deleted or replaced code point; words may be of any length.  A word's form is
    its near word of largest n (ties: the smallest in code-point order) if that n
    is at least twice its own.

    Returns word, n, n_near, form, form_n (null without a form), root (the last
    word reached by following forms; the word itself if it has none).
    """
    words = stage(words.filter("word is not null and word <> '' and n is not null").groupBy("word").agg(
        F.max("n").alias("n")), "spelling-words")
    near = (_buckets(words).repartition(*KEY).sortWithinPartitions(*KEY).select("word", "n", *KEY)
            .mapInArrow(_near_by_word, NEAR).groupBy("word")
            .agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")))
    top_n = -F.col("top.less")
    found = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(top_n >= 2 * F.col("n"), F.col("top.best")).alias("form"),
        F.when(top_n >= 2 * F.col("n"), top_n).alias("form_n")), "spelling-forms")
    roots = _roots(found.filter("form is not null"))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
