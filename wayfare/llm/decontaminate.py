"""Benchmark passages in documents, found with an FM-index of each training shard.

Windows of a benchmark item's words are the test phrases.  Each task cuts its
documents into shards, numbers the words that occur in the benchmark, a piece of
a shard at a time, leaves out the stretches that are too short to hold a phrase,
and indexes the rest.
All phrases are searched backward at once; their places give the spans of words
to remove, merged per document.  Documents are not shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import wordscan as ws
from .fm_index import FMIndex
from .staging import stage, text_digest, without

WINDOW = 13
SHARD_BYTES = 8 << 20            # a shard is full with so much text,
SHARD_WORDS = 1 << 19            # or so many words to index (some 70 MB while it is built)
PIECE_BYTES = 1 << 20            # text that is cut into words at a time
BLOCK_BYTES = 4 << 20            # benchmark text that is searched in one scan: some 600,000 windows, 40 MB


class Phrases:
    """Distinct windows of benchmark items, as rows of word numbers (1 and up; 0 fills short ones).

    Arrays only: 52 bytes a window and 4 for each item that has it; the items are
    ``items[owners[owner_at[k]:owner_at[k + 1]]]`` for window k.
    """

    def __init__(self, items: list[tuple], window: int):
        texts = pa.array([t or "" for _, t in items], pa.string())
        words, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for _, _, data, offsets in ws.text_slices(texts):
            starts, ends, at = ws.find_words(data, offsets, ws.ALPHANUMERIC)
            words.append(ws.hash_words(data, starts, ends))
            sizes.append(np.diff(at))
        hashes, size = np.concatenate(words), np.concatenate(sizes)
        self.vocabulary, numbers = np.unique(hashes, return_inverse=True)
        numbers = np.concatenate([numbers.astype(np.int32) + 1, np.zeros(window, np.int32)])
        self.items, owner_of = np.unique(np.array([str(item) for item, _ in items], dtype=object), return_inverse=True)
        # an item has a window at each of its words that window - 1 others follow, and one if it has fewer words
        windows = np.where(size > 0, np.maximum(size - window + 1, 1), 0)
        item = np.repeat(np.arange(len(size)), windows)
        nth = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
        start = (np.cumsum(size) - size)[item] + nth
        length = np.minimum(size[item], window)
        rows = np.lib.stride_tricks.sliding_window_view(numbers, window)[start]      # a copy
        rows[np.arange(window)[None, :] >= length[:, None]] = 0
        self.rows, which = np.unique(rows, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.reshape(-1), owner_of[item]]), axis=1) if len(item) else np.empty((2, 0), np.int64)
        self.owners = pairs[1].astype(np.int32)
        self.owner_at = np.searchsorted(pairs[0], np.arange(len(self.rows) + 1))
        self.lengths = (self.rows > 0).sum(axis=1)
        self.shortest = int(self.lengths.min(initial=window))

    def owned_by(self, phrase: int) -> list[str]:
        return self.items[self.owners[self.owner_at[phrase]:self.owner_at[phrase + 1]]].tolist()

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers of hashes; 0 for words that no item has."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def _long_runs(numbers: np.ndarray, breaks: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Text of the runs of known words that can hold a phrase, a 0 after each; word of each symbol."""
    known = numbers > 0
    begins = known.copy()
    begins[1:] &= ~known[:-1] | breaks[1:]
    starts = np.flatnonzero(begins)
    stops = known.copy()
    stops[:-1] &= ~known[1:] | breaks[1:]
    ends = np.flatnonzero(stops) + 1
    long = ends - starts >= shortest
    starts, lengths = starts[long], (ends - starts)[long]
    first = np.cumsum(lengths + 1) - lengths - 1
    words = np.repeat(starts - first, lengths + 1) + np.arange((lengths + 1).sum())
    text = np.zeros(len(words), np.int64)
    inside = np.ones(len(words), bool)
    inside[first + lengths] = False
    text[inside] = numbers[words[inside]]
    return text, words


def _known_words(phrases: Phrases, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a piece of text: each row's first word (rows + 1 entries), and what _long_runs gives."""
    starts, ends, word_at = ws.find_words(data, offsets, ws.ALPHANUMERIC)
    numbers = phrases.numbers(ws.hash_words(data, starts, ends))
    breaks = np.zeros(len(numbers) + 1, bool)
    breaks[word_at] = True
    return word_at, *_long_runs(numbers, breaks[:-1], phrases.shortest)


def _shards(phrases: Phrases, column: pa.Array) -> Iterator[tuple[int, list[tuple]]]:
    """End row and pieces (see _known_words) of each shard of a text column."""
    pieces, size, symbols = [], 0, 0
    for _, end, data, offsets in ws.text_slices(column, PIECE_BYTES):
        pieces.append(_known_words(phrases, data, offsets))
        size += len(data)
        symbols += len(pieces[-1][1])
        if size >= SHARD_BYTES or symbols >= SHARD_WORDS or end == len(column):
            yield end, pieces
            pieces, size, symbols = [], 0, 0


def _search(phrases: Phrases, pieces: list[tuple]) -> Iterator[tuple[int, list, set]]:
    """For each document of a shard: words, merged spans [start, end) of words, items."""
    before = np.cumsum([0] + [word_at[-1] for word_at, _, _ in pieces])
    word_at = np.concatenate([p[0][:-1] + b for p, b in zip(pieces, before, strict=False)] + [before[-1:]])
    text = np.concatenate([p[1] for p in pieces])
    word_of = np.concatenate([p[2] + b for p, b in zip(pieces, before, strict=False)])
    hits = np.zeros(before[-1] + 1, np.int32)
    items: dict[int, set] = defaultdict(set)
    if len(text) and len(phrases.rows):
        index = FMIndex(text)
        low, high = index.ranges(phrases.rows, phrases.lengths)
        found = high - low
        phrase = np.repeat(np.arange(len(found)), found)
        rows = np.repeat(low - (np.cumsum(found) - found), found) + np.arange(found.sum())
        at = word_of[index.locate(rows)]
        np.add.at(hits, at, 1)
        np.add.at(hits, at + phrases.lengths[phrase], -1)
        docs = np.searchsorted(word_at, at, side="right") - 1
        for doc, k in np.unique(np.stack([docs, phrase]), axis=1).T:
            items[int(doc)].update(phrases.owned_by(k))
    covered = np.cumsum(hits[:-1], dtype=np.int32) > 0
    for doc in range(len(word_at) - 1):
        own = covered[word_at[doc]:word_at[doc + 1]]
        spans: list = []
        if own.any():
            edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
            spans = edges.reshape(-1, 2).tolist()
        yield len(own), spans, items.get(doc, set())


def _scan(docs: DataFrame, phrases: Phrases) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def scan(batches):
        for batch in batches:
            row = 0
            for end, pieces in _shards(shared.value, batch.column(1)):
                found = list(_search(shared.value, pieces))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row),
                     pa.array([f[0] for f in found], pa.int64()),
                     pa.array([[{"start": a, "end": b} for a, b in f[1]] for f in found], pa.list_(span)),
                     pa.array([sorted(f[2]) for f in found], pa.list_(pa.string()))],
                    names=["doc_id", "n_words", "spans", "items"])
                row = end

    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {id_type}, n_words long, spans array<struct<start:long,end:long>>, items array<string>")


def merged_spans(spans: Column) -> Column:
    """Overlapping or touching [start, end) spans of an array as one, in order."""
    def add(merged: Column, span: Column) -> Column:
        last = F.try_element_at(merged, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(last.isNull() | (span["start"] > last["end"]), F.concat(merged, F.array(span))).otherwise(
            F.concat(F.slice(merged, 1, F.size(merged) - 1), F.array(longer)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<start:bigint,end:bigint>>"), add)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """The benchmark's items in blocks of about ``block_bytes``; the driver holds one block."""
    block, size = [], 0
    for row in benchmark.toLocalIterator():
        block.append((row["item_id"] or "", row["text"]))
        size += len(row["text"] or "")
        if size >= block_bytes:
            yield block
            block, size = [], 0
    yield block


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Words of each document that lie in an occurrence of a benchmark window.

    Words: runs of 0-9, a-z and non-ASCII characters, A-Z lower-cased.  An item's
    windows are its runs of ``window`` words; an item of fewer, but not none, is
    one window.  An occurrence lies within one document.

    The benchmark is broadcast in blocks of bounded size, one scan of the
    documents for each; several blocks are merged per row afterwards.  Null or
    empty texts have no words, null items no windows; equal items all count.
    Repeated rows stay repeated.  Other columns are not looked at.  An empty
    table gives an empty result, an empty benchmark no hits.

    Returns doc_id, n_words, spans (start and end word, merged), items (sorted
    ids, as strings).
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    benchmark = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col("text"))
    blocks = _blocks(benchmark.filter("text is not null"), block_bytes)
    first, second = next(blocks), next(blocks, [])
    if not second:
        return _scan(docs, Phrases(first, window))
    return _merged([_keyed_scan(docs, Phrases(block, window)) for block in chain([first, second], blocks) if block])


def _keyed_scan(docs: DataFrame, phrases: Phrases) -> DataFrame:
    """A block's hits, staged, with the hash of the text that tells rows of one id apart."""
    keyed = docs.withColumn("doc_id", F.struct("doc_id", F.sha2("text", 256).alias("text")))
    return stage(_scan(keyed, phrases), "benchmark-block")


def _merged(parts: list[DataFrame]) -> DataFrame:
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return (every.groupBy("doc_id").agg(
                F.first("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
                (F.count("*") / len(parts)).cast("int").alias("copies"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(F.col("doc_id.doc_id").alias("doc_id"), "n_words", merged_spans(F.col("spans")).alias("spans"), "items"))


def contamination(hits: DataFrame) -> DataFrame:
    """Digest of benchmark_hits: hit words, items, and whether at least 1 word in 20 is hit."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, unchanged.

    Rows are recognised by their id and a 64-bit digest of their text, so texts with
    null or shared ids are judged as themselves.  Null texts stay.  Other columns may
    have any names.
    """
    text = F.col("text").cast("string")
    key = F.struct(F.col("doc_id").alias("gone_id"), text_digest(text).alias("gone_text"))
    judged = contamination(benchmark_hits(docs.select(key.alias("key"), text.alias("text")), benchmark, "key"))
    return without(docs, judged.filter("contaminated").select("doc_id.*"), "contaminated")
