"""Hierarchical multi-length packing of tokenised documents.

Each document is tokenised once, where it is read.  Whole windows of the
longest length are cut off its head; what is left is routed to the smallest of
several context sizes (tiers) that holds it.  Each tier, from the longest down,
is packed into windows filled to the last token: a document and one to three
shorter ones, also from shorter tiers, whose lengths add up to the window.  What
finds no partners is cut into windows of the longest length, one after the
other.  The one window that a task cannot fill is handed to a second round over
few tasks.  Sequences are dealt to step groups of equal token budget, longest
tier first.

A task holds the ids of a bounded block of documents at a time; ids are cut
where they lie, and only unfilled windows are shuffled.
"""

from __future__ import annotations

import base64
import json
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage

TIERS = (256, 512, 1024, 2048)
END_OF_DOCUMENT = 1
STEP_TOKENS = 16 * 2048          # token budget of a step group
BLOCK_TOKENS = 4_000_000         # ids that a task holds before it packs
FILL_TASKS = 64                  # unfilled windows of so many tasks meet in one

PIECES = ("doc_id {id}, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "tier int, step_group long, ids binary")


@cache
def byte_bpe_encoder(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()):
    """Byte-level BPE from a file of ranks, with the ids of special strings."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


@cache
def added_tokens(tokenizer_path: str) -> tuple[tuple[str, int], ...]:
    """The strings that a tokenizers file takes out of a text before anything else, and their ids."""
    with open(tokenizer_path, encoding="utf-8") as file:
        return tuple((token["content"], token["id"]) for token in json.load(file)["added_tokens"])


def public_encoder() -> Callable[[str], list[int]]:
    """Ids of the public ``byte_bpe_50k`` vocabulary, those its tokenizers file gives: special strings included."""
    import public_tokenizers

    special = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    own = byte_bpe_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, special)
    return lambda text: own.encode(text, allowed_special="all", disallowed_special=())


def ordinary_encoder() -> Callable[[str], list[int]]:
    """Ids of the same vocabulary with special strings as ordinary text: no text encodes to a special id."""
    import public_tokenizers

    return byte_bpe_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).encode_ordinary


class _Block:
    """Tails of documents by length, packed when enough ids are there."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers, self.longest = tiers, tiers[-1]
        self.tails: list[tuple] = []        # (doc_id, start, doc_tokens, ids)
        self.tokens = 0

    def add(self, doc_id, start: int, doc_tokens: int, ids: np.ndarray) -> None:
        self.tails.append((doc_id, start, doc_tokens, ids))
        self.tokens += len(ids)

    def pack(self) -> tuple[list[tuple[int, list[tuple]]], list[tuple]]:
        """Filled windows (tier, parts), and the parts of the one that is not filled."""
        by_length: dict[int, list[tuple]] = defaultdict(list)
        for tail in self.tails:
            by_length[len(tail[3])].append(tail)
        counts = np.zeros(self.longest + 1, np.int64)
        for length, own in by_length.items():
            counts[length] = len(own)
        windows, rest = [], []
        for at in range(len(self.tiers) - 1, -1, -1):
            tier, shorter = self.tiers[at], self.tiers[at - 1] if at else 0
            for length in range(tier, shorter, -1):
                while counts[length]:
                    recipe = _fill(counts, length, tier - length)
                    if recipe is None:
                        rest += by_length[length]
                        by_length[length] = []
                        counts[length] = 0
                        break
                    uses = np.bincount(recipe, minlength=len(counts))
                    used = np.flatnonzero(uses)
                    for _ in range(int((counts[used] // uses[used]).min())):
                        windows.append((tier, [by_length[k].pop() for k in recipe]))
                    counts[used] = [len(by_length[k]) for k in used]
        window, free = [], self.longest
        for doc_id, start, doc_tokens, ids in rest:
            while len(ids):
                part = ids[:free]
                window.append((doc_id, start, doc_tokens, part))
                start, ids, free = start + len(part), ids[len(part):], free - len(part)
                if not free:
                    windows.append((self.longest, window))
                    window, free = [], self.longest
        self.tails, self.tokens = [], 0
        return windows, window


def _fill(counts: np.ndarray, length: int, gap: int) -> list[int] | None:
    """Lengths of at most three further documents that fill the gap exactly, or None."""
    if not gap:
        return [length]
    free = counts.copy()
    free[length] -= 1
    if gap < len(free) and free[gap]:
        return [length, gap]
    there = free[:gap] > 0

    def two(gap: int, there: np.ndarray, free: np.ndarray) -> list[int] | None:
        small = np.arange(1, (gap + 1) // 2)
        hit = small[there[small] & there[gap - small]]
        if len(hit):
            return [int(gap - hit[0]), int(hit[0])]
        return [gap // 2] * 2 if gap % 2 == 0 and free[gap // 2] > 1 else None

    found = two(gap, there, free)
    if found:
        return [length, *found]
    for third in np.flatnonzero(there)[::-1][:16]:
        free[third] -= 1
        found = two(gap - int(third), free[:gap - int(third)] > 0, free) if gap - third > 1 else None
        free[third] += 1
        if found:
            return [length, int(third), *found]
    return None


class _Writer:
    """Turns windows into rows of pieces; numbers sequences and step groups of a task."""

    def __init__(self, base: int, id_type: pa.DataType, step_tokens: int):
        self.base, self.id_type, self.step_tokens = base, id_type, step_tokens
        self.sequences = self.tokens = 0

    def rows(self, windows: list[tuple[int, list[tuple]]], filled: bool = True) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for tier, parts in sorted(windows, key=lambda w: -w[0]):
            sequence = self.base + self.sequences if filled else None
            offset = 0
            for doc_id, start, doc_tokens, ids in parts:
                rows.append((doc_id, start, len(ids), doc_tokens, sequence, offset, tier,
                             self.base + self.tokens // self.step_tokens if filled else None,
                             ids.astype("<u4").tobytes()))
                offset += len(ids)
                size += 4 * len(ids)
            self.sequences += 1
            self.tokens += tier
            if size > 4 << 20:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        types = [self.id_type, *[pa.int64()] * 5, pa.int32(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "tier", "step_group", "ids"])


def pack_documents(docs: DataFrame, encoder: Callable[[], Callable[[str], list[int]]] = public_encoder,
                   id_col: str = "doc_id", text_col: str = "text", tiers: tuple[int, ...] = TIERS,
                   end_id: int = END_OF_DOCUMENT, step_tokens: int = STEP_TOKENS,
                   block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pack all documents into sequences of at most ``tiers[-1]`` tokens.

    ``encoder`` makes the function text -> ids, in each task.  A document is its
    ids and then ``end_id``; a null or empty text is that id alone.  Texts of any
    length are cut; repeated rows are packed as often as they occur; null ids are
    kept.  Other columns are not looked at.  An empty table gives an empty result.

    Returns a row per piece: doc_id, start (its document's ids before it),
    length, doc_tokens, sequence_id, offset (in the sequence, gapless), tier (the
    sequence's size; a power of two), step_group, ids (little-endian unsigned 32
    bit).  All sequences are full but those that the second round cannot fill,
    one for each ``FILL_TASKS`` tasks.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    longest = tiers[-1]

    def first_round(batches):
        encode, block, writer = encoder(), _Block(tiers), None
        for batch in batches:
            writer = writer or _Writer(TaskContext.get().partitionId() << 32, batch.schema.field(0).type, step_tokens)
            whole: list[tuple[int, list[tuple]]] = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), end_id], np.uint32)
                doc_id, cut = doc_id.as_py(), len(ids) // longest * longest
                whole += [(longest, [(doc_id, k, len(ids), ids[k:k + longest])]) for k in range(0, cut, longest)]
                if cut < len(ids):
                    block.add(doc_id, cut, len(ids), ids[cut:])
                if len(whole) * longest > block_tokens // 4:
                    yield from writer.rows(whole)
                    whole = []
                if block.tokens >= block_tokens:
                    windows, left = block.pack()
                    yield from writer.rows(windows)
                    for part in left:
                        block.add(part[0], part[1], part[2], part[3])
            yield from writer.rows(whole)
        if writer:
            windows, left = block.pack()
            yield from writer.rows(windows)
            yield from writer.rows([(longest, left)] if left else [], filled=False)

    packed = stage(docs.mapInArrow(first_round, PIECES.format(id=id_type))
                   .withColumn("task", F.spark_partition_id()), "pieces")
    tasks = packed.agg(F.max("task")).first()[0] or 0
    fill = tasks // FILL_TASKS + 1

    def second_round(batches):
        block, writer = _Block(tiers), None
        for batch in batches:
            writer = writer or _Writer((tasks + 1 + TaskContext.get().partitionId()) << 32,
                                       batch.schema.field(0).type, step_tokens)
            for row in batch.to_pylist():
                block.add(row["doc_id"], row["start"], row["doc_tokens"], np.frombuffer(row["ids"], "<u4"))
        if writer:
            windows, left = block.pack()
            yield from writer.rows(windows)
            yield from writer.rows([(longest, left)] if left else [])

    unfilled = packed.filter("sequence_id is null").drop("task")
    return (packed.filter("sequence_id is not null").drop("task")
            .unionByName(unfilled.repartition(fill).mapInArrow(second_round, PIECES.format(id=id_type))))
