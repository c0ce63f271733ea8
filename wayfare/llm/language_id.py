"""Language identification by character language models.

One interpolated Kneser-Ney model per language, over runs of letters with single
spaces between them, estimated in Spark from all n-grams of all training texts:
nothing is pruned, and there may be any number of languages.  Each language has
its own sorted arrays of n-grams and contexts, written in pieces to the shared
scratch folder and searched there, a language at a time; the distinct n-grams of
a slice of text are looked up once.  The language with the lowest cross-entropy
per character wins; texts whose cross-entropy is far above what that language's
own texts of such a length have are rejected.  Those limits come from all training texts, each
scored by a model of the half of the texts that it is not in.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from dataclasses import dataclass, field
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.session import scratch_path

from . import wordscan as ws
from .staging import stage

ORDER = 4                   # symbols of an n-gram; 16 bits each
PIECE_ENTRIES = 1 << 20     # entries of a piece of a language's arrays
SLICE_BYTES = 1 << 19       # text that a task turns into arrays at a time
REJECT_DEVIATIONS = 10.0     # standard deviations above the mean cross-entropy
KEPT_SHARE = 0.999          # of a language's own texts of a length class at least so many are accepted
CLASS_TEXTS = 100           # a limit is set by at least so many texts, of near length classes if need be
WHOLE, HALVES = "=", "01"   # first letter of a model's name: of all texts, of one half of them
UNDETERMINED = "und"

_BOUNDARY, _SPACE = 1, 32
_SYMBOL = np.uint64(16)
_HASH = np.uint64(0x9E3779B97F4A7C15)


@cache
def _symbols() -> np.ndarray:
    """Symbol of each code point: a lower-cased letter, or a space for all else.

    Letters beyond 16 bits share the symbols of the private use area.
    """
    table = np.full(0x110000, _SPACE, np.uint16)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            code = ord(low) if len(low) == 1 else code
            table[code if code == ord(char) else ord(char)] = code if code < 0xD800 else 0xE000 + code % 0x1800
    return table


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the n-grams that end at each symbol, and each row's first one (rows + 1)."""
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    symbols = _symbols()[codes]
    space = symbols == _SPACE
    after = np.empty(len(symbols), bool)
    after[1:] = space[:-1]
    after[:1] = True
    after[at[:-1][at[:-1] < len(symbols)]] = True
    kept = np.flatnonzero(~(space & after))
    first = np.searchsorted(kept, at)
    rows = len(offsets) - 1
    padded = np.full(len(kept) + rows * (ORDER - 1), _BOUNDARY, np.uint64)
    places = np.arange(len(kept)) + np.repeat(np.arange(1, rows + 1), np.diff(first)) * (ORDER - 1)
    padded[places] = symbols[kept]
    keys = padded[places]
    for back in range(1, ORDER):
        keys |= padded[places - back] << np.uint64(16 * back)
    return keys, first


def _has_letter(keys: np.ndarray) -> bool:
    return bool(((keys & np.uint64(0xFFFF)) != _SPACE).any())


class HashArray:
    """Sorted hashes with the rows of a matrix; a directory of leading bits shortens the search."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        hashes = keys * _HASH
        order = np.argsort(hashes)
        self.hashes, self.rows = hashes[order], np.ascontiguousarray(rows[order], np.float32)
        self.bits = max(1, len(keys).bit_length())
        lead = (self.hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        self.starts = np.searchsorted(lead, np.arange((1 << self.bits) + 1)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        hashes = keys * _HASH
        lead = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.starts[lead], self.starts[lead + 1]
        found = np.full(len(keys), -1, np.int32)
        if not len(self.hashes):
            return found
        here = self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes
        here &= at < end
        found[here] = at[here]
        left = np.flatnonzero(~here & (at + 1 < end))
        step = 1
        while len(left):
            here = self.hashes[at[left] + step] == hashes[left]
            found[left[here]] = at[left[here]] + step
            left = left[~here]
            step += 1
            left = left[at[left] + step < end[left]]
        return found


def _below(order: int) -> int:
    """Mask of the last ``order`` symbols."""
    return (1 << 16 * order) - 1


@dataclass(frozen=True)
class Piece:
    """A run of sorted keys (int64) and, after them, their values (float32) in a file of the shared folder."""
    first: int
    size: int
    path: str
    offset: int


@cache
def _opened(path: str):
    system, name = fs.FileSystem.from_uri(path)
    if isinstance(system, fs.LocalFileSystem):
        system = fs.LocalFileSystem(use_mmap=True)
    return system.open_input_file(name)


@lru_cache(maxsize=16)
def _loaded(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values; mapped, not copied, where the shared folder is mounted."""
    file = _opened(piece.path)
    file.seek(piece.offset)
    data = file.read_buffer(12 * piece.size)
    return np.frombuffer(data, np.int64, piece.size), np.frombuffer(data, np.float32, piece.size, 8 * piece.size)


def _ladder(keys: np.ndarray, order: int) -> tuple[np.ndarray, list[tuple]]:
    """Each key's place among the distinct ones, and by order, from 1: the distinct keys, the distinct contexts,
    each key's context, each key's place in the order below."""
    distinct, place = np.unique((keys & np.uint64(_below(order))).view(np.int64), return_inverse=True)
    steps = []
    for k in range(order, 0, -1):
        own = distinct.view(np.uint64)
        contexts, context_at = np.unique((own >> _SYMBOL).view(np.int64), return_inverse=True)
        lower, lower_at = np.unique((own & np.uint64(_below(k - 1))).view(np.int64), return_inverse=True)
        steps.append((distinct, contexts, context_at, lower_at))
        distinct = lower
    return place, steps[::-1]


@dataclass
class LanguageModel:
    languages: list[str]
    grams: list[HashArray]                           # the symbols of all languages
    pieces: dict = field(default_factory=dict)       # (language, order, of contexts) -> pieces by key
    limits: dict = field(default_factory=dict)       # (language, length class) -> highest cross-entropy

    @property
    def unknown(self) -> float:
        """Log-probability of an unseen symbol in no context."""
        return -math.log(len(self.grams[0].hashes) + 1)

    def _find(self, lang: str, order: int, contexts: bool, keys: np.ndarray) -> np.ndarray:
        """Value of each of the sorted keys, nan if it is not there."""
        values = np.full(len(keys), np.nan, np.float32)
        pieces = self.pieces.get((lang, order, contexts), [])
        cuts = [*np.searchsorted(keys, [p.first for p in pieces]), len(keys)]
        for piece, start, end in zip(pieces, cuts, cuts[1:], strict=False):
            if start < end:
                known, logs = _loaded(piece)
                at = np.minimum(np.searchsorted(known, keys[start:end]), len(known) - 1)
                values[start:end] = np.where(known[at] == keys[start:end], logs[at], np.float32(np.nan))
        return values

    def _of_distinct(self, lang: str, steps: list[tuple]) -> np.ndarray:
        """Log-probability of the last symbol of each distinct key of the highest order."""
        scores = np.full(1, self.unknown, np.float32)
        for order, (distinct, contexts, context_at, lower_at) in enumerate(steps, 1):
            seen = self._find(lang, order, False, distinct)
            weights = np.nan_to_num(self._find(lang, order, True, contexts), nan=0.0)
            scores = np.where(np.isnan(seen), weights[context_at] + scores[lower_at], seen)
        return scores

    def _scores(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Log-probability of each key's last symbol, by language."""
        place, steps = _ladder(keys, order)
        return np.stack([self._of_distinct(lang, steps)[place] for lang in self.languages], axis=1)

    def entropies(self, keys: np.ndarray, first: np.ndarray, languages: list[str] | None = None) -> np.ndarray:
        """Cross-entropy per symbol (nats) of each row under each language; nan without symbols."""
        languages = self.languages if languages is None else languages
        out = np.full((len(first) - 1, len(languages)), np.nan)
        filled = np.flatnonzero(np.diff(first))
        if len(filled):
            place, steps = _ladder(keys, ORDER)
            for k, lang in enumerate(languages):
                sums = np.add.reduceat(self._of_distinct(lang, steps)[place], first[filled], dtype=np.float64)
                out[filled, k] = -sums / np.diff(first)[filled]
        return out


def length_class(symbols: int) -> int:
    return min(16, max(0, int(math.log2(max(1, symbols)))))


def _merge_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count_grams(train: DataFrame) -> DataFrame:
    """(lang, gram, n) over all training texts."""

    def scan(batches):
        held: dict[str, list] = defaultdict(list)
        size = 0
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy()
            for row, end, data, offsets in ws.text_slices(batch.column(1), SLICE_BYTES):
                keys, first = _grams(data, offsets)
                of_key = np.repeat(codes[row:end], np.diff(first))
                for code in np.unique(codes[row:end]):
                    lang, own = names[code], np.sort(keys[of_key == code])
                    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else own[:0]
                    held[lang].append((own[starts.astype(int)], np.diff(np.append(starts, len(own))).astype(np.int64)))
                    size += len(starts)
                if size > 3_000_000:
                    for lang, parts in held.items():
                        held[lang] = [_merge_counts(*map(np.concatenate, zip(*parts, strict=True)))]
                    size = sum(len(p[0][0]) for p in held.values())
                    if size > 2_000_000:
                        yield from _gram_batches(held)
                        held.clear()
                        size = 0
        yield from _gram_batches(held)

    return train.mapInArrow(scan, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _gram_batches(held: dict):
    for lang, parts in held.items():
        keys, counts = _merge_counts(*map(np.concatenate, zip(*parts, strict=True)))
        for k in range(0, len(keys), 100_000):
            part = keys[k:k + 100_000].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part),
                                              pa.array(counts[k:k + 100_000])], names=["lang", "gram", "n"])


def _kneser_ney(counted: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Interpolated Kneser-Ney over all n-grams: (lang, level, key, value), and the symbols of all languages.

    Level 2 * order has log-probabilities of n-grams, 2 * order + 1 log weights of contexts.
    """
    counts = {ORDER: counted}
    for order in range(ORDER - 1, 0, -1):
        # Lower orders count in how many different contexts a gram occurs.
        counts[order] = stage(counts[order + 1].groupBy("lang", F.col("gram").bitwiseAND(F.lit(_below(order))).alias(
            "gram")).agg(F.count("*").alias("n")), "char-ngrams")
    symbols = np.array([r[0] for r in counts[1].select("gram").distinct().collect()], np.int64)  # at most 2 ** 16
    levels, lower = [], None
    for order in range(1, ORDER + 1):
        ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discounts = counts[order].groupBy("lang").agg(F.least(F.lit(0.95), F.greatest(F.lit(0.1), F.when(
            ones > 0, ones / (ones + 2 * twos)).otherwise(0.5))).alias("discount"))
        # A context has at most 2 ** 16 n-grams.
        same = Window.partitionBy("lang", "context")
        own = (counts[order].withColumn("context", F.shiftrightunsigned("gram", 16))
               .withColumn("total", F.sum("n").over(same)).withColumn("kinds", F.count("*").over(same))
               .join(F.broadcast(discounts), "lang")
               .withColumn("weight", F.least(F.col("discount") * F.col("kinds"), "total") / F.col("total"))
               .withColumn("suffix", F.col("gram").bitwiseAND(F.lit(_below(order - 1)))))
        own = (own.withColumn("below", F.lit(1.0 / (len(symbols) + 1))) if lower is None
               else own.join(lower, ["lang", "suffix"]))
        p = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total") + F.col("weight") * F.col("below")
        own = stage(own.select("lang", "context", "gram", "weight", p.alias("p")), "char-probabilities")
        lower = own.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below"))
        levels.append(own.select("lang", F.lit(2 * order).alias("level"), F.col("gram").alias("key"),
                                 F.log("p").cast("float").alias("value")))
        levels.append(own.groupBy("lang", "context").agg(F.first("weight").alias("weight")).select(
            "lang", F.lit(2 * order + 1).alias("level"), F.col("context").alias("key"),
            F.log("weight").cast("float").alias("value")))
    table = levels[0]
    for level in levels[1:]:
        table = table.unionByName(level)
    return table, symbols


def _write_pieces(table: DataFrame) -> dict:
    """Write sorted arrays to the shared folder, PIECE_ENTRIES of them at a time; returns LanguageModel.pieces."""
    folder = scratch_path(table.sparkSession, "language-model")

    def write(batches):
        system, name = fs.FileSystem.from_uri(folder)
        system.create_dir(name, recursive=True)
        own = uuid.uuid4().hex  # a task that runs again writes another file
        held: list[tuple] = []
        of, size, offset, file = None, 0, 0, None

        def flush():
            nonlocal file, offset, size
            if file is None:
                file = system.open_output_stream(f"{name}/{own}")
            keys, values = (np.concatenate(x) for x in zip(*held, strict=True))
            written = keys.tobytes() + values.astype(np.float32).tobytes()
            written += bytes(-len(written) % 8)
            file.write(written)
            piece = [pa.array([x]) for x in (of[0], of[1], int(keys[0]), len(keys), f"{folder}/{own}", offset)]
            offset += len(written)
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays(piece, names=["lang", "level", "first", "size", "path", "offset"])

        for batch in batches:
            langs, levels = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
            codes = langs.indices.to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (levels[1:] != levels[:-1])]))
            keys, values = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                if start == end:
                    continue
                now = langs.dictionary[codes[start]].as_py(), int(levels[start])
                if held and (now != of or size >= PIECE_ENTRIES):
                    yield flush()
                of = now
                held.append((keys[start:end].copy(), values[start:end].copy()))
                size += end - start
        if held:
            yield flush()
        if file is not None:
            file.close()

    placed = table.repartitionByRange("lang", "level", "key").sortWithinPartitions("lang", "level", "key")
    pieces: dict[tuple, list] = defaultdict(list)
    for r in placed.mapInArrow(write, "lang string, level long, first long, size long, path string, offset long").collect():
        pieces[r["lang"], r["level"] // 2, bool(r["level"] % 2)].append(
            Piece(r["first"], r["size"], r["path"], r["offset"]))
    return {k: sorted(v, key=lambda p: p.first) for k, v in pieces.items()}


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def train_language_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from all rows with a text and a language.

    N-grams of all texts and all languages are counted and kept.  The model holds
    where its arrays lie in the shared folder, a few numbers for each million of
    entries, so it can be broadcast whatever the corpus.  Without any labelled text
    it has no languages, and everything is undetermined.
    """
    train = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
                        ).filter("lang is not null and text is not null")
    # Copies of a text are in the same half: none is scored by a model that has counted it.
    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("string")
    halves = stage(_count_grams(train.select(F.concat(half, "lang").alias("lang"), "text")), "char-ngrams")
    whole = halves.groupBy(F.concat(F.lit(WHOLE), F.expr("substring(lang, 2)")).alias("lang"), "gram").agg(
        F.sum("n").alias("n"))
    table, symbols = _kneser_ney(stage(whole.unionByName(halves), "char-ngrams"))
    pieces = _write_pieces(table)
    alphabet = [HashArray(symbols.view(np.uint64), np.empty((len(symbols), 0)))]

    def model(names: list[str], skip: int) -> LanguageModel:
        return LanguageModel([x[skip:] for x in names], alphabet,
                             {(x[0][skip:], *x[1:]): v for x, v in pieces.items() if x[0] in set(names)})

    names = sorted({name for name, _, _ in pieces})
    known = model([x for x in names if x[0] == WHOLE], 1)
    if known.languages:
        known.limits = _calibrate(train.withColumn("half", half), model([x for x in names if x[0] in HALVES], 0),
                                  known.languages)
    return known


def _calibrate(train: DataFrame, halves: LanguageModel, languages: list[str]) -> dict:
    """Highest cross-entropy accepted, by language and length class, from all training texts.

    Each text counts once, however many copies it has.
    """
    shared = train.sparkSession.sparkContext.broadcast(halves)

    def scan(batches):
        known = shared.value
        learned = set(known.languages)
        for batch in batches:
            langs, texts = batch.column(0).dictionary_encode(), batch.num_rows
            names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy()
            sizes, found = np.zeros(texts, np.int32), np.full(texts, np.nan)
            for row, end, data, offsets in ws.text_slices(batch.column(1), SLICE_BYTES):
                keys, first = _grams(data, offsets)
                lengths, own = np.diff(first), codes[row:end]
                sizes[row:end] = [length_class(x) for x in lengths]
                of_key = np.repeat(own, lengths)
                for code in np.unique(own):
                    if names[code] in learned:
                        at = np.flatnonzero(own == code)
                        found[row + at] = known.entropies(
                            keys[of_key == code], np.concatenate([[0], np.cumsum(lengths[at])]), [names[code]])[:, 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(found, from_pandas=True), batch.column(2)],
                names=["lang", "size", "entropy", "text"])

    other = F.when(F.col("half") == HALVES[0], HALVES[1]).otherwise(HALVES[0])
    scored = (train.select(F.concat(other, "lang").alias("lang"), "text", F.xxhash64("text").alias("digest"))
              .mapInArrow(scan, "lang string, size int, entropy double, text long").filter("entropy is not null")
              .groupBy(F.expr("substring(lang, 2)").alias("lang"), "text")
              .agg(F.first("size").alias("size"), F.first("entropy").alias("entropy")))
    found: dict[str, list] = defaultdict(list)
    for r in scored.groupBy("lang", "size").agg(
            F.count("*").alias("n"), F.avg("entropy").alias("mean"), F.stddev_pop("entropy").alias("deviation"),
            F.percentile_approx("entropy", KEPT_SHARE).alias("high")).collect():
        found[r["lang"]].append((r["size"], r["n"], r["mean"], r["deviation"], r["high"]))
    every = [x for own in found.values() for x in own]
    of_all = {size: _spread(every, size) for size in range(17)}
    limits = {}
    for lang in languages:
        for size in range(17):
            (n, mean, above, high), (n_all, mean_all, above_all, _) = _spread(found[lang], size), of_all[size]
            if n < CLASS_TEXTS:  # too few texts: as wide as the languages are together
                mean, above = mean if n else mean_all, max(above, above_all)
            # A text that a model of the symbols alone explains better is in no language, unless its own ones are so.
            most = max(-halves.unknown, high)
            limits[lang, size] = min(mean + above, most) if n_all else most
    return limits


def _spread(classes: list[tuple], size: int) -> tuple[int, float, float, float]:
    """(texts, their mean, how far above it a text may be, their high quantile) at a length class and the nearest ones.

    Classes are added on both sides until they have CLASS_TEXTS texts.  Deviations of
    longer texts are widened by the root of the ratio of lengths.
    """
    near: list[tuple] = []
    for reach in range(17):
        near = [x for x in classes if abs(x[0] - size) <= reach]
        if sum(x[1] for x in near) >= CLASS_TEXTS:
            break
    texts = sum(x[1] for x in near)
    if not texts:
        return 0, 0.0, 0.0, 0.0
    mean = sum(x[1] * x[2] for x in near) / texts
    wider = [2 ** (max(0, x[0] - size) / 2) for x in near]
    variance = sum(x[1] * ((x[3] * w) ** 2 + (x[2] - mean) ** 2) for x, w in zip(near, wider, strict=True)) / texts
    highest = max((x[4] - x[2]) * w + x[2] - mean for x, w in zip(near, wider, strict=True))
    return (texts, mean, max(REJECT_DEVIATIONS * math.sqrt(variance), highest, 0.01), max(x[4] for x in near))


def predict_language(docs: DataFrame, model: LanguageModel, text_col: str = "text",
                     columns: list | None = None) -> DataFrame:
    """Language of each whole text; ``columns`` (default: all) come first, unchanged.

    Adds lang_pred (a learned language; ``und`` if the text is null, empty, without
    a letter, or nothing was learned), score (0 to 1, the share of the language
    against the others), entropy (nats per symbol, null if ``und``) and accepted
    (false if ``und`` or if the entropy is above the language's calibrated limit).
    Input columns with one of these names are left out.  Ties go to the alphabetically first language.  Of texts of any length all is
    read; repeated rows stay.
    """
    columns = columns or [F.col(c) for c in docs.columns if c.lower() not in ("lang_pred", "score", "entropy", "accepted")]
    packed = docs.select(F.struct(F.col(text_col).cast("string").alias("text")).alias("read"),
                         F.struct(*columns).alias("row"))
    names = [f.name for f in packed.schema["row"].dataType]
    if text_col in names and dict(docs.dtypes)[text_col] == "string":
        packed = packed.select(F.col("row").alias("read"))  # the row's own text is read: it goes over once
    place = packed.schema["read"].dataType.names.index(text_col if len(packed.columns) == 1 else "text")
    # The model's arrays stay in the shared folder.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        known = shared.value
        for batch in batches:
            langs, scores, entropies, accepted = [], [], [], []
            for row, end, data, offsets in ws.text_slices(batch.column(0).field(place), SLICE_BYTES):
                keys, first = _grams(data, offsets)
                found = known.entropies(keys, first)
                for k in range(end - row):
                    size = int(first[k + 1] - first[k])
                    if not known.languages or not _has_letter(keys[first[k]:first[k + 1]]):
                        langs.append(UNDETERMINED)
                        scores.append(0.0)
                        entropies.append(None)
                        accepted.append(False)
                        continue
                    best = int(np.argmin(found[k]))
                    langs.append(known.languages[best])
                    scores.append(float(1 / np.exp((found[k, best] - found[k]) * math.sqrt(size)).sum()))
                    entropies.append(float(found[k, best]))
                    accepted.append(bool(found[k, best] <= known.limits.get(
                        (known.languages[best], length_class(size)), math.inf)))
            row = batch.column(batch.num_columns - 1)
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(entropies, pa.float64()), pa.array(accepted, pa.bool_())],
                names=["row", "lang_pred", "score", "entropy", "accepted"])

    schema = T.StructType([T.StructField("row", packed.schema[-1].dataType), *T.StructType.fromDDL(
        "lang_pred string, score double, entropy double, accepted boolean")])
    scored = packed.mapInArrow(scan, schema)
    return scored.select("row.*", "lang_pred", "score", "entropy", "accepted")
