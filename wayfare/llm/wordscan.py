"""Words, word hashes and word n-grams of Arrow text columns, in numpy.

Everything works on the UTF-8 buffer of a whole batch: no Python object is
made for a word.  Hashes are 64 bit and the same on every executor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed odd multipliers of the 64-bit mixing steps.
_MIX_A = np.uint64(0x9E3779B97F4A7C15)
_MIX_B = np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(29)
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)

LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[65:91] += 32


def word_bytes(excluded: list[tuple[int, int]]) -> np.ndarray:
    """Byte table: which bytes belong to words once A-Z are lower-cased, given the excluded ranges."""
    table = np.ones(256, dtype=bool)
    for low, high in excluded:
        table[low:high + 1] = False
    return table[LOWER_AZ]


# [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ as byte tables (UTF-8
# bytes of non-ASCII characters are all above 0x7F, so bytes decide).
SPACE_SEPARATED = word_bytes([(0x20, 0x20), (0x09, 0x0D)])
ALPHANUMERIC = word_bytes([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def mix(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    h = (h ^ x) * _MIX_A
    h ^= h >> _SHIFT
    h *= _MIX_B
    h ^= h >> _SHIFT
    return h


def text_slices(column: pa.Array, max_bytes: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of rows of about ``max_bytes``.

    Yields (first row, end row, UTF-8 bytes, row offsets into them); null texts
    count as empty.  A single longer text makes a run of its own.  The column is
    not copied; only a run with nulls is.
    """
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    row = 0
    while row < len(column):
        end = int(np.searchsorted(before, before[row] + max_bytes, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        run = column.slice(row, end - row)
        run = (pc.fill_null(run, "") if run.null_count else run).cast(pa.large_string())
        _, off_buf, data_buf = run.buffers()
        offsets = np.frombuffer(off_buf, dtype=np.int64)[run.offset:run.offset + len(run) + 1]
        data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.empty(0, np.uint8)
        yield row, end, data[offsets[0]:offsets[-1]], offsets - offsets[0]
        row = end


def find_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Start and end byte of each word, and each row's first word (rows + 1 entries)."""
    inside = is_word[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before = np.empty(len(data) + 1, dtype=bool)
    before[0] = False
    before[1:] = inside
    now = np.empty(len(data) + 1, dtype=bool)
    now[:-1] = inside
    now[-1] = False
    starts = np.flatnonzero(now & (~before | first))
    ends = np.flatnonzero(before & (~now | first))
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, A-Z lower-cased, eight bytes at a step."""
    padded = np.empty(len(data) + 8, dtype=np.uint8)
    np.take(LOWER_AZ, data, out=padded[:len(data)])
    padded[len(data):] = 0
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    length = (ends - starts).astype(np.int64)
    hashes = mix(length.astype(np.uint64), eight[starts] & _KEEP[np.minimum(length, 8)])
    left = np.flatnonzero(length > 8)
    at = 8
    while len(left):
        rest = length[left] - at
        hashes[left] = mix(hashes[left], eight[starts[left] + at] & _KEEP[np.minimum(rest, 8)])
        left = left[rest > 8]
        at += 8
    return hashes


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (all words as one if fewer)."""
    if not len(words):
        return words
    n = min(n, len(words))
    grams = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        grams = mix(grams, words[k:len(words) - n + 1 + k])
    return grams
