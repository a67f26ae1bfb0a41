"""Texts as byte arrays: whole columns of a batch hashed at once.

A prefix hash ``P[i] = sum(r[c_j] * B^j, j < i) mod 2^64`` gives the hash of any range by two look-ups, as ``B`` is odd
and so has an inverse. ``r`` is a fixed random word per byte value. Equal ranges have equal hashes; where a wrong match
would change a result, callers compare the bytes as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_WORDS = np.random.Generator(np.random.PCG64(20240611)).integers(1, 1 << 64, 256, dtype=np.uint64)
PIECE_BYTES = 1 << 19

#: Fixed: what separates words, and A-Z to a-z.
BREAKS = np.zeros(256, bool)
BREAKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
WORD = r"[^\x20\x09-\x0D]+"

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def fingerprint(text: Column) -> list[Column]:
    """128 bits of a text as two longs, ``k1`` and ``k2``; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def powers(n: int, way: str) -> np.ndarray:
    """``B^0 … B^(n-1)`` (``up``) or the powers of its inverse (``down``), kept between calls."""
    if len(_powers[way]) < n:
        factors = np.full(max(n, PIECE_BYTES), BASE if way == "up" else INVERSE, np.uint64)
        factors[0] = 1
        _powers[way] = np.cumprod(factors, dtype=np.uint64)
    return _powers[way][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_WORDS[data] * powers(len(data), "up"), out=out[1:])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit words over the word, one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its ``n + 1`` offsets into them; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows, so that a piece holds about ``limit`` bytes of ``text`` or one longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = strings(batch.column(text))[1]
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end
    pa.default_memory_pool().release_unused()  # workers live on for the next task


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the first word of each text (``n + 1`` entries)."""
    inner = np.zeros(len(data) + 1, bool)
    inner[:-1] = ~BREAKS[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inner[:-1]
    cut = np.zeros(len(data) + 1, bool)  # a text's end also ends its last word
    cut[offsets] = True
    starts = np.flatnonzero(inner & (~before | cut))
    ends = np.flatnonzero(before & (~inner | cut))
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed word shingles of each text, sorted, and their ``n + 1`` offsets.

    Words are lower-cased in A-Z. A text of fewer than ``size`` words has its whole sequence as its one shingle, a text
    without words has none.
    """
    data, offsets = strings(column)
    starts, ends, first = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    sums = prefix_hashes(LOWER[data])
    words = mix((sums[ends] - sums[starts]) * powers(len(data) + 1, "down")[starts] + (ends - starts).astype(np.uint64))
    up = [int(x) for x in powers(size + 1, "up")]
    count = np.diff(first)
    each: list[np.ndarray] = []
    rolled = words[: max(0, len(words) - size + 1)].copy()
    for i in range(1, size):
        rolled += words[i : i + len(rolled)] * np.uint64(up[i])
    rolled = mix(rolled + np.uint64(size))
    for i in range(len(count)):
        a, n = int(first[i]), int(count[i])
        if n >= size:
            found = np.sort(rolled[a : a + n - size + 1])
            each.append(found[np.concatenate(([True], found[1:] != found[:-1]))])
        elif n:
            whole = sum(int(w) * up[j] for j, w in enumerate(words[a : a + n])) + n
            each.append(mix(np.array([whole & ((1 << 64) - 1)], np.uint64)))
        else:
            each.append(words[:0])
    return np.concatenate(each), np.concatenate(([0], np.cumsum([len(x) for x in each]))).astype(np.int64)
