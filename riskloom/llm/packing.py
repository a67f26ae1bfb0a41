"""Best-fit packing of tokenized documents into sequences, in bulk-synchronous rounds.

Documents are cut in pieces of at most a sequence and range-sorted by length: pieces of one length are a class, and a
piece is known by its rank in its class. Gaps are classes, too: sequences with the same room, in order of number. A round
takes the longest class not yet placed, sweeps the gaps for the successor of its length (the smallest that holds it),
gives the i-th piece the i-th gap, so no two pieces want the same one, moves the filled gaps to their new class, and
sweeps on with the pieces left over; these open sequences when no gap holds them. Because a round moves ranges of ranks
and never single pieces, its state is bounded by the sequence length and not by the number of documents; the ranks
themselves are counted and joined on the executors. The result is that of best-fit over all pieces by falling length.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.texts import pieces
from riskloom.session import BROADCAST_ROWS, Scratch

CAPACITY = 4096
END_ID = 1
#: What the cache of a worker may hold during a task, and keep for the next one.
CACHED_BYTES, WAITING_BYTES = 160 << 20, 120 << 20
#: Bytes of a cached chunk beside its own and those of its ids, which are at most four for each of its own.
ENTRY_BYTES = 140
#: Longer chunks are rarely seen again and leave the cache with their batch.
LONG_CHUNK = 256
WORDS_A_CALL = 1_000
BATCH_BYTES = 2 << 20
#: Punctuation that is a unit of the tokenizer on its own when it follows letters (no apostrophe: it may begin one).
TAIL = b".,;:!?|*#%&-_()[]{}/+=<>"
#: A digit is a unit on its own, and its id comes from nothing else.
BETWEEN = b"0"
#: Fixed: how the special tokens of the file begin.
SPECIAL = "<|"
#: A class is ranked in parts: this many, or more once a part would hold over ``PART_PIECES``.
SALTS = 16
PART_PIECES = 1_000_000

#: Fixed: the first bytes of the marks that compose with ASCII letters (U+0300 to U+037F).
MARKS = (b"\xcc", b"\xcd")

_tokenizers: dict[str, tuple] = {}


def _tokenizer(path: str):
    """The tokenizer of this worker, its cache of words, and (in a list of one) about how many bytes that holds."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = (Tokenizer.from_file(path), {b"": b""}, [0])
    return _tokenizers[path]


def _empty(path: str) -> None:
    _, cache, held = _tokenizer(path)
    cache.clear()
    cache[b""], held[0] = b"", 0


def _learn(tokenizer, cache: dict[bytes, bytes], chunks: set[bytes]) -> None:
    """Put the ids of ``chunks`` into the cache.

    In ASCII, letters are one unit of the tokenizer and punctuation after them another, so both are encoded for
    themselves: the units of letters many to a call, told apart by their number. Beyond ASCII a letter may become a
    letter and a mark, and the mark one unit with the punctuation, so all other chunks are encoded as they are.
    """
    ended, words, rest = [], set(), set()
    for chunk in chunks:
        letters = chunk.rstrip(TAIL)
        if letters.isalpha() and chunk.isascii():
            words.add(letters)
            if len(letters) < len(chunk):
                tail = chunk[len(letters) :]
                ended.append((chunk, letters, tail))
                rest.add(tail)
        else:
            rest.add(chunk)
    words = list(words.difference(cache))
    for i in range(0, len(words), WORDS_A_CALL):
        some = words[i : i + WORDS_A_CALL]
        encoded = tokenizer.encode(b" ".join(some).decode(), add_special_tokens=False)
        unit, ids = np.array(encoded.word_ids, np.int64), np.array(encoded.ids, "<u4").tobytes()
        if len(unit) and unit[-1] == len(some) - 1:
            cuts = (4 * np.searchsorted(unit, np.arange(len(some) + 1))).tolist()
            cache.update(zip(some, [ids[a:b] for a, b in zip(cuts, cuts[1:])]))
        else:
            cache.update(_one_by_one(tokenizer, some))
    rest = rest.difference(cache)
    plain = [chunk for chunk in rest if BETWEEN not in chunk]
    cache.update(_one_by_one(tokenizer, rest.difference(plain)))
    for i in range(0, len(plain), WORDS_A_CALL):
        cache.update(_many(tokenizer, plain[i : i + WORDS_A_CALL]))
    cache.update([(chunk, cache[letters] + cache[tail]) for chunk, letters, tail in ended])


def _many(tokenizer, chunks: list[bytes]) -> list[tuple[bytes, bytes]]:
    """The ids of whole chunks, none with ``BETWEEN``, in one call with that character between them."""
    between = tokenizer.encode(BETWEEN.decode(), add_special_tokens=False).ids
    if len(between) != 1:
        return _one_by_one(tokenizer, chunks)
    joined = (b" " + BETWEEN + b" ").join(chunks).decode()
    ids = np.array(tokenizer.encode(joined, add_special_tokens=False).ids, "<u4")
    at = np.flatnonzero(ids == between[0])
    if len(at) != len(chunks) - 1:
        return _one_by_one(tokenizer, chunks)
    starts, ends = (4 * np.append(0, at + 1)).tolist(), (4 * np.append(at, len(ids))).tolist()
    ids = ids.tobytes()
    return [(c, ids[a:b]) for c, a, b in zip(chunks, starts, ends)]


def _one_by_one(tokenizer, chunks) -> list[tuple[bytes, bytes]]:
    encoded = tokenizer.encode_batch([c.decode() for c in chunks], add_special_tokens=False)
    return [(c, _ids(e)) for c, e in zip(chunks, encoded)]


def _ids(encoded) -> bytes:
    return np.array(encoded.ids, "<u4").tobytes()


def _chunks(text: str) -> list[bytes]:
    raw = text.encode().replace(b"\n", b" ")
    if raw.isascii() or not any(mark in raw for mark in MARKS):
        return raw.lower().split(b" ")  # A-Z only
    return [c.lower() if c.isascii() else c for c in raw.split(b" ")]


def token_bytes(texts: list[str | None], path: str) -> list[bytes]:
    """The ids of each text as little-endian 32-bit numbers.

    The tokenizer drops white space and never joins ids across it, so each run between spaces or line feeds is encoded
    once and looked up after that. A-Z are lower-cased before; in texts with marks that compose with them only in runs of
    ASCII, as the tokenizer composes first and lower-cases then. Texts that may hold a special token are encoded whole.
    """
    tokenizer, cache, held = _tokenizer(path)
    cut = [None if t and SPECIAL in t else _chunks(t or "") for t in texts]
    distinct = set().union(*(c for c in cut if c))
    new = distinct.difference(cache)
    size = 5 * sum(map(len, new)) + ENTRY_BYTES * len(new)
    if held[0] + size > CACHED_BYTES:
        _empty(path)
        new = distinct - {b""}
        size = 5 * sum(map(len, new)) + ENTRY_BYTES * len(new)
    if new:
        _learn(tokenizer, cache, new)
    found = [
        b"".join(map(cache.__getitem__, chunks))
        if chunks is not None
        else _ids(tokenizer.encode(text, add_special_tokens=False))
        for text, chunks in zip(texts, cut)
    ]
    long = [c for c in new if len(c) > LONG_CHUNK]
    for chunk in long:
        del cache[chunk]
    held[0] += size - 5 * sum(map(len, long)) - ENTRY_BYTES * len(long)
    return found


def _cut(path: str, capacity: int):
    end = np.array([END_ID], "<u4").tobytes()
    most = 4 * capacity

    def run(batches):
        for batch in pieces(batches, "text", BATCH_BYTES):
            ids, columns = batch.column("doc_id").to_pylist(), ([], [], [], [], [])
            for doc_id, raw in zip(ids, token_bytes(batch.column("text").to_pylist(), path)):
                raw += end
                for k, start in enumerate(range(0, len(raw), most)):
                    part = raw[start : start + most]
                    for column, value in zip(columns, (doc_id, k, start // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])
        if _tokenizer(path)[2][0] > WAITING_BYTES:
            _empty(path)

    return run


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Ranges ``(length, first rank, pieces, first sequence, offset)`` that place ``counts[length]`` pieces.

    Pieces of a range go one to a sequence, in order; ``offset`` is the room already taken there.
    """
    placed = []
    gaps: list[int] = []
    rooms: dict[int, list[tuple[int, int]]] = {}

    def add(gap: int, first: int, n: int) -> None:
        if gap not in rooms:
            rooms[gap] = []
            insort(gaps, gap)
        ranges = rooms[gap]
        if ranges and ranges[-1][0] + ranges[-1][1] == first:
            ranges[-1] = (ranges[-1][0], ranges[-1][1] + n)
        else:
            ranges.append((first, n))

    def fill(length: int, rank: int, left: int, gap: int, first: int, n: int) -> int:
        """Place pieces in ``n`` sequences of one gap, each filled before the next as in best-fit; return the rest."""
        fit = gap // length
        full = min(n, left // fit)
        some = left - full * fit if full < n else 0
        for at, many, each in ((first, full, fit), (first + full, int(some > 0), some)):
            if many:
                for layer in range(each):
                    placed.append((length, rank, many, at, capacity - gap + layer * length))
                    rank += many
                if gap > each * length:
                    add(gap - each * length, at, many)
        used = full + (some > 0)
        if used < n:
            add(gap, first + used, n - used)
        return left - full * fit - some

    sequences = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            rank, at = counts[length] - left, bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, n = rooms[gap].pop()
                if not rooms[gap]:
                    del rooms[gap]
                    gaps.pop(at)
            else:
                gap, n = capacity, -(-left // (capacity // length))
                first, sequences = sequences, sequences + n
            left = fill(length, rank, left, gap, first, n)
    return placed


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, part_pieces: int = PART_PIECES) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` for every piece of ``docs(doc_id, text, …)``.

    A document is the ids that the tokenizer file at ``path`` gives for its text, then id 1; more than ``capacity`` ids
    are cut, and only then. ``offset`` is the place in its sequence.

    Equal lengths are ranked in parts of about ``part_pieces``, which does not change the number of sequences.

    - null and empty texts: one piece of the end id alone;
    - repeated rows and repeated or null ids: each row is packed for itself;
    - very long texts: tokenized whole, one piece after the other;
    - no rows: no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with Scratch(spark, "packing") as scratch:
        schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
        cut = docs.mapInArrow(_cut(path, capacity), schema)
        # a class may hold a third of all pieces, so its ranks are counted in salted parts
        drawn = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())
        cut = scratch.table(cut.withColumn("drawn", drawn), "pieces")
        # a row per length, then a row per length and part
        sizes = [(r[0], max(SALTS, -(-r[1] // part_pieces))) for r in cut.groupBy("length").count().collect()]
        salts = F.broadcast(spark.createDataFrame(sizes, "length long, salts long"))
        cut = cut.join(salts, "length").withColumn("salt", F.pmod("drawn", "salts").cast("int")).drop("drawn", "salts")
        parts = [(r[0], r[1], r[2]) for r in cut.groupBy("length", "salt").count().collect()]
        offsets, counts = [], {}
        for length, part, n in sorted(parts):
            offsets.append((length, part, counts.get(length, 0)))
            counts[length] = counts.get(length, 0) + n
        if not counts:
            return scratch.result(
                cut.drop("salt").select("*", F.lit(0).cast("long").alias("sequence_id"), F.col("start").alias("offset"))
            )
        ranges = [(length, rank, rank + n, first - rank, offset) for length, rank, n, first, offset in
                  best_fit(counts, capacity)]
        offsets = F.broadcast(spark.createDataFrame(offsets, "length long, salt int, before long"))
        small = len(ranges) <= BROADCAST_ROWS
        ranges = spark.createDataFrame(ranges, "length long, low long, high long, shift long, offset long")
        ranges = F.broadcast(ranges) if small else ranges
        inner = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
        ranks = cut.withColumn("within", F.row_number().over(inner) - 1).join(offsets, ["length", "salt"])
        ranks = ranks.withColumn("rank", F.col("before") + F.col("within")).drop("before", "within", "salt")
        placed = ranks.join(ranges, "length").where("rank >= low and rank < high")
        return scratch.result(
            placed.select(
                "doc_id", "piece", "start", "length", "ids_crc32",
                (F.col("rank") + F.col("shift")).alias("sequence_id"), "offset",
            )
        )
