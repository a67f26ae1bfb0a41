"""Removal of long byte strings that occur more than once, by a hash-compared suffix sort.

All suffixes of a corpus are too many to move, and nearly all are unique within their first bytes. So:

1. Distinct texts are written once, in buckets by fingerprint. Every window of ``length`` bytes gets an anchor: the
   place of its least hashed ``GRAM``-byte string. Equal windows have equal anchor strings at equal places, so a window
   whose anchor string occurs once in the corpus is unique.
2. Neighbouring windows with the same anchor form a segment. Anchor strings that occur more than once are counted with
   map-side sums, and their segments digested. A segment that occurs twice as a whole is settled by that.
3. What is left are distinct segments sharing an anchor string, at the ends of shared passages and around edits. Their
   suffixes are sorted by a mergesort that compares two suffixes in log(length) steps: prefix polynomial hashes and a
   binary search give their common extension, the next byte decides. Neighbours in that order that share ``length`` bytes
   are compared byte by byte, then marked. Anchor strings with over ``GROUP_SEGMENTS`` distinct segments are split
   further first, by a hash of every window, so that no task holds one whole.
4. Marked windows go back to their texts, whose uncovered bytes are kept. A text that occurs twice is covered whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.texts import fingerprint, mix, pieces, powers, prefix_hashes, strings
from riskloom.session import Scratch

LENGTH = 200
GRAM = 32
GROUP_SEGMENTS = 20_000
#: Suffixes gathered and sorted together, if no group is larger.
SORT_BATCH = 1 << 17

_PLACE_BITS = 28
_TEXT = "k1 long, k2 long, text string, copies long, anchor array<long>, place array<int>, low array<int>, high array<int>"
_SEGMENT = "k1 long, k2 long, anchor long, low int, windows int, place int, d1 long, d2 long"
_MARKS = "anchor long, place int, d1 long, d2 long, starts array<int>, ends array<int>"


def _lists(values: list[np.ndarray], offsets: np.ndarray) -> list[pa.Array]:
    offsets = pa.array(offsets.astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in values]


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Per segment: its text, anchor hash, and anchor place, first and last window start within the text."""
    n = len(data)
    nothing = (np.zeros(0, np.int64), np.zeros(0, np.uint64)) + (np.zeros(0, np.int32),) * 3
    if n < length:
        return nothing
    sums = prefix_hashes(data)
    grams = mix((sums[gram:] - sums[:-gram]) * powers(n + 1, "down")[: n - gram + 1])
    place = np.uint64((1 << _PLACE_BITS) - 1)
    least = (grams & ~place) | (np.arange(len(grams), dtype=np.uint64) & place)
    width, want = 1, length - gram + 1
    while 2 * width <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < want:
        least = np.minimum(least[: len(least) - (want - width)], least[want - width :])
    # window starts whose window ends in the same text
    sizes = np.diff(offsets)
    valid = np.zeros(n + 1, np.int8)
    long_ones = sizes >= length
    np.add.at(valid, offsets[:-1][long_ones], 1)
    np.add.at(valid, offsets[1:][long_ones] - length + 1, -1)
    valid = np.cumsum(valid[: len(least)], dtype=np.int8).astype(bool)
    starts = np.arange(len(least))
    at = starts + ((least - starts.astype(np.uint64)) & place).astype(np.int64)
    change = np.ones(len(least), bool)
    change[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1])
    text_start = offsets[:-1][long_ones]
    change[text_start[text_start < len(change)]] = True
    low = np.flatnonzero(change)
    high = np.append(low[1:], len(least)) - 1
    low, high = low[valid[low]], high[valid[low]]
    at = at[low]
    text = np.searchsorted(offsets, low, "right") - 1
    base = offsets[text]
    return text, grams[at], *((x - base).astype(np.int32) for x in (at, low, high))


def _anchored(length: int, gram: int):
    def run(batches):
        for batch in pieces(batches, "text"):
            data, offsets = strings(batch.column("text"))
            text, h, at, low, high = anchors(data, offsets, length, gram)
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
            columns = [batch.column(c) for c in ("k1", "k2", "text", "copies")]
            columns += _lists([h.view(np.int64), at, low, high], ends)
            yield pa.RecordBatch.from_arrays(
                columns, ["k1", "k2", "text", "copies", "anchor", "place", "low", "high"]
            )

    return run


def _ragged(column) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate(
        ([0], np.cumsum(np.diff(column.offsets.to_numpy())))
    )


def _digested(length: int):
    """A row per wanted segment of a text, with a 128-bit digest of its bytes."""

    def run(batches):
        for batch in pieces(batches, "text"):
            data, offsets = strings(batch.column("text"))
            buffer = data.tobytes()
            wanted, cuts = _ragged(batch.column("wanted"))
            h, at, low, high = (_ragged(batch.column(c)) for c in ("anchor", "place", "low", "high"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(cuts))
            pick = h[1][row] + wanted
            base = offsets[row]
            a, b, p = low[0][pick], high[0][pick], at[0][pick]
            digests = b"".join(
                hashlib.blake2b(buffer[x:y], digest_size=16).digest()
                for x, y in zip((base + a).tolist(), (base + b + length).tolist())
            )
            digests = np.frombuffer(digests, np.int64).reshape(-1, 2)
            keys = [batch.column(c).to_numpy()[row] for c in ("k1", "k2")]
            values = [*keys, h[0][pick], a, b - a + 1, p - a, digests[:, 0].copy(), digests[:, 1].copy()]
            names = ["k1", "k2", "anchor", "low", "windows", "place", "d1", "d2"]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in values], names)

    return run


def _cut_out(length: int):
    """The bytes of the wanted segments of a text."""

    def run(batches):
        for batch in pieces(batches, "text"):
            data, offsets = strings(batch.column("text"))
            buffer = data.tobytes()
            rows = batch.column("segments").to_pylist()
            out = {c: [] for c in ("anchor", "place", "d1", "d2", "bytes", "hot")}
            for start, segments in zip(offsets.tolist(), rows):
                for s in segments:
                    for c in ("anchor", "place", "d1", "d2", "hot"):
                        out[c].append(s[c])
                    first = start + s["low"]
                    out["bytes"].append(buffer[first : first + s["windows"] + length - 1])
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))

    return run


class Suffixes:
    """Suffixes of a buffer, compared up to ``length`` bytes by prefix hashes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        self.sums, self.down = prefix_hashes(data), powers(len(data) + 1, "down")

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair of starts, by binary search over hash comparisons."""
        si, sj, di, dj = self.sums[i], self.sums[j], self.down[i], self.down[j]
        low = np.zeros(len(i), np.int64)
        step = 1 << (self.length.bit_length() - 1)
        while step:
            mid = low + step
            inside = mid <= self.length
            mid = np.where(inside, mid, low)
            same = (self.sums[i + mid] - si) * di == (self.sums[j + mid] - sj) * dj
            low = np.where(same, mid, low)
            step >>= 1
        return low

    def before(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether suffix ``i`` sorts before ``j``, and whether they share all ``length`` bytes."""
        common = self.common(i, j)
        equal = common >= self.length
        common = np.where(equal, 0, common)
        return ~equal & (self.data[i + common] < self.data[j + common]), equal

    def same_bytes(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        span = np.arange(self.length)
        out = np.zeros(len(i), bool)
        for a in range(0, len(i), 1 << 12):
            rows = slice(a, a + (1 << 12))
            out[rows] = (self.data[i[rows, None] + span] == self.data[j[rows, None] + span]).all(axis=1)
        return out


def merge_sorted(suffixes: Suffixes, starts: np.ndarray, block: np.ndarray) -> np.ndarray:
    """``starts`` ordered by suffix within each run of equal ``block`` numbers; equal suffixes keep their order.

    A bottom-up mergesort over all blocks at once: in each round a suffix finds by binary search how many of the
    sibling run come before it, and moves there.
    """
    n = len(starts)
    first = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1)) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(first, n))
    block_start, block_size = np.repeat(first, size), np.repeat(size, size)
    local = np.arange(n) - block_start
    width, starts = 1, starts.copy()
    while n and width < size.max():
        move = np.flatnonzero(block_size > width)  # blocks that are one run already stay
        at = local[move]
        run = at // width
        left = run % 2 == 0
        sibling = np.where(left, run + 1, run - 1) * width
        low = np.minimum(sibling, block_size[move])
        high = np.minimum(sibling + width, block_size[move])
        base, begin, own = block_start[move], low.copy(), starts[move]
        open_ones = np.flatnonzero(low < high)
        while len(open_ones):
            mid = (low[open_ones] + high[open_ones]) // 2
            other = starts[base[open_ones] + mid]
            less, equal = suffixes.before(other, own[open_ones])
            goes_before = less | (equal & ~left[open_ones])
            low[open_ones] = np.where(goes_before, mid + 1, low[open_ones])
            high[open_ones] = np.where(goes_before, high[open_ones], mid)
            open_ones = open_ones[low[open_ones] < high[open_ones]]
        pair = (run // 2) * 2 * width
        target = base + pair + (at - run * width) + (low - begin)
        moved = starts.copy()
        moved[target] = own
        starts, width = moved, 2 * width
    return starts


def repeated_starts(suffixes: Suffixes, starts: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The starts whose suffix shares ``length`` verified bytes with another one of its block.

    A suffix whose ``length``-byte prefix hash is alone in its block has no such neighbour and is left out of the sort.
    Of more than two with one hash, two are sorted; the others are compared with the first of them byte by byte.
    """
    ends = starts + suffixes.length
    whole = (suffixes.sums[ends] - suffixes.sums[starts]) * suffixes.down[starts]
    order = np.lexsort((whole, block))
    starts, block, whole = starts[order], block[order], whole[order]
    new = np.ones(len(starts) + 1, bool)
    new[1:-1] = (block[1:] != block[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(new[:-1])
    size = np.diff(np.append(first, len(starts)))
    rank = np.arange(len(starts)) - np.repeat(first, size)
    leader = np.repeat(starts[first], size)
    shared = np.repeat(size, size) > 1
    two, more = shared & (rank < 2), shared & (rank >= 2)
    sorted_ones = merge_sorted(suffixes, starts[two], block[two])
    i, j = sorted_ones[:-1], sorted_ones[1:]
    near = np.flatnonzero(block[two][:-1] == block[two][1:])
    near = near[suffixes.common(i[near], j[near]) >= suffixes.length]
    near = near[suffixes.same_bytes(i[near], j[near])]
    hit = np.zeros(len(sorted_ones), bool)
    hit[near] = hit[near + 1] = True
    others, leader = starts[more], leader[more]
    return np.concatenate((sorted_ones[hit], others[suffixes.same_bytes(others, leader)]))


def _runs(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, start and end (exclusive) of runs of consecutive ``values`` of an owner; both sorted."""
    if not len(values):
        return values, values, values
    cut = np.flatnonzero((np.diff(values) != 1) | (np.diff(owner) != 0)) + 1
    a, b = np.concatenate(([0], cut)), np.concatenate((cut, [len(values)])) - 1
    return owner[a], values[a], values[b] + 1


def _sorted_marks(table: pa.Table, length: int) -> pa.RecordBatch:
    """Repeated windows of segments, which come grouped by ``key``.

    Equal windows of a group have their anchor at the same distance, so windows of different distances are never
    compared and are sorted one range of distances after the other.
    """
    data, offsets = strings(table.column("bytes").combine_chunks())
    suffixes = Suffixes(data, length)
    windows = np.diff(offsets) - length + 1
    key = table.column("key").to_numpy()
    group = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
    place = table.column("place").to_numpy().astype(np.int64)
    most = int(place.max()) + 1
    per_distance = np.zeros(most + 1, np.int64)
    np.add.at(per_distance, place - windows + 1, 1)
    np.add.at(per_distance, place + 1, -1)
    totals = np.cumsum(np.cumsum(per_distance[:most]))
    found, low = [], 0
    while low < most:
        before = totals[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(totals, before + SORT_BATCH, "right")))
        # windows whose anchor is at least low and less than high bytes after their start
        first = np.maximum(place - high + 1, 0)
        count = np.maximum(np.minimum(place - low, windows - 1) - first + 1, 0)
        row = np.repeat(np.arange(len(count)), count)
        window = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
        order = np.lexsort((row, place[row] - window, group[row]))
        row, window = row[order], window[order]
        distance = place[row] - window
        new = np.ones(len(row), bool)
        new[1:] = (group[row[1:]] != group[row[:-1]]) | (distance[1:] != distance[:-1])
        block = np.cumsum(new) - 1
        several = np.bincount(block)[block] > 1 if len(row) else new
        found.append(repeated_starts(suffixes, (offsets[row] + window)[several], block[several]))
        low = high
    found = np.sort(np.concatenate(found))
    owner = np.searchsorted(offsets, found, "right") - 1
    owner, a, b = _runs(found, owner)
    a, b = a - offsets[owner], b - offsets[owner]
    rows, first = np.unique(owner, return_index=True)
    keys = [table.column(c).to_numpy()[rows] for c in ("anchor", "place", "d1", "d2")]
    lists = _lists([a.astype(np.int32), b.astype(np.int32)], np.append(first, len(owner)))
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, keys), *lists], ["anchor", "place", "d1", "d2", "starts", "ends"]
    )


def _marked(length: int):
    """Sort the suffixes of whole groups; rows of a ``key`` follow each other."""

    def run(batches):
        waiting: list[pa.RecordBatch] = []
        held, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            cut = int(np.append(-1, np.flatnonzero(key != key[-1]))[-1]) + 1  # where the last group begins
            if cut:
                waiting.append(batch.slice(0, cut))
                held += _suffix_count(waiting[-1], length)
            if waiting and held >= SORT_BATCH and (cut or last != key[0]):
                yield _sorted_marks(pa.Table.from_batches(waiting), length)
                waiting, held = [], 0
            waiting.append(batch.slice(cut))
            held += _suffix_count(waiting[-1], length)
            last = key[-1]
        if waiting:
            yield _sorted_marks(pa.Table.from_batches(waiting), length)

    return run


def _suffix_count(batch: pa.RecordBatch, length: int) -> int:
    return len(strings(batch.column("bytes"))[0]) - batch.num_rows * (length - 1)


def _windows_of_hot(length: int, bits: int, whole: bool):
    """A row per window of a segment: its hash, and its bytes if ``whole``."""
    most = np.uint64((1 << bits) - 1)

    def run(batches):
        for batch in pieces(batches, "bytes", 1 << 16):
            data, offsets = strings(batch.column("bytes"))
            sums = prefix_hashes(data)
            windows = np.diff(offsets) - length + 1
            row = np.repeat(np.arange(len(windows)), windows)
            window = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
            start = offsets[row] + window
            h = mix((sums[start + length] - sums[start]) * powers(len(data) + 1, "down")[start]) & most
            columns = {c: pa.array(batch.column(c).to_numpy()[row]) for c in ("anchor", "place", "d1", "d2")}
            columns |= {"window": pa.array(window.astype(np.int32)), "hash": pa.array(h.view(np.int64))}
            if whole:
                held = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[start])
                fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(length), len(start), [None, pa.py_buffer(held)])
                columns["bytes"] = fixed.cast(pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _covered(spans, length: int) -> list[tuple[int, int]]:
    """Byte ranges covered by windows that start in ``spans``, merged."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        b += length - 1
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _kept(length: int):
    def run(batches):
        for batch in pieces(batches, "text"):
            data, offsets = strings(batch.column("text"))
            buffer = data.tobytes()
            copies, marks = batch.column("copies").to_pylist(), batch.column("marks").to_pylist()
            out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept_text")}
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                raw = buffer[a:b]
                if copies[i] > 1 and len(raw) >= length:
                    spans = [[0, len(raw)]]
                else:
                    spans = _covered([(m["a"], m["b"]) for m in marks[i] or []], length)
                edges = [0, *(x for span in spans for x in span), len(raw)]
                kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2]))
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(len(raw) - len(kept))
                out["n_spans"].append(len(spans))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["spans"].append([x for span in spans for x in span])
                out["kept_text"].append(kept.decode("utf-8", "ignore"))
            types = (pa.int64(),) * 3 + (pa.string(), pa.list_(pa.int64()), pa.string())
            columns = [batch.column(c) for c in ("k1", "k2")]
            columns += [pa.array(v, t) for v, t in zip(out.values(), types)]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", *out])

    return run


_RESULT = (
    "k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>, "
    "kept_text string"
)


def _corpus_name(scratch: Scratch) -> str:
    return "riskloom_" + scratch.root.rpartition("/")[2].replace("-", "_")


def _bucketed(df: DataFrame, scratch: Scratch) -> DataFrame:
    """``df`` written in buckets of its fingerprint, so that joins on it move only the other side."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    name = _corpus_name(scratch)
    writer = df.write.bucketBy(n, "k1", "k2").option("compression", "zstd").option("path", scratch.path("texts"))
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def cut_texts(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_segments: int = GROUP_SEGMENTS, texts: bool = True
) -> DataFrame:
    """A row per distinct text of ``docs(text, …)``: ``(k1, k2, n_bytes, n_removed, n_spans, kept_sha256, spans, kept_text)``.

    ``kept_text`` is what is left, without ``texts`` it is not there; a character that a span cuts loses its other bytes,
    too.
    """
    spark = docs.sparkSession
    docs = docs.select(*fingerprint(F.col("text")), F.coalesce("text", F.lit("")).alias("text"))
    with Scratch(spark, "suffixes") as scratch:
        distinct = docs.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
        distinct = distinct.select("k1", "k2", "text", "copies")
        try:
            corpus = _bucketed(distinct.mapInArrow(_anchored(length, gram), _TEXT), scratch)
            marks = _marks(corpus, scratch, length, group_segments)
            every = corpus.select("k1", "k2", "text", "copies").join(marks.hint("shuffle_hash"), ["k1", "k2"], "left")
            result = every.mapInArrow(_kept(length), _RESULT)
            return scratch.result(result if texts else result.drop("kept_text"))
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {_corpus_name(scratch)}")


def repeated_bytes(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_segments: int = GROUP_SEGMENTS
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)`` for every row of ``docs(doc_id, text, …)``.

    A byte is removed if a string of ``length`` bytes that covers it also starts elsewhere, in another row or in the same
    one; strings may overlap. ``spans`` lists start and end of each removed run.

    - null and empty texts: 0 bytes, nothing removed, the digest of nothing;
    - texts shorter than ``length``: untouched; very long texts are treated whole;
    - repeated rows: each is elsewhere to the other, so both are covered whole;
    - null or repeated ``doc_id``: one result per row, as texts are told apart by their fingerprint;
    - no rows: no rows; other columns are ignored.
    """
    cut = cut_texts(docs, length, gram, group_segments, texts=False)
    return docs.select("doc_id", *fingerprint(F.col("text"))).join(cut, ["k1", "k2"]).drop("k1", "k2")


def _marks(corpus: DataFrame, scratch: Scratch, length: int, group_segments: int) -> DataFrame:
    """``(k1, k2, marks)``: ranges of repeated window starts of each text that has any."""
    single = corpus.select("k1", "k2", F.posexplode("anchor").alias("i", "anchor"))
    shared = scratch.table(single.groupBy("anchor").count().where("count > 1").select("anchor"), "shared")
    wanted = single.join(shared, "anchor").groupBy("k1", "k2").agg(F.collect_list("i").alias("wanted"))
    segments = corpus.drop("copies").join(wanted.hint("shuffle_hash"), ["k1", "k2"]).mapInArrow(_digested(length), _SEGMENT)
    segments = scratch.table(segments, "segments")

    key = ["anchor", "place", "d1", "d2"]
    kinds = segments.groupBy(*key).agg(
        F.count("*").alias("n"), F.min(F.struct("k1", "k2", "low", "windows")).alias("at")
    )
    kinds = scratch.table(kinds, "kinds")
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    hot = (F.col("kinds") > group_segments).alias("hot")
    places = kinds.join(several, "anchor").select(*key, "at.*", hot)
    wanted = places.groupBy("k1", "k2").agg(F.collect_list(F.struct(*key, "low", "windows", "hot")).alias("segments"))
    cut = corpus.select("k1", "k2", "text").join(wanted.hint("shuffle_hash"), ["k1", "k2"])
    cut = scratch.table(
        cut.mapInArrow(
            _cut_out(length), "anchor long, place int, d1 long, d2 long, bytes binary, hot boolean"
        ),
        "cut",
    )
    n = int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = cut.where("not hot").select(*key, "bytes", F.col("anchor").alias("key")).repartition(n, "key")
    found = grouped.sortWithinPartitions("key", "d1").mapInArrow(_marked(length), _MARKS)
    found = found.select(*key, F.arrays_zip("starts", "ends").alias("ranges"))
    found = scratch.table(found.union(_hot_marks(cut.where("hot"), key, length, scratch)), "found")

    all_of_it = F.array(F.struct(F.lit(0).alias("starts"), F.col("at.windows").alias("ends")))
    whole = kinds.where("n > 1").select(*key, all_of_it.alias("ranges"))
    decided = whole.unionByName(found.join(whole.select(*key), key, "left_anti"))
    # one join, whose side of many segments Spark can split where a passage is hot
    placed = segments.join(decided, key).withColumn("range", F.explode("ranges"))
    mark = F.struct((F.col("low") + F.col("range.starts")).alias("a"), (F.col("low") + F.col("range.ends")).alias("b"))
    return placed.groupBy("k1", "k2").agg(F.collect_list(mark).alias("marks"))


def _hot_marks(cut: DataFrame, key: list[str], length: int, scratch: Scratch, bits: int = 64) -> DataFrame:
    """Repeated windows of segments whose anchor string has too many of them: dealt out by the hash of each window.

    Hashes of ``bits`` bits are counted with map-side sums, which rules out nearly all windows that are unique. The bytes
    of the others are digested (SHA-256), and those whose digest is counted twice are repeated.
    """
    columns = "anchor long, place int, d1 long, d2 long, window int, hash long"
    again = cut.mapInArrow(_windows_of_hot(length, bits, False), columns).groupBy("anchor", "hash").count()
    again = again.where("count > 1").select("anchor", "hash")
    held = cut.mapInArrow(_windows_of_hot(length, bits, True), f"{columns}, bytes binary").join(again, ["anchor", "hash"])
    held = scratch.table(held.select(*key, "window", F.unhex(F.sha2("bytes", 256)).alias("digest")), "hot")
    same = held.groupBy("anchor", "digest").count().where("count > 1").select("anchor", "digest")
    range_of = F.struct(F.col("window").alias("starts"), (F.col("window") + 1).alias("ends"))
    return held.join(same, ["anchor", "digest"]).groupBy(*key).agg(F.collect_list(range_of).alias("ranges"))
