"""Near-duplicate documents: universal hash minima, banding, signature verification, connected components.

1. One pass over the texts gives each document its set of distinct word shingles (64-bit hashes), a 128-bit fingerprint
   of that set, ``ROWS`` universal hash minima for each band, the band keys made of them, and one byte of each minimum as
   the signature. Documents of equal sets are one class from here on; copies never meet each other again.
2. Classes that share a band key form a bucket. Each is paired with the smallest of its bucket (a star, so a bucket of
   m classes gives m - 1 pairs). Pairs whose signatures agree too little are dropped, the others confirmed on the full
   sets of their texts.
3. What a star can miss is a link between two classes that are not the centre. So each bucket whose other members are
   not yet in one component is compared inside: cut in blocks of ``BLOCK`` classes, every pair of blocks is one small
   group whose shared shingles are counted by matrix products. A block returns a forest of its links, never its pairs.
4. Components by large-star and small-star over the confirmed links.

There are as many bands as make the chance that a pair at the similarity limit shares none ``MISSED``; above the limit it
is less.
"""

from __future__ import annotations

from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import components
from riskloom.llm.texts import fingerprint, mix, pieces, shingle_sets
from riskloom.session import Scratch, checked_broadcast

SHINGLE = 5
ROWS = 6
MISSED = 1e-5
MOST_BANDS = 64
BLOCK = 512
#: Standard deviations by which a signature may fall short of the limit before its pair is dropped.
SIGNATURE_SLACK = 5.0
MATRIX_COLUMNS = 4096

_numbers = np.random.Generator(np.random.PCG64(7))
MULTIPLIERS = _numbers.integers(0, 1 << 63, MOST_BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _numbers.integers(0, 1 << 64, MOST_BANDS * ROWS, dtype=np.uint64)

_SKETCH = (
    "doc_id long, k1 long, k2 long, n_shingles long, f1 long, f2 long, bands array<long>, signature binary"
)


def band_count(percent: int) -> int:
    """Bands after which a pair at the limit shares none with a chance of ``MISSED``; below 75 hundredths more are missed."""
    return min(MOST_BANDS, ceil(log(MISSED) / log(1 - min(0.99, percent / 100) ** ROWS)))


def _minima(hashes: np.ndarray, starts: np.ndarray, bands: int) -> np.ndarray:
    """One row per hash function: the least ``a * x + b mod 2^64`` of each run beginning at ``starts``."""
    out = np.empty((bands * ROWS, len(starts)), np.uint64)
    for i, (a, b) in enumerate(zip(MULTIPLIERS[: len(out)], ADDENDS)):
        out[i] = np.minimum.reduceat(hashes * a + b, starts)
    return out


def _sketched(size: int, n_bands: int):
    def run(batches):
        for batch in pieces(batches, "text"):
            hashes, offsets = shingle_sets(batch.column("text"), size)
            counts = np.diff(offsets)
            some = counts > 0
            f1, f2 = np.zeros((2, len(counts)), np.uint64)
            bands = np.zeros((len(counts), n_bands), np.uint64)
            signature = np.zeros((len(counts), n_bands * ROWS), np.uint8)
            if some.any():
                starts = offsets[:-1][some]
                f1[some] = np.add.reduceat(mix(hashes), starts)
                f2[some] = np.add.reduceat(mix(hashes ^ np.uint64(0xD6E8FEB86659FD93)), starts)
                minima = _minima(hashes, starts, n_bands)
                signature[some] = (minima >> np.uint64(7)).astype(np.uint8).T
                for band in range(n_bands):
                    key = np.full(minima.shape[1], band + 1, np.uint64)
                    for row in minima[band * ROWS : (band + 1) * ROWS]:
                        key = mix(key * np.uint64(31) + row)
                    bands[some, band] = key
            columns = [batch.column(c) for c in ("doc_id", "k1", "k2")]
            columns += [pa.array(x.view(np.int64)) for x in (counts, f1, f2)]
            ends = pa.array(np.arange(0, n_bands * len(counts) + 1, n_bands, dtype=np.int32))
            columns.append(pa.ListArray.from_arrays(ends, pa.array(bands.reshape(-1).view(np.int64))))
            columns.append(pa.array([row.tobytes() for row in signature], pa.binary()))
            names = ["doc_id", "k1", "k2", "n_shingles", "f1", "f2", "bands", "signature"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _least_agreement(percent: int) -> float:
    """Share of equal signature bytes below which a pair cannot be at the limit, but for a chance of 3e-7."""
    limit = percent / 100
    return limit - SIGNATURE_SLACK * (limit * (1 - limit) / (band_count(percent) * ROWS)) ** 0.5


def _similar_enough(shared, n, m, percent: int):
    return 100 * shared >= percent * (n + m - shared)


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _agreeing(percent: int):
    """Pairs whose signatures and set sizes do not rule the threshold out."""
    least = _least_agreement(percent)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            equal = (_signatures(batch.column("s1")) == _signatures(batch.column("s2"))).mean(axis=1) >= least
            n, m = (batch.column(c).to_numpy() for c in ("n1", "n2"))
            equal &= _similar_enough(np.minimum(n, m), n, m, percent)
            yield batch.select(["u", "v"]).filter(pa.array(equal))

    return run


def _confirmed(size: int, percent: int):
    """Pairs confirmed on the full sets of both texts."""

    def run(batches):
        for batch in pieces(batches, "t1"):
            (a, ia), (b, ib) = (shingle_sets(batch.column(c), size) for c in ("t1", "t2"))
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = a[ia[i] : ia[i + 1]], b[ib[i] : ib[i + 1]]
                shared = _in_sorted(x, y).sum()
                keep[i] = _similar_enough(int(shared), len(x), len(y), percent)
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    return run


def _in_sorted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the sorted ``y``."""
    if not len(y):
        return np.zeros(len(x), bool)
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x


def _block_links(size: int, percent: int):
    """Links between members of one block pair that are in different components: a forest of them."""
    least = _least_agreement(percent)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        n, signature = table.column("n").to_numpy(), _signatures(table.column("signature"))
        group = {}
        parent = np.array([group.setdefault(c, i) for i, c in enumerate(table.column("component").to_pylist())])

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        roots = parent.copy()
        able = roots[:, None] != roots[None]
        able &= _similar_enough(np.minimum(n[:, None], n[None]), n[:, None], n[None], percent)
        for i in range(len(n)):
            others = np.flatnonzero(able[i])
            able[i, others] = (signature[others] == signature[i]).mean(axis=1) >= least
        used = np.flatnonzero(able.any(axis=1))
        links = []
        if len(used):
            text = table.column("text").chunk(0).take(pa.array(used))
            shared = _shared_counts(*shingle_sets(text, size))
            n, nodes = n[used], table.column("node").to_numpy()[used]
            found = able[np.ix_(used, used)] & _similar_enough(shared, n[:, None], n[None], percent)
            for i, j in np.argwhere(np.triu(found, 1)):
                a, b = root(used[i]), root(used[j])
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    links.append((nodes[i], nodes[j]))
        u, v = (np.array([x[k] for x in links], np.int64) for k in (0, 1))
        return pa.table({"u": u, "v": v})

    return run


def _shared_counts(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sizes of all intersections, from products of slices of the set-by-shingle matrix."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    _, column, count = np.unique(hashes, return_inverse=True, return_counts=True)
    repeated = count[column] > 1
    rows, column = rows[repeated], np.cumsum(count > 1)[column[repeated]] - 1
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    shared = np.zeros((len(offsets) - 1,) * 2, np.int64)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, MATRIX_COLUMNS):
        a, b = np.searchsorted(column, [start, start + MATRIX_COLUMNS])
        matrix = np.zeros((len(shared), MATRIX_COLUMNS), np.float32)
        matrix[rows[a:b], column[a:b] - start] = 1
        shared += np.rint(matrix @ matrix.T).astype(np.int64)
    return shared


def _texts_of(classes: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One text for each class: ``(node, text)``."""
    wanted = checked_broadcast(classes.select("node", "k1", "k2"))
    found = docs.join(wanted, ["k1", "k2"]).groupBy("node").agg(F.first("text").alias("text"))
    return scratch.table(found, "texts")


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, k1, k2, n_shingles, component, component_id, kept)`` for every row of ``docs(doc_id, text, …)``.

    Two documents are linked when the shared part of their shingle sets is at least ``percent`` hundredths of the union;
    ``component_id`` is the smallest ``doc_id`` that links lead to. ``k1, k2`` are the fingerprint of the text,
    ``component`` numbers the groups of this run (null without shingles).

    - null, empty and blank texts: no shingles, linked with nothing, each kept;
    - fewer than ``shingle`` words: the whole sequence is the one shingle;
    - repeated rows: linked with each other like any copies; both keep ``doc_id = component_id``;
    - null ``doc_id``: takes part in links, never names a component unless no member has an id; then the id is null and
      ``kept`` compares null with null as equal;
    - no rows: no rows; columns beyond ``doc_id`` and ``text`` are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *fingerprint(F.col("text")), "text")
    with Scratch(docs.sparkSession, "minhash") as scratch:
        sketches = scratch.table(docs.mapInArrow(_sketched(shingle, band_count(percent)), _SKETCH), "sketches")
        one = F.min(F.struct("k1", "k2")).alias("k")
        classes = (
            sketches.where("n_shingles > 0")
            .groupBy("f1", "f2")
            .agg(
                F.min("doc_id").alias("least"),
                F.first("n_shingles").alias("n"),
                one,
                F.first("bands").alias("bands"),
                F.first("signature").alias("signature"),
            )
            .select("f1", "f2", "least", "n", "k.k1", "k.k2", "bands", "signature")
            .withColumn("node", F.monotonically_increasing_id())
        )
        classes = scratch.table(classes, "classes")

        keyed = classes.select("node", F.explode("bands").alias("bucket"))
        buckets = keyed.groupBy("bucket").agg(F.min("node").alias("centre"), F.count("*").alias("size"))
        members = scratch.table(keyed.join(buckets.where("size > 1"), "bucket"), "members")
        stars = members.where("node > centre").select(F.col("centre").alias("u"), F.col("node").alias("v"))
        stars = scratch.table(stars.distinct(), "stars")
        side = classes.select("node", "n", "signature")
        one, two = (side.toDF(*names) for names in (("u", "n1", "s1"), ("v", "n2", "s2")))
        likely = scratch.table(
            stars.join(one, "u").join(two, "v").mapInArrow(_agreeing(percent), "u long, v long"), "likely"
        )
        wanted = (
            members.where("size > 2")
            .select("node")
            .union(likely.select("u"))
            .union(likely.select("v"))
            .distinct()
            .join(classes.select("node", "k1", "k2"), "node")
        )
        texts = _texts_of(wanted, docs.select("k1", "k2", "text"), scratch)
        pairs = likely.join(texts.toDF("u", "t1"), "u").join(texts.toDF("v", "t2"), "v")
        confirmed = scratch.table(pairs.mapInArrow(_confirmed(shingle, percent), "u long, v long"), "confirmed")

        links = confirmed.union(_inside_links(members, classes, texts, confirmed, scratch, shingle, percent))
        found = components(links, scratch)
        node_ids = classes.select("node", "least", "f1", "f2").join(found, "node", "left")
        node_ids = node_ids.withColumn("component", F.coalesce("component", "node"))
        smallest = node_ids.groupBy("component").agg(F.min("least").alias("component_id"))
        of_class = node_ids.join(smallest, "component").select("f1", "f2", "component", "component_id")
        rows = sketches.select("doc_id", "k1", "k2", "n_shingles", "f1", "f2").join(of_class, ["f1", "f2"], "left")
        own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        rows = rows.select("doc_id", "k1", "k2", "n_shingles", "component", own.alias("component_id"))
        return scratch.result(rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _inside_links(members, classes, texts, confirmed, scratch, shingle, percent) -> DataFrame:
    """Links that the stars cannot show: between members of a bucket that are not its centre."""
    now = components(confirmed, scratch)
    placed = members.where("size > 2").join(now, "node", "left")
    placed = scratch.table(placed.withColumn("component", F.coalesce("component", "node")), "placed")
    outer = F.when(F.col("node") != F.col("centre"), F.col("component"))
    open_ones = placed.groupBy("bucket", "size").agg(
        F.min(outer).alias("low"), F.max(outer).alias("high"), F.sum(F.xxhash64("node") % (1 << 40)).alias("members")
    )
    # buckets of other bands with the same members need no second look
    open_ones = open_ones.where("low < high").groupBy("size", "members", "low", "high").agg(F.min("bucket").alias("bucket"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    spread = (
        placed.join(open_ones.select("bucket"), "bucket")
        .withColumn("i", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("j", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("bucket", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "node", "component")
        .join(classes.select("node", "n", "signature"), "node")
        .join(texts, "node")
    )
    found = spread.groupBy("bucket", "i", "j").applyInArrow(_block_links(shingle, percent), "u long, v long")
    return scratch.table(found, "inside")
