"""Near-duplicate vectors by sorted projection passes.

In each pass every vector gets a key of ``HASHES`` concatenated random projections, each cut in steps. All vectors are
sorted by label and key, the order is cut in windows of ``WINDOW`` rows, and each window is compared with itself and the
next. Near vectors have equal or neighbouring keys in some pass; a link found in any of them counts.

- Equal vectors are one class with a size, so copies never fill a window.
- A group may be larger than a window. As long as a window links with the last one it was compared with, its reach
  doubles, until it links no more: such a group is compared whole.
- Pairs are never written. Each vector carries its window in every pass, a pair counts in the first pass that compares
  its windows, and a group returns a count for each vector and a forest of its links.
- The number of passes follows from the number of vectors and from how crowded their keys are, counted over all rows, so
  that the chance to miss a pair stays the same: where vectors of a label share a direction, a projection tells fewer apart,
  so keys get longer and passes more. Where whole labels cost fewer comparisons than the passes, labels are compared whole.
"""

from __future__ import annotations

from math import ceil, inf, log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import components
from riskloom.llm.ranks import ranked
from riskloom.llm.topk import usable
from riskloom.session import BROADCAST_ROWS, Scratch

HASHES = 8
STEP = 0.5
WINDOW = 1_024
COSINE = 0.98
SEED = 11
MISSED = 0.01
#: Chance that a pair at the limit has one projection in the same step, and bits that one projection tells apart.
SAME_STEP, BITS = 0.68, 3.0
#: Passes whose keys are counted to see how crowded they are, and the most hashes of a key.
PROBES, MOST_HASHES = 3, 32


def pass_count(n: int, window: int) -> int:
    """Passes after which a pair at the limit is missed with a chance of ``MISSED``."""
    found = SAME_STEP ** (max(0.0, log2(max(n, 1) / window)) / BITS)
    return max(3, ceil(log(MISSED) / log(1 - min(found, 0.9))))


def crowding(keys: DataFrame, n: int, window: int, scratch: Scratch) -> tuple[list[float], float]:
    """The share of ``keys(class, keys)`` that the first 0, 1, 2 … hashes leave in groups of more than ``window`` rows, and
    how many rows of its label a row has in the mean. There are at most ``n / window`` such groups in a pass."""
    rows = keys.select("class", F.posexplode("keys").alias("pass", "key"))

    def prefix(hashes: int):
        return F.xxhash64("pass", "class", F.substring("key", 1, 2 * hashes))

    shares, mates = [], 0.0
    for hashes in range(MOST_HASHES + 1):
        groups = rows.groupBy(prefix(hashes).alias("group")).count()
        if not hashes:
            groups = scratch.table(groups, "labels")
            mates = (groups.agg(F.sum(F.col("count").cast("double") ** 2)).first()[0] or 0.0) / max(n * PROBES, 1)
        crowded = scratch.table(groups.where(F.col("count") > window), "crowded")
        number, left = crowded.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
        if not left:
            break
        shares.append(left / (n * PROBES))
        crowded = crowded.select("group")
        crowded = F.broadcast(crowded) if number <= BROADCAST_ROWS else crowded
        rows = keys.select("class", F.posexplode("keys").alias("pass", "key"))
        rows = rows.withColumn("group", prefix(hashes)).join(crowded, "group", "left_semi").drop("group")
    return shares, mates


def crowded_passes(shares: list[float], most: float) -> float:
    """Passes after which ``MISSED`` of the pairs at the limit are missed where the first 0, 1, 2 … hashes leave ``shares``
    of the rows crowded; infinite beyond ``most``. Rows that share hashes enough to be a window at most are compared."""
    apart = -np.diff([1.0, *shares, 0.0])
    found = np.minimum(SAME_STEP ** np.arange(len(apart)), 0.9)
    passes = 3
    while apart @ (1 - found) ** passes > MISSED:
        passes += 1
        if passes > most:
            return inf
    return passes


def _units(vectors) -> np.ndarray:
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    out /= np.abs(out).max(axis=1, initial=0, keepdims=True)  # so that squares neither vanish nor overflow
    return out / np.sqrt((out**2).sum(axis=1, keepdims=True))


def _vectors(column: pa.Array) -> list[np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    offsets = offsets - offsets[0]
    return [values[a:b] for a, b in zip(offsets, offsets[1:])]


def _keys(passes: int, seed: int, hashes: int):
    """The sort key of each vector in each pass, beside the first column."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            units = _units(_vectors(batch.column("vector")))
            keys = []
            for t in range(passes):
                rng = np.random.Generator(np.random.PCG64([seed, t]))
                # drawn dimension by dimension, so a shorter vector meets the same numbers
                directions = rng.standard_normal((units.shape[1], hashes))
                shift = np.random.Generator(np.random.PCG64([seed, t, 1])).random(hashes)
                cells = np.floor(units @ directions / STEP + shift).clip(-(1 << 15), (1 << 15) - 1)
                cells = (cells + (1 << 15)).astype(">u2")
                keys.append([row.tobytes() for row in cells])
            lists = pa.array([list(k) for k in zip(*keys)], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], [batch.schema.names[0], "keys"])

    return run


def _similar(table: pa.Table, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that are linked: rows of the window, and rows of the other one (or later rows of the same)."""
    units = _units(_vectors(table.column("vector")))
    label = table.column("class").to_numpy()
    other = table.column("other").to_numpy(zero_copy_only=False)
    own, more = np.flatnonzero(~other), np.flatnonzero(other)
    same_window = table.column("r")[0].as_py() == 0
    more = own if same_window else more
    near = (units[own] @ units[more].T >= cosine) & (label[own][:, None] == label[more][None])
    if same_window:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    return own[i], more[j]


def _links_across(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        i, _ = _similar(table, cosine)
        first = table.select(["pass", "window", "r"]).slice(0, 1)
        return first.append_column("any", pa.array([len(i) > 0]))

    return run


def _counted(cosine: float):
    """Links of a window pair that no earlier pass compares: how many each vector has, and a forest of them."""

    def run(table: pa.Table) -> pa.Table:
        i, j = _similar(table, cosine)
        t = table.column("pass")[0].as_py()
        windows, reach = (np.stack(_vectors(table.column(c))) for c in ("windows", "reach"))
        for s in range(t):
            apart = windows[j, s] - windows[i, s]
            covered = np.where(apart >= 0, apart <= reach[i, s], -apart <= reach[j, s])
            i, j = i[~covered], j[~covered]
        node, size = (table.column(c).to_numpy() for c in ("node", "size"))
        links = np.zeros(len(node), np.int64)
        np.add.at(links, i, size[j])
        np.add.at(links, j, size[i])
        parent = list(range(len(node)))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        forest = []
        for a, b in zip(i.tolist(), j.tolist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
                forest.append((a, b))
        some = np.flatnonzero(links)
        u = np.concatenate((node[some], node[[a for a, _ in forest]])).astype(np.int64)
        v = pa.array([None] * len(some) + node[[b for _, b in forest]].tolist(), pa.int64())
        count = np.concatenate((links[some], np.zeros(len(forest), np.int64)))
        return pa.table({"u": pa.array(u), "v": v, "links": pa.array(count)})

    return run


def _compared(placed: DataFrame, wanted: DataFrame, function, schema: str) -> DataFrame:
    """``function`` over each wanted pair of windows: ``window`` and ``window + r`` of a pass."""
    other = wanted.where("r > 0").select("pass", F.col("window").alias("w"), (F.col("window") + F.col("r")).alias("window"), "r")
    sides = placed.join(wanted, ["pass", "window"]).withColumn("other", F.lit(False))
    others = placed.join(other, ["pass", "window"]).drop("window").withColumnRenamed("w", "window")
    both = sides.unionByName(others.withColumn("other", F.lit(True)))
    return both.groupBy("pass", "window", "r").applyInArrow(function, schema)


def near_vectors(vectors: DataFrame, cosine: float = COSINE, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, embedding, label, …)``.

    Rows of one label are linked at a cosine of at least ``cosine`` in double precision. ``n_links`` counts the other
    rows linked directly, ``component_id`` is the smallest ``vec_id`` that links lead to.

    - null label, null, empty or zero vectors, null or non-finite components: no links, a component of its own;
    - equal vectors and repeated rows: linked with each other; vectors of different lengths: the shorter ends in zeros;
    - null ``vec_id``: linked, but names no component; ``kept`` compares nulls as equal;
    - no rows: no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    with Scratch(spark, "neighbours") as scratch:
        vector = F.col("embedding").cast("array<double>")
        rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("vector"))
        vector = F.col("vector")
        able = usable(vector) & F.col("label").isNotNull() & F.exists(vector, lambda x: x != 0)
        rows = rows.withColumn("able", F.coalesce(able, F.lit(False)))
        prints = [F.xxhash64("label", "vector").alias("k1"), F.xxhash64(F.lit("second"), "label", "vector").alias("k2")]
        rows = rows.select("*", *prints)
        classes = rows.where("able").groupBy("k1", "k2").agg(
            F.min("vec_id").alias("least"), F.count("*").alias("size"),
            F.first("label").alias("label"), F.first("vector").alias("vector"),
        )
        classes = scratch.table(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
        n = classes.count()
        passes, hashes, whole = _plan(classes, n, window, seed, scratch)

        keyed = classes.select("node", "vector").mapInArrow(_keys(passes, seed, hashes), "node long, keys array<binary>")
        keyed = scratch.table(keyed.join(classes.select("node", "label"), "node"), "keys")
        every = keyed.select("node", "label", F.posexplode("keys").alias("pass", "key"))
        order = ranked(every, ["pass", "label", "key", "node"], "rank", scratch)
        at = F.floor((F.col("rank") - F.col("pass") * F.lit(n)) / window).cast("int")
        order = scratch.table(order.select("node", "pass", at.alias("window")), "order")

        labels = F.xxhash64("label").alias("class")
        body = classes.select("node", "size", labels, "vector")
        placed = order.join(body, "node")
        reach = _whole_reaches(order, classes, scratch) if whole else _reaches(order, placed, cosine, scratch)
        known = order.join(reach, ["pass", "window"], "left").withColumn("reach", F.coalesce("reach", F.lit(1)))
        known = known.groupBy("node").agg(
            F.sort_array(F.collect_list(F.struct("pass", "window", F.col("reach").cast("int").alias("reach")))).alias("p")
        )
        known = known.select("node", F.col("p.window").alias("windows"), F.col("p.reach").alias("reach"))
        wanted = reach.withColumn("r", F.explode(F.sequence(F.lit(0), "reach"))).select("pass", "window", F.col("r").cast("int"))
        found = _compared(
            placed.join(known, "node"), wanted, _counted(cosine), "u long, v long, links long"
        )
        found = scratch.table(found, "found")
        links = found.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("found"))
        joined = components(found.where("v is not null").select("u", "v"), scratch)

        result = classes.select("node", "k1", "k2", "size", "least").join(links, "node", "left").join(joined, "node", "left")
        result = result.withColumn("component", F.coalesce("component", "node"))
        smallest = result.groupBy("component").agg(F.min("least").alias("component_id"))
        own = (F.coalesce("found", F.lit(0)) + F.col("size") - 1).alias("n_links")
        result = result.join(smallest, "component").select("k1", "k2", own, "component_id")
        out = rows.select("vec_id", "able", "k1", "k2").join(result, ["k1", "k2"], "left")
        component = F.when(F.col("able"), F.col("component_id")).otherwise(F.col("vec_id"))
        n_links = F.when(F.col("able"), F.col("n_links")).otherwise(0).cast("long")
        out = out.select("vec_id", n_links.alias("n_links"), component.alias("component_id"))
        return scratch.result(out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def _plan(classes: DataFrame, n: int, window: int, seed: int, scratch: Scratch) -> tuple[int, int, bool]:
    """How many passes, hashes a key, and whether one pass compares labels whole instead."""
    probe = classes.select(F.xxhash64("label").alias("class"), "vector")
    probe = probe.mapInArrow(_keys(PROBES, seed, MOST_HASHES), "class long, keys array<binary>")
    shares, mates = crowding(scratch.table(probe, "probe"), n, window, scratch)
    even = pass_count(n, window)
    # a pass compares a window with two, a label compared whole with half of its windows
    passes = crowded_passes(shares, max(even, mates / window / 4))
    hashes = min(MOST_HASHES, max(HASHES, len(shares) + 1))
    return (1, hashes, True) if passes == inf else (max(even, passes), hashes, False)


def _whole_reaches(order: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """``(pass, window, reach)``: up to the last window that has a label of this one."""
    labelled = order.join(classes.select("node", "label"), "node").select("pass", "window", "label").distinct()
    labelled = scratch.table(labelled, "labelled")
    last = labelled.groupBy("pass", "label").agg(F.max("window").alias("last"))
    reach = labelled.join(last, ["pass", "label"]).groupBy("pass", "window").agg(F.max("last").alias("last"))
    return scratch.table(reach.select("pass", "window", (F.col("last") - F.col("window")).alias("reach")), "reach")


def _reaches(order: DataFrame, placed: DataFrame, cosine: float, scratch: Scratch) -> DataFrame:
    """``(pass, window, reach)``: with how many windows after itself each window is compared, at least one."""
    windows = order.select("pass", "window").distinct()
    reach = scratch.table(windows.withColumn("reach", F.lit(1)), "reach")
    last = 1
    while True:
        # windows that still linked with the last one they met go on to twice as far
        wanted = reach.where(F.col("reach") == last).select("pass", "window", F.lit(last).alias("r"))
        schema = "pass int, window int, r int, any boolean"
        linked = _compared(placed, wanted, _links_across(cosine), schema).where("any").select("pass", "window")
        linked = scratch.table(linked.withColumn("further", F.lit(2 * last)), "linked")
        if not linked.take(1):
            return reach
        reach = reach.join(linked, ["pass", "window"], "left")
        reach = scratch.table(reach.select("pass", "window", F.coalesce("further", "reach").alias("reach")), "reach")
        last *= 2
