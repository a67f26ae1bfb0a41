"""Exact nearest-neighbour imputation as a partitioned join.

A missing value becomes the mean of that column over the ``k`` nearest rows that have it, by the distance over the
coordinates both rows have, scaled up to all coordinates. Comparing every pair is quadratic, so the rows are first
put into a hierarchy of nodes. The roots are the patterns of values that are there; a node of many rows is cut at the
quartiles of the columns that spread most in it, all nodes of a level at once, until every leaf is small. The depth grows
with the logarithm of the table, leaves stay as they are, and the nodes are a table like any other.

Per leaf, the smallest and largest value of each column bound the distance from a row to any row in it. A first round
searches one promising leaf for each request; its k-th distance is an upper bound for the k-th of all. The second searches
every leaf that can hold something closer than that. Nothing is sampled or capped: whatever the first round finds, the
second makes the answer the exact one. The leaves' bounds are sent to the tasks, or, where they are too many, met by joins
level by level.

In a task, the donors of a leaf and the requests to it are put into tiles of near rows. Tiles are compared by matrix products
from the nearest on, until the bounds of the rest are farther than the k-th found; only the pairs that a product leaves
are measured exactly. Leaves that many rows ask for are searched by several tasks, so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskloom.operators.impute import fit_mean
from riskloom.operators.ordered import finite
from riskloom.session import BROADCAST_ROWS, checked_broadcast, written

NEIGHBOURS = 5
LEAF_ROWS = 40_000
SPLIT_COLUMNS = 3
SPLIT_PARTS = 4
ASKING_ROWS = 60_000
WORK_CELLS = 200_000
#: Rows of a leaf, and of the requests to it, that are compared as one.
TILE_DONORS, TILE_ASKING = 64, 32
#: Requests that a task puts into tiles together, and pairs of request and leaf in a batch, beyond those of one tile.
TILED_ROWS, ROUTED_ROWS = 100_000, 10_000
#: The rows' share of error in a bound, from adding squares in another order.
SLACK = 1e-9
#: The squares' share of error in a distance from a product.
ROUNDING = 1e-12


def _vector(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """``(key, x0, x1, …, pattern)``; the pattern marks which values are there."""
    values = df.select(F.col(key).cast("string").alias("key"), *[finite(c).alias(f"x{i}") for i, c in enumerate(columns)])
    pattern = F.concat(*[F.when(F.col(f"x{i}").isNull(), "0").otherwise("1") for i in range(len(columns))])
    return values.withColumn("pattern", pattern)


def _boxes(rows: DataFrame, xs: Sequence[str]) -> DataFrame:
    """A row per node: its size, and each column's bounds and variance, null where the node's pattern lacks the column."""
    measured = [
        f(x).alias(f"{name}_{x}") for x in xs for name, f in (("low", F.min), ("high", F.max), ("spread", F.var_pop))
    ]
    return rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *measured)


def _cut(rows: DataFrame, inner: DataFrame, xs: Sequence[str], most: int) -> DataFrame:
    """The rows below ``inner`` nodes, each moved to the child it falls in.

    A node is cut in no more columns than bring its children to ``most`` rows, so that leaves are well filled. A cut lies above the smallest value, so every cut leaves rows on both sides, however hot a value is.
    """
    spans = [
        F.struct(F.col(f"spread_{x}").alias("spread"), F.lit(i).alias("i"), F.col(f"low_{x}").alias("low"), F.col(f"high_{x}").alias("high"))
        for i, x in enumerate(xs)
    ]
    widest = F.reverse(F.array_sort(F.filter(F.array(*spans), lambda s: s["high"] > s["low"])))
    needed = F.ceil(F.log(F.col("n") / F.lit(float(most))) / F.log(F.lit(float(SPLIT_PARTS)))).cast("int")
    needed = F.greatest(F.lit(1), F.least(F.lit(SPLIT_COLUMNS), needed))
    chosen = checked_broadcast(inner.select("node", F.slice(widest, F.lit(1), needed).alias("chosen")))
    values = F.array(*xs)
    sides = range(SPLIT_COLUMNS)
    placed = rows.join(chosen, "node").withColumns({f"v{i}": F.get(values, F.get("chosen", F.lit(i))["i"]) for i in sides})
    shares = [i / SPLIT_PARTS for i in range(1, SPLIT_PARTS)]
    lows = {i: F.get("chosen", F.lit(i))["low"] for i in sides}
    points = placed.groupBy("node").agg(
        *[F.percentile_approx(f"v{i}", shares, 1_000).alias(f"p{i}") for i in sides],
        *[F.min(F.when(F.col(f"v{i}") > lows[i], F.col(f"v{i}"))).alias(f"next{i}") for i in sides],
        *[F.min(lows[i]).alias(f"low{i}") for i in sides],
    )

    def cuts(i: int) -> Column:
        above = F.array_distinct(F.filter(f"p{i}", lambda c: c > F.col(f"low{i}")))
        return F.when(F.size(above) > 0, above).otherwise(F.array(f"next{i}"))

    def part(i: int) -> Column:
        return F.coalesce(F.size(F.filter(f"cuts{i}", lambda c: c <= F.col(f"v{i}"))), F.lit(0))

    found = points.select("node", *[cuts(i).alias(f"cuts{i}") for i in sides])
    met = placed.join(checked_broadcast(found), "node")
    parts = [part(i) for i in sides]
    child = F.concat_ws("/", "node", F.concat(*[p.cast("string") for p in parts]))
    return met.select(child.alias("node"), "key", *xs)


def _tree(donors: DataFrame, xs: Sequence[str], k: int) -> tuple[DataFrame, list[DataFrame]]:
    """``(cell, key, x…)``, the donors in their leaves, and the nodes of each level, roots first.

    A node is ``(parent, node, n, leaf, low…, high…)``. An inner node has so many rows that one child holds ``k``.
    """
    most = max(LEAF_ROWS, k * SPLIT_PARTS**SPLIT_COLUMNS)
    rows = donors.select(F.col("pattern").alias("node"), "key", *xs)
    leaves, levels = [], []
    while True:
        rows = written(rows, "knn-rows")
        spread = F.lit(False)
        for x in xs:
            spread = spread | F.coalesce(F.col(f"high_{x}") > F.col(f"low_{x}"), F.lit(False))
        parent = F.regexp_extract("node", "^(.*)/", 1).alias("parent")
        boxes = _boxes(rows, xs).select(parent, "*", ((F.col("n") <= most) | ~spread).alias("leaf"))
        nodes = written(boxes, "knn-nodes")
        levels.append(nodes)
        ends = checked_broadcast(nodes.where("leaf").select("node"))
        leaves.append(rows.join(ends, "node", "left_semi").withColumnRenamed("node", "cell"))
        inner = nodes.where("not leaf")
        if not inner.take(1):
            break
        rows = _cut(rows, inner, xs, most)
    placed = leaves[0]
    for more in leaves[1:]:
        placed = placed.unionByName(more)
    return placed, levels


def _bound(xs: Sequence[str], upper: bool) -> Column:
    """Squared distance from a row to the nearest or the farthest point of a node's box; null if they share no column."""
    total, shared = F.lit(0.0), F.lit(0)
    for x in xs:
        v, low, high = F.col(x), F.col(f"low_{x}"), F.col(f"high_{x}")
        # greatest passes over nulls
        side = F.coalesce(F.greatest(v - low, high - v), F.lit(0.0)) if upper else F.greatest(low - v, v - high, F.lit(0.0))
        # a product would hold the side twice, and the sum must stay small enough to be compiled
        total = total + F.pow(side, F.lit(2.0))
        shared = shared + (v.isNotNull() & low.isNotNull()).cast("int")
    return total * F.lit(float(len(xs))) / F.nullif(shared, F.lit(0))


def _children(at: DataFrame | None, requests: DataFrame, level: DataFrame, xs: Sequence[str]) -> DataFrame:
    """Each request with every node of ``level`` below the nodes it is at; at the roots, with those that hold its column."""
    if at is None:
        held = F.filter(F.array(*[F.when(F.col(f"low_{x}").isNotNull(), F.lit(i)) for i, x in enumerate(xs)]), lambda c: c.isNotNull())
        return requests.join(checked_broadcast(level.select("*", F.explode(held).alias("column"))), "column")
    return at.withColumnRenamed("node", "parent").join(checked_broadcast(level), "parent")


def _descend(requests: DataFrame, levels: list[DataFrame], xs: Sequence[str], k: int, first: bool) -> DataFrame:
    """``(key, column, x…, limit, cell)``: the leaves to search for each request, level by level, where they are too many to
    be sent to every task. The first round has no limit yet.

    The first descent follows one child a level; the full one all that can come as near as the request's ``limit``.
    """
    carried = ["key", "column", *xs, *([] if first else ["limit"])]
    at, reached = None, []
    # a request multiplies into the nodes it meets: spread them, however few bytes they are
    requests = requests.repartition(_tasks(requests), "key", "column")
    for level in levels:
        met = _children(at, requests, level.drop(*[f"spread_{x}" for x in xs]), xs)
        if first:
            # k rows below a node are k distances no larger than the farthest
            met = met.where(F.col("n") >= k).withColumn("far", _bound(xs, upper=True)).where(F.col("far").isNotNull())
            taken = F.min(F.struct("far", "node", "leaf")).alias("taken")
            # folded before the shuffle: the children of a node stay in the task that joined them
            met = met.groupBy("key", "column").agg(taken, *[F.first(x).alias(x) for x in xs]).select("*", "taken.node", "taken.leaf")
        else:
            met = met.where(_bound(xs, upper=False) <= F.col("limit") * (1 + SLACK))
        met = written(met.select(*carried, "node", "leaf"), "knn-descent")
        reached.append(met.where("leaf").drop("leaf").withColumnRenamed("node", "cell"))
        at = met.where("not leaf").drop("leaf").repartition(_tasks(requests), "key", "column", "node")
    out = reached[0]
    for more in reached[1:]:
        out = out.unionByName(more)
    return out


def _tasks(df: DataFrame) -> int:
    """The work here is far larger than its rows: a fixed number of tasks, not one per so many bytes."""
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _reached(leaves: list[Row], xs: Sequence[str], k: int, first: bool):
    """Batches of requests with the leaves to search for each: as ``_descend``, over all leaves at once.

    The first leaf is the one whose k-th distance should be least, as distances shrink with the rows that a box holds.
    Requests are put into tiles of near rows with the same columns. What holds for the box of a tile leaves few leaves, and
    only those are measured for each of its rows, so most of the work no longer grows with rows times leaves.
    """
    low, high = (np.array([[r[f"{side}_{x}"] for x in xs] for r in leaves], dtype=float) for side in ("low", "high"))
    n, names, has = np.array([r["n"] for r in leaves]), pa.array([r["node"] for r in leaves], pa.string()), ~np.isnan(low)
    shrunk = np.where(n >= k, (k / n) ** (2 / 3), np.inf)

    def measured(least: np.ndarray, most: np.ndarray, at: np.ndarray, known: np.ndarray) -> np.ndarray:
        """(boxes of requests x leaves): their least distance, or in the first round the distance hoped for; rows are boxes
        of one point, and a box of several points is never farther than a point of it."""
        near, far = np.zeros((2, len(least), len(at)))
        for j in np.flatnonzero(known):
            under, over = low[None, at, j] - most[:, [j]], least[:, [j]] - high[None, at, j]
            near += np.fmax(np.fmax(under, over), 0.0) ** 2
            if first:
                far += np.fmax(np.fmax(least[:, [j]] - low[None, at, j], high[None, at, j] - most[:, [j]]), 0.0) ** 2
        shared = has[at][:, known].sum(axis=1)
        if not first:
            return np.where(shared > 0, near * len(xs) / shared, np.inf)
        return np.where((shared > 0) & (n[at] >= k), (near + far * shrunk[at]) * len(xs) / shared, np.inf)

    def found(x: np.ndarray, column: np.ndarray, limit: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of a tile and the leaves to search for them."""
        least = measured(x.min(axis=0)[None], x.max(axis=0)[None], np.arange(len(leaves)), known)[0]

        def of(at: np.ndarray) -> np.ndarray:
            return np.where(has[at][:, column].T, measured(x, x, at, known), np.inf)

        if not first:
            at = np.flatnonzero((least <= limit.max() * (1 + SLACK)) & np.isfinite(least))
            near = of(at)
            rows, place = np.nonzero((near <= limit[:, None] * (1 + SLACK)) & np.isfinite(near))
            return rows, at[place]
        some = np.argsort(least, kind="stable")[:k]
        at = np.flatnonzero((least <= of(some).min(axis=1).max() * (1 + SLACK)) & np.isfinite(least))
        if not len(at):
            return at, at
        hoped = of(at)
        best = hoped.argmin(axis=1)
        rows = np.flatnonzero(np.isfinite(hoped[np.arange(len(x)), best]))
        return rows, at[best[rows]]

    def routed(requests: pa.Table) -> Iterator[pa.RecordBatch]:
        x, column = _values(requests, xs), requests.column("column").to_numpy()
        limit = np.zeros(len(x)) if first else requests.column("limit").to_numpy()
        met, size = [], 0

        def taken() -> list[pa.RecordBatch]:
            rows, at = (pa.array(np.concatenate(p)) for p in zip(*met))
            return requests.take(rows).append_column("cell", names.take(at)).combine_chunks().to_batches()

        for known, tile in _alike(x):
            with np.errstate(all="ignore"):
                rows, at = found(x[tile], column[tile], limit[tile], known)
            if len(rows):
                met.append((tile[rows], at))
                size += len(rows)
            if size >= ROUTED_ROWS:
                yield from taken()
                met, size = [], 0
        if met:
            yield from taken()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the more requests there are, the nearer are the rows of a tile
        kept, rows = [], 0
        for batch in batches:
            kept.append(batch)
            rows += batch.num_rows
            if rows >= TILED_ROWS:
                yield from routed(pa.Table.from_batches(kept))
                kept, rows = [], 0
        if rows:
            yield from routed(pa.Table.from_batches(kept))

    return run


def _alike(x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tiles of near rows that have the same columns, of which there is one at least: those columns and the rows."""
    kinds, kind = np.unique(~np.isnan(x), axis=0, return_inverse=True)
    for number, known in enumerate(kinds):
        rows = np.flatnonzero(kind.ravel() == number)
        if known.any():
            order, starts = _tiles(x[rows][:, known], TILE_ASKING)
            yield from ((known, tile) for tile in np.split(rows[order], starts[1:]))


def _values(table: pa.Table | pa.RecordBatch, xs: Sequence[str]) -> np.ndarray:
    """The columns as rows of numbers, missing ones as nan."""
    return np.column_stack([table.column(x).to_numpy(**{} if isinstance(table, pa.Table) else {"zero_copy_only": False}) for x in xs])


def _reach(requests: DataFrame, levels: list[DataFrame], leaves: list[Row], xs: Sequence[str], k: int, first: bool) -> DataFrame:
    """``(key, column, x…, limit, cell)``: the leaves to search for each request, one in the first round."""
    if len(leaves) > BROADCAST_ROWS:
        return _descend(requests, levels, xs, k, first)
    if not leaves:
        return requests.withColumn("cell", F.lit("")).limit(0)
    schema = StructType([*requests.schema.fields, StructField("cell", StringType())])
    return written(requests.mapInArrow(_reached(leaves, xs, k, first), schema), "knn-routes")


def _tiles(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows, and where tiles of at most ``most`` near rows begin in it: halves along the widest column."""
    order, starts, left = np.arange(len(x)), [], [(0, len(x))]
    while left:
        a, b = left.pop()
        if b - a <= most:
            starts.append(a)
            continue
        rows, middle = order[a:b], (b - a) // 2
        part = x[rows]
        wide = part[:, (part.max(axis=0) - part.min(axis=0)).argmax()]
        order[a:b] = rows[np.argpartition(wide, middle)]
        left += [(a + middle, b), (a, a + middle)]
    return order, np.array(starts)


class _Leaf:
    """The donors of a leaf, which all have the same columns, in tiles."""

    def __init__(self, y: np.ndarray):
        self.y, self.has = y, ~np.isnan(y[0])
        whole = y[:, self.has]
        self.order, starts = _tiles(whole, TILE_DONORS)
        self.ends = np.append(starts, len(y))
        self.low, self.high = np.full((2, len(starts), y.shape[1]), np.nan)
        self.low[:, self.has] = np.minimum.reduceat(whole[self.order], starts)
        self.high[:, self.has] = np.maximum.reduceat(whole[self.order], starts)

    def nearest(self, x: np.ndarray, shared: np.ndarray, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, donor, distance)`` by row: the k nearest donors by squares over the ``shared`` columns; equal ones go to
        the earlier donor. Donors beyond ``limit`` may be left out.

        Products find the pairs that may be near enough, with room for their rounding; the distance of those is summed
        column by column, so it is the same whatever tile it is found in.
        """
        x, y, low, high = x[:, shared], self.y[:, shared], self.low[:, shared], self.high[:, shared]
        centre = (low.min(axis=0) + high.max(axis=0)) / 2
        moved = (y - centre)[self.order]
        product = np.column_stack([moved, (moved**2).sum(axis=1)]).T
        members = [np.arange(a, b) for a, b in zip(self.ends, self.ends[1:])]
        # with a bound for each row a wider tile meets hardly more donors
        size = TILE_ASKING * (4 if np.isfinite(limit).all() else 1)
        most = max(1, WORK_CELLS // (TILE_DONORS * size))
        order, starts = _tiles(x, size)
        out = []
        for rows in np.split(order, starts[1:]):
            part, lim = x[rows], limit[rows]
            mine = part - centre
            own = (mine**2).sum(axis=1)
            mine = np.column_stack([-2 * mine, np.ones(len(rows))])
            room = ROUNDING * (own + product[-1].max())
            gap = np.maximum(np.maximum(low - part.max(axis=0), part.min(axis=0) - high), 0.0)
            least = (gap**2).sum(axis=1)
            tiles = np.flatnonzero(~(least > lim.max() * (1 + SLACK)))
            tiles = tiles[np.argsort(least[tiles], kind="stable")]
            i, j, d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            # without a bound the steps begin short, as the distances found are one
            at, step = 0, most if np.isfinite(lim).all() else max(2, -(-2 * k // TILE_DONORS))
            while at < len(tiles) and not least[tiles[at]] > lim.max() * (1 + SLACK):
                some = tiles[at : at + step]
                some = some[~(least[some] > lim.max() * (1 + SLACK))]
                at, step = at + step, min(4 * step, most)
                met = np.concatenate([members[t] for t in some])
                short = mine @ product[:, met]
                reach = lim
                if len(met) >= k and np.isinf(lim).any():
                    reach = np.fmin(lim, np.partition(short, k - 1, axis=1)[:, k - 1] + own + room)
                # what overflows is no number and stays
                new_i, new_j = np.nonzero(~(short > (reach * (1 + SLACK) - own + room)[:, None]))
                new_j = self.order[met[new_j]]
                new_d = np.zeros(len(new_i))
                for f in range(x.shape[1]):
                    new_d += (part[new_i, f] - y[new_j, f]) ** 2
                good = np.isfinite(new_d)
                i, j, d = (np.concatenate(p) for p in ((i, new_i[good]), (j, new_j[good]), (d, new_d[good])))
                best = np.lexsort((j, d, i))
                i, j, d = i[best], j[best], d[best]
                place = np.arange(len(i)) - np.searchsorted(i, i, side="left")
                i, j, d, place = (p[place < k] for p in (i, j, d, place))
                last = place == k - 1
                lim = lim.copy()
                lim[i[last]] = np.minimum(lim[i[last]], d[last])
            out.append((rows[i], j, d))
        return tuple(np.concatenate(p) for p in zip(*out))


def _searched(asking: pa.Table, donors: pa.Table, xs: Sequence[str], k: int, first: bool) -> pa.Table:
    """The k nearest donors of this leaf for each request, or in the first round the distance of the k-th."""
    schema = _LIMIT if first else _FOUND
    if not asking.num_rows or not donors.num_rows:
        return schema.empty_table()
    # by key, so that the place settles ties
    donors = donors.take(pc.sort_indices(donors, sort_keys=[("key", "ascending")]))
    leaf, x, column = _Leaf(_values(donors, xs)), _values(asking, xs), asking.column("column").to_numpy()
    limits = np.full(len(x), np.inf) if first else asking.column("limit").to_numpy()
    known = ~np.isnan(x)
    kinds, kind = np.unique(known, axis=0, return_inverse=True)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for number, mask in enumerate(kinds):
        rows, shared = np.flatnonzero(kind.ravel() == number), np.flatnonzero(mask & leaf.has)
        if not len(shared):
            continue
        with np.errstate(all="ignore"):
            i, j, d = leaf.nearest(x[rows], shared, limits[rows] * len(shared) / len(xs), k)
            found.append((rows[i], j, d * len(xs) / len(shared)))
    i, j, d = (np.concatenate(p) for p in zip(*found))
    kept = np.isfinite(d)
    i, j, d = i[kept], j[kept], d[kept]
    if first:
        n = np.bincount(i, minlength=len(x))
        limit = np.zeros(len(x))
        np.maximum.at(limit, i, d)
        limit[n < k] = np.inf
        return pa.table([asking.column("key"), asking.column("column"), pa.array(limit)], schema=schema)
    asked, donor = asking.select(["key", "column"]).take(pa.array(i)), donors.column("key").take(pa.array(j))
    return pa.table([*asked.columns, pa.array(d), donor, pa.array(leaf.y[j, column[i]])], schema=schema)


_LIMIT = pa.schema([("key", pa.string()), ("column", pa.int32()), ("limit", pa.float64())])
_FOUND = pa.schema(
    [("key", pa.string()), ("column", pa.int32()), ("distance", pa.float64()), ("donor", pa.string()), ("value", pa.float64())]
)


def _search(requests: DataFrame, donors: DataFrame, xs: Sequence[str], k: int, first: bool) -> DataFrame:
    """The k best per (key, column) and leaf asked for: ``(key, column, distance, donor, value)``; first ``(key, column, limit)``."""
    # how many tasks search a leaf, from how many rows ask for it; as many rows as there are leaves
    tasks = F.ceil(F.count(F.lit(1)) / F.lit(float(ASKING_ROWS))).cast("int")
    asked = checked_broadcast(requests.groupBy("cell").agg(tasks.alias("tasks")))
    salted = requests.join(asked, "cell").withColumn("task", F.pmod(F.xxhash64("key"), "tasks").cast("int"))
    held = donors.join(asked, "cell")
    held = held.withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))

    group = ["cell", "task"]
    n = _tasks(requests)
    limit = [] if first else ["limit"]
    asking = salted.select(*group, "key", "column", *xs, *limit).repartition(n, *group)
    rows = held.select(*group, "key", *xs).repartition(n, *group)
    return (
        asking.groupBy(*group)
        .cogroup(rows.groupBy(*group))
        .applyInArrow(
            lambda left, right: _searched(left, right, xs, k, first),
            "key string, column int, limit double" if first else "key string, column int, distance double, donor string, value double",
        )
    )


def _estimates(receivers: DataFrame, donors: DataFrame, xs: Sequence[str], k: int) -> DataFrame:
    """``(key, column, estimate)`` for every missing value that has a row to learn from."""
    # rows equal in every column are equally far from anything: k of them are all that can matter
    copies = Window.partitionBy(*xs).orderBy("key")
    donors = donors.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k).drop("copy")
    placed, levels = _tree(donors, xs, k)
    leaves = reduce(DataFrame.unionByName, [level.where("leaf") for level in levels])
    leaves = leaves.limit(BROADCAST_ROWS + 1).collect()  # a row for each leaf
    missing = F.filter(F.array(*[F.when(F.col(x).isNull(), F.lit(i)) for i, x in enumerate(xs)]), lambda c: c.isNotNull())
    # an estimate finds its row by the key
    requests = receivers.where("key is not null").select("key", F.explode(missing).alias("column"), *xs)
    requests = written(requests.repartition(_tasks(receivers), "key"), "knn-requests")

    first = _search(_reach(requests, levels, leaves, xs, k, first=True), placed, xs, k, first=True)
    limits = first.groupBy("key", "column").agg(F.max("limit").alias("limit"))
    # no node of k rows to look at: at most k - 1 rows of each pattern can be asked
    limit = F.coalesce("limit", F.lit(float("inf"))).alias("limit")
    bounded = requests.join(limits, ["key", "column"], "left").select("key", "column", *xs, limit)
    found = _search(_reach(bounded, levels, leaves, xs, k, first=False), placed, xs, k, first=False)
    place = F.row_number().over(Window.partitionBy("key", "column").orderBy("distance", "donor"))
    best = found.withColumn("place", place).where(F.col("place") <= k)
    # written, or every pass over the filled table would search again
    return written(best.groupBy("key", "column").agg(F.avg("value").alias("estimate")), "knn-estimates")


def impute_knn(
    df: DataFrame, columns: Sequence[str], key: str, k: int = NEIGHBOURS, fit_on: DataFrame | None = None
) -> DataFrame:
    """Fill ``columns`` from the ``k`` nearest rows of ``fit_on`` (the table itself by default).

    ``key`` identifies a row. A value without any comparable row gets the column mean; a column without any value
    is dropped.
    """
    base = df if fit_on is None else fit_on
    means = fit_mean(base, columns)
    names = [c for c in columns if c in means]
    xs = [f"x{i}" for i in range(len(names))]
    everything = "1" * len(names)
    receivers = _vector(df, names, key).where(F.col("pattern") != everything)
    donors = _vector(base, names, key).where(F.col("pattern") != "0" * len(names))
    estimates = _estimates(receivers, donors, xs, k)
    wide = estimates.groupBy("key").agg(
        *[F.max(F.when(F.col("column") == i, F.col("estimate"))).alias(f"e{i}") for i in range(len(names))]
    )
    filled = {c: F.coalesce(finite(c), F.col(f"e{i}"), F.lit(means[c])) for i, c in enumerate(names)}
    joined = df.join(wide, df[key].cast("string") == wide["key"], "left") if key != "key" else df.join(
        wide.withColumnRenamed("key", "_key"), F.col(key).cast("string") == F.col("_key"), "left"
    )
    kept = [c for c in df.columns if c not in columns or c in means]
    return joined.select(*[filled[c].alias(c) if c in filled else df[c] for c in kept])
