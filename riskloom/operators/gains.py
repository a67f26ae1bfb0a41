"""Boosted trees over packed blocks of bins.

The trees are those of Spark's ``GBTClassifier``: thresholds from the same sample of rows, the variance of the residuals as
impurity, the mean as a leaf's value, the logistic loss. Without row or feature draws they are the same trees. Draws have the
same law, a row for a tree and features for a node, but are drawn by block and node, so they do not depend on partitions. Here the rows are binned once into
blocks of some 65,000, a byte a value, which are kept with the margin and the residual of each row. A tree takes a job a
level: tasks add up rows and residuals by (node, feature, bin), and only these sums reach the driver. Of two children the one
with fewer rows is added up; the other is the rest of its parent. The job that gives the rows their new margins also adds up
the next tree's root. Rows that fit one small block are boosted in one task by the same steps.

Residuals are whole multiples of a power of two, so sums do not depend on the order or the number of tasks. Equal gains go
to the first feature and bin.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.boost import BINS, Tree, _Counts
from riskloom.session import Scratch, delete_folder

#: Spark's defaults: bins of a feature and rows that its thresholds are looked for in.
MAX_BINS, SAMPLE_ROWS = 32, 10_000
#: Values in a block, and in the block of a fit in one task.
BLOCK_CELLS, TASK_CELLS = 1 << 20, 1 << 22
#: Sums of a level that the driver takes from the tasks; when there may be more, Spark adds them up over the tasks first.
DRIVER_CELLS = 1 << 20
#: Rounds after which the rows' margins are written, which bounds what a lost executor costs.
WRITTEN_ROUNDS = 10
#: Gains that are rounding errors.
NO_GAIN = float(np.finfo(float).eps)
#: The residual of a row that is not drawn for the tree.
NOT_DRAWN = np.iinfo(np.int32).min


@dataclass(frozen=True)
class Split:
    """A split of a tree's node (heap order), its gain a row and the rows of the node."""

    tree: int
    node: int
    feature: int
    threshold: float
    gain: float
    rows: int


@dataclass(frozen=True)
class Grown:
    """A finished tree: splits, and of each node (heap order) the mean residual, the rows and the sum of the residuals."""

    splits: list[Split]
    nodes: dict[int, tuple[float, int, float]]


@dataclass(frozen=True)
class Draws:
    """Shares of the rows for a tree and of the features for a node, and what a split needs."""

    rows: float = 1.0
    features: float = 1.0
    min_rows: int = 1
    min_gain: float = 0.0
    seed: int = 0


def gbt_importance(
    rows: DataFrame, label: str, n_features: int, rounds: int, max_depth: int, learning_rate: float, seed: int
) -> list[float]:
    """The importance of each cell of the vector ``features``: the gains of its splits times their rows, adding up to 1."""
    found = np.zeros(n_features)
    for s in gbt_splits(rows, label, n_features, rounds, max_depth, learning_rate, seed):
        found[s.feature] += s.gain * s.rows
    total = found.sum()
    return (found / total if total else found).tolist()


def gbt_splits(
    rows: DataFrame, label: str, n_features: int, rounds: int, max_depth: int, learning_rate: float, seed: int
) -> list[Split]:
    """The splits of all trees; ``rows`` have the vector ``features`` and the label 0 or 1."""
    n = _labelled(rows, label)
    if not n_features:
        return []
    with Scratch(rows.sparkSession, "gains") as scratch:
        small = n * n_features <= TASK_CELLS
        size = n if small else max(1, BLOCK_CELLS // n_features)
        blocks, fit = _begin(rows, label, n_features, n, size, rounds, max_depth, learning_rate, Draws(seed=seed), small)
        if small:
            found = blocks.mapInArrow(_in_one_task(fit), _SPLIT).collect()  # a row a split
            return [Split(**r.asDict()) for r in found]
        return [s for tree in _in_many_tasks(fit, blocks, n, size, scratch) for s in tree.splits]


def gbt_trees(
    rows: DataFrame, label: str, n_features: int, rounds: int, max_depth: int, learning_rate: float, draws: Draws
) -> list[Grown]:
    """All trees, of which the first weighs 1 and the others ``learning_rate``; ``rows`` as for ``gbt_splits``."""
    n = _labelled(rows, label)
    with Scratch(rows.sparkSession, "trees") as scratch:
        size = max(1, BLOCK_CELLS // n_features)
        blocks, fit = _begin(rows, label, n_features, n, size, rounds, max_depth, learning_rate, draws)
        return _in_many_tasks(fit, blocks, n, size, scratch)


def _labelled(rows: DataFrame, label: str) -> int:
    n, right = rows.agg(F.count(F.lit(1)), F.count_if(F.col(label).cast("double").isin(0.0, 1.0))).first()
    if not n or right < n:
        raise ValueError(f"training takes rows with the label 0 or 1; {n - right} of {n} have another or none")
    return n


def _begin(
    rows: DataFrame, label: str, n_features: int, n: int, size: int, rounds: int, max_depth: int, learning_rate: float,
    draws: Draws, one_task: bool = False,
) -> tuple[DataFrame, _Fit]:
    """The rows as blocks, and how trees are grown over them."""
    cuts = thresholds(rows, n_features, n, draws.seed)
    cells = rows.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"))
    blocks = (cells.coalesce(1) if one_task else cells).mapInArrow(_packed(cuts, size), _BLOCK)
    # sums of all rows are below 2^62, those of a block below 2^52
    unit = float(1 << min(28, 60 - n.bit_length(), 50 - size.bit_length()))
    return blocks, _Fit(cuts, rounds, max_depth, learning_rate, unit, draws)


# thresholds


def thresholds(rows: DataFrame, n_features: int, n: int, seed: int) -> list[np.ndarray]:
    """The thresholds that Spark's trees choose from, by feature: its quantiles in the sample that Spark draws."""
    spark, share = rows.sparkSession, min(1.0, max(MAX_BINS**2, SAMPLE_ROWS) / n)
    some = rows.select("features")
    if share < 1:
        jvm = spark.sparkContext._jvm
        drawn = some._jdf.toJavaRDD().sample(False, share, jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
        some = DataFrame(spark._jsparkSession.createDataFrame(drawn, some._jdf.schema()), spark)
    values = some.select(F.posexplode(vector_to_array("features")).alias("feature", "value"))
    counts = values.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))

    def cut(table: pa.Table) -> pa.Table:
        value, rows = (table.column(c).to_numpy() for c in ("value", "n"))
        found = _cuts(value, rows, share * n, min(MAX_BINS, n) - 1).tolist()
        return pa.table({"feature": table.column("feature")[:1], "cuts": pa.array([found], pa.list_(pa.float64()))})

    found = counts.groupBy("feature").applyInArrow(cut, "feature int, cuts array<double>").collect()  # a row a feature
    by_feature = {r["feature"]: np.array(r["cuts"], float) for r in found}
    return [by_feature.get(f, np.zeros(0)) for f in range(n_features)]


def _cuts(value: np.ndarray, rows: np.ndarray, expected: float, most: int) -> np.ndarray:
    """At most ``most`` thresholds between values, the nearest to equal shares of the ``expected`` rows.

    Zeros count for what the other values leave of the expected rows, as with Spark, whose vectors may be sparse.
    """
    other = value != 0
    value, rows = value[other], rows[other].astype(float)
    if not len(value):
        return np.zeros(0)
    zeros = expected - rows.sum()
    if zeros > NO_GAIN * rows.sum() * 100:
        value, rows = np.append(value, 0.0), np.append(rows, zeros)
    order = np.argsort(value)
    value, rows = value[order], rows[order]
    between = (value[:-1] + value[1:]) / 2
    if len(between) <= most:
        return between
    stride = expected / (most + 1)
    found, seen, target = [], rows[0], stride
    for i in range(1, len(value)):
        before, seen = seen, seen + rows[i]
        if abs(before - target) < abs(seen - target):
            found.append(between[i - 1])
            target += stride
    return np.array(found, float)


# blocks

_BLOCK = "bins binary, label binary"
_STATE = "block long, bins binary, label binary, margin binary, residual binary, sums binary"


def _packed(cuts: list[np.ndarray], size: int):
    """Batches of (x, y) as blocks of ``size`` rows, the last of a task smaller: bins by feature, labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0

        def packed() -> pa.RecordBatch:
            columns = [np.concatenate(c, axis=-1).tobytes() for c in zip(*kept)]
            return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], ["bins", "label"])

        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
            if not np.isfinite(x).all():
                raise ValueError("training takes finite features only")
            # a value at a threshold is in the bin before it
            bins = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)]).astype(np.uint8)
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int8)
            while len(y):
                part = size - n
                kept.append((bins[:, :part], y[:part]))
                n += len(kept[-1][1])
                bins, y = bins[:, part:], y[part:]
                if n == size:
                    yield packed()
                    kept, n = [], 0
        if kept:
            yield packed()

    return run


@dataclass
class _Block:
    """Rows of a block: its number, bins by feature, labels, and each row's margin and residual in units."""

    number: int
    bins: np.ndarray
    label: np.ndarray
    margin: np.ndarray
    residual: np.ndarray

    @classmethod
    def of(cls, row: dict) -> _Block:
        """A block as it is kept, or what a job reads of it."""
        residual = np.frombuffer(row["residual"], np.int32)
        label, margin = (np.frombuffer(row.get(c, b""), kind) for c, kind in (("label", np.int8), ("margin", np.float64)))
        return cls(row.get("block", 0), np.frombuffer(row["bins"], np.uint8).reshape(-1, len(residual)), label, margin, residual)

    @classmethod
    def new(cls, row: dict, unit: float) -> _Block:
        """Before the first tree, which is fitted to the labels themselves, as -1 and 1."""
        y = np.frombuffer(row["label"], np.int8)
        return cls.of(row | {"margin": bytes(8 * len(y)), "residual": ((y * 2 - 1) * unit).astype(np.int32).tobytes()})

    def draw(self, draws: Draws, number: int) -> None:
        """Leave the rows that are not drawn for a tree out of its sums."""
        if draws.rows < 1:
            rng = np.random.default_rng([draws.seed & 0xFFFFFFFFFFFFFFFF, number, self.number])
            self.residual = np.where(rng.random(len(self.residual)) < draws.rows, self.residual, np.int32(NOT_DRAWN))

    def nodes(self, tree: Tree, levels: int) -> np.ndarray:
        """The node of each row after ``levels`` splits, or the leaf that it ended in."""
        kind = np.min_scalar_type(len(tree.feature))
        found = np.zeros(len(self.residual), kind)
        for node in np.flatnonzero(tree.feature[: 2**levels - 1] >= 0).tolist():
            right = self.bins[tree.feature[node]] > tree.cut[node]
            # the children of i are 2 i + 1 and 2 i + 2; plain sums of whole columns beat lists of rows
            found += (found == node) * (right + kind.type(node + 1))
        return found

    def sums(self, tree: Tree | None, level: int, wanted: list[int], counts: _Counts | None = None) -> np.ndarray:
        """(residuals and rows) x wanted nodes of the level x features x bins."""
        counts, drawn = counts or _Counts(self.bins), self.residual != NOT_DRAWN
        parts = [np.flatnonzero(drawn)]
        if level:
            node = self.nodes(tree, level)
            parts = [np.flatnonzero((node == i) & drawn) for i in wanted]
        found = counts.sums(parts, self.residual, np.ones(len(self.residual)), np.arange(len(self.bins)))
        return found.astype(np.int64)

    def add(self, tree: Tree, weight: float, max_depth: int, unit: float) -> None:
        """Add a tree to the margins; what is left to fit is the loss's negative gradient."""
        self.margin = self.margin + (tree.value * weight)[self.nodes(tree, max_depth)]
        y = self.label * 2.0 - 1.0
        with np.errstate(over="ignore"):
            residual = 4.0 * y / (1.0 + np.exp(2.0 * y * self.margin))
        self.residual = np.round(residual * unit).astype(np.int32)


# growth

#: Sums of some nodes of the tree as it is: level, tree, nodes -> (residuals and rows) x nodes x features x bins
_Totals = Callable[[int, Tree, list[int]], np.ndarray]


@dataclass(frozen=True)
class _Fit:
    cuts: list[np.ndarray]
    rounds: int
    max_depth: int
    learning_rate: float
    unit: float
    draws: Draws = Draws()

    def weight(self, number: int) -> float:
        return self.learning_rate if number else 1.0

    def features(self, number: int, node: int) -> np.ndarray:
        """The features that a node of a tree may be split by."""
        n = len(self.cuts)
        if self.draws.features >= 1:
            return np.arange(n)
        rng = np.random.default_rng([self.draws.seed & 0xFFFFFFFFFFFFFFFF, number, node, 1])
        return np.sort(rng.permutation(n)[: math.ceil(self.draws.features * n)])

    def tree(self, number: int, totals: _Totals) -> tuple[Tree, Grown]:
        """Grow a tree level by level."""
        tree, splits, sums, nodes = Tree.empty(self.max_depth), [], {}, {}
        wanted, sister = [0], {}
        for level in range(self.max_depth):
            found = totals(level, tree, wanted)
            for i, node in enumerate(wanted):
                sums[node] = found[:, i]
                if node in sister:
                    sums[sister[node]] = sums[(node - 1) // 2] - found[:, i]
            if not level:
                nodes[0] = self._node(sums[0][:, 0].sum(axis=1))
                tree.value[0] = nodes[0][0]
            wanted, sister = [], {}
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                best = self._best(sums[node], self.features(number, node)) if node in sums else None
                if best is None:
                    continue
                f, cut, gain = best
                left = sums[node][:, f, : cut + 1].sum(axis=1)
                whole = sums[node][:, f].sum(axis=1)
                splits.append(Split(number, node, f, float(self.cuts[f][cut]), gain, int(whole[1])))
                tree.feature[node], tree.cut[node] = f, cut
                children = 2 * node + 1, 2 * node + 2
                for child, part in zip(children, (left, whole - left)):
                    nodes[child] = self._node(part)
                    tree.value[child] = nodes[child][0]
                small = int(whole[1] < 2 * left[1])
                wanted.append(children[small])
                sister[children[small]] = children[1 - small]
            if not wanted:
                break
        return tree, Grown(splits, nodes)

    def _node(self, sums: np.ndarray) -> tuple[float, int, float]:
        residuals, rows = (int(x) for x in sums)
        # no row may have been drawn
        return (float(residuals) / rows / self.unit if rows else 0.0), rows, residuals / self.unit

    def _best(self, sums: np.ndarray, features: np.ndarray) -> tuple[int, int, float] | None:
        """The feature and bin of the greatest loss of variance, and that loss."""
        s, n = np.cumsum(sums[:, features], axis=2)
        whole_s, whole_n = s[:, -1:], n[:, -1:]
        s_right, n_right = whole_s - s, whole_n - n
        some = (n >= max(self.draws.min_rows, 1)) & (n_right >= max(self.draws.min_rows, 1))
        apart = s / np.maximum(n, 1) / self.unit - s_right / np.maximum(n_right, 1) / self.unit
        gain = np.where(some, (n / whole_n) * (n_right / whole_n) * apart**2, -np.inf)
        f, cut = divmod(int(gain.argmax()), gain.shape[1])
        best = float(gain[f, cut])
        return (int(features[f]), cut, best) if best > NO_GAIN and best >= self.draws.min_gain else None


# the two ways

_SPLIT = "tree int, node int, feature int, threshold double, gain double, rows long"


def _in_one_task(fit: _Fit):
    """All trees over the one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block.new(row, fit.unit)
                counts = _Counts(block.bins)

                def totals(level: int, tree: Tree, nodes: list[int]) -> np.ndarray:
                    return block.sums(tree, level, nodes, counts)

                for number in range(fit.rounds):
                    tree, grown = fit.tree(number, totals)
                    block.add(tree, fit.weight(number), fit.max_depth, fit.unit)
                    yield pa.RecordBatch.from_pylist([vars(s) for s in grown.splits], _SPLIT_ARROW)

    return run


_SPLIT_ARROW = pa.schema(
    [("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("threshold", pa.float64()), ("gain", pa.float64()),
     ("rows", pa.int64())]
)


def _in_many_tasks(fit: _Fit, blocks: DataFrame, n: int, size: int, scratch: Scratch) -> list[Grown]:
    """A job a level over blocks of ``size`` of the ``n`` rows, which are kept in the executors' storage and written every
    few rounds."""
    n_features, found, spark = len(fit.cuts), [], blocks.sparkSession
    # numbered where they are made, then dealt out evenly
    tasks = min(-(-n // size), 2 * spark.sparkContext.defaultParallelism)
    blocks = scratch.table(blocks.withColumn("block", F.monotonically_increasing_id()).repartition(tasks), "blocks")
    # a block is megabytes; several in a batch only add copies
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    before, state, kept = None, blocks.mapInArrow(_begun(fit), _STATE).persist(), []

    def totals(level: int, tree: Tree, nodes: list[int]) -> np.ndarray:
        source = state.select("bins", "residual") if level else state.select("sums")
        cells = source.mapInArrow(_level(tree, level, nodes, n_features), "cell int, residual long, n long")
        if tasks * n_features * MAX_BINS * len(nodes) > DRIVER_CELLS:
            cells = cells.groupBy("cell").agg(F.sum("residual").alias("residual"), F.sum("n").alias("n"))
        found = cells.toArrow()  # (node, feature, bin) of each task, or of all
        sums = np.zeros((2, len(nodes) * n_features * BINS), np.int64)
        for side, name in enumerate(("residual", "n")):
            np.add.at(sums[side], found.column("cell").to_numpy(), found.column(name).to_numpy())
        return sums.reshape(2, len(nodes), n_features, BINS)

    try:
        for number in range(fit.rounds):
            tree, grown = fit.tree(number, totals)
            found.append(grown)
            if before is not None:
                before.unpersist()  # the rows have moved on
            rows = state.select("block", "bins", "label", "margin", "residual")
            before, state = state, rows.mapInArrow(_added(fit, tree, number), _STATE)
            if (number + 1) % WRITTEN_ROUNDS == 0 and number + 1 < fit.rounds:
                kept.append(scratch.path("margins"))
                state.write.parquet(kept[-1])
                state = spark.read.schema(state.schema).parquet(kept[-1])
                for path in kept[:-1]:
                    delete_folder(spark, path)
            state.persist()  # made by the next job that reads it
    finally:
        for one in (before, state):
            if one is not None:
                one.unpersist()
    return found


def _states(blocks: Iterator[_Block]) -> Iterator[pa.RecordBatch]:
    for b in blocks:
        sums = b.sums(None, 0, [0])
        columns = [pa.array([x.tobytes()], pa.binary()) for x in (b.bins, b.label, b.margin, b.residual, sums)]
        columns = [pa.array([b.number], pa.int64()), *columns]
        yield pa.RecordBatch.from_arrays(columns, ["block", "bins", "label", "margin", "residual", "sums"])


def _begun(fit: _Fit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def begun() -> Iterator[_Block]:
            for batch in batches:
                for row in batch.to_pylist():
                    block = _Block.new(row, fit.unit)
                    block.draw(fit.draws, 0)
                    yield block

        yield from _states(begun())

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for r in batch.to_pylist():
            yield _Block.of(r)


def _added(fit: _Fit, tree: Tree, number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def moved() -> Iterator[_Block]:
            for block in _blocks(batches):
                block.add(tree, fit.weight(number), fit.max_depth, fit.unit)
                block.draw(fit.draws, number + 1)
                yield block

        yield from _states(moved())

    return run


def _level(tree: Tree, level: int, nodes: list[int], n_features: int):
    """A task's residuals and rows by cell, which is (place of the node, feature, bin)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(nodes), n_features, BINS), np.int64)
        if level:
            for block in _blocks(batches):
                total += block.sums(tree, level, nodes)
        else:  # the root's sums are known
            for batch in batches:
                for sums in batch.column("sums").to_pylist():
                    total += np.frombuffer(sums, np.int64).reshape(total.shape)
        residual, n = total.reshape(2, -1)
        cell = np.flatnonzero(n)
        columns = [pa.array(cell, pa.int32()), pa.array(residual[cell]), pa.array(n[cell])]
        yield pa.RecordBatch.from_arrays(columns, ["cell", "residual", "n"])

    return run
