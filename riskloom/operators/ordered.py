"""Distributed running sums over a sorted column.

AUC, the curves, KS, Wasserstein and exact quantiles all need a global order. A window without a partition key
would send every row to one task, so the order is built in two levels instead:

1. rows are grouped by value, which folds ties and hot values into one row each before the shuffle; the grouped
   table is written once and everything after reads that;
2. cut points from a quantile sketch of the distinct values put each value into a bucket (they only balance the work,
   they never change a result);
3. bucket totals (groups x buckets rows, a bounded table) give each bucket its offset;
4. a window inside each bucket adds the local running sum.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.session import checked_broadcast, written

MAX_BUCKETS = 1000


def bucket_count(spark: SparkSession) -> int:
    """One bucket per shuffle partition, within fixed limits."""
    return max(8, min(MAX_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def finite(name: str) -> Column:
    """The column as double, with NaN read as missing."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def cut_points(df: DataFrame, columns: Sequence[str], buckets: int | None = None) -> dict[str, list[float]]:
    """Splits for each column from one sketch job; only ``columns`` are read."""
    n = buckets or bucket_count(df.sparkSession)
    probabilities = [i / n for i in range(1, n)]
    names = [f"c{i}" for i in range(len(columns))]
    values = df.select(*[finite(c).alias(a) for c, a in zip(columns, names)])
    sketched = values.stat.approxQuantile(names, probabilities, 0.5 / n)
    inf = float("inf")
    return {c: [-inf, *sorted({v for v in q if abs(v) != inf}), inf] for c, q in zip(columns, sketched)}


def with_bucket(df: DataFrame, value: str, splits: list[float], bucket: str = "bucket") -> DataFrame:
    return Bucketizer(splits=splits, inputCol=value, outputCol=bucket, handleInvalid="keep").transform(df)


def bucketed_long(
    df: DataFrame, cuts: dict[str, list[float]], keep: Sequence[str] = (), held: dict[str, list[int]] | None = None
) -> DataFrame:
    """``(keep…, feature, bucket, value)`` for the columns in ``cuts``; missing values are left out, and with ``held`` all
    that are in other buckets of their column."""
    columns = list(cuts)
    wide = df.select(*keep, *[finite(c).alias(f"v{i}") for i, c in enumerate(columns)])
    wide = Bucketizer(
        splitsArray=[cuts[c] for c in columns],
        inputCols=[f"v{i}" for i in range(len(columns))],
        outputCols=[f"b{i}" for i in range(len(columns))],
        handleInvalid="keep",
    ).transform(wide)

    def value(i: int, c: str) -> Column:
        return F.col(f"v{i}") if held is None else F.when(F.col(f"b{i}").isin(held.get(c, [])), F.col(f"v{i}"))

    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(f"b{i}").cast("int").alias("bucket"), value(i, c).alias("value"))
        for i, c in enumerate(columns)
    ]
    return wide.select(*keep, F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def _bucketed(freq: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    n = bucket_count(freq.sparkSession)
    sketch = F.percentile_approx(value, [i / n for i in range(1, n)], 10 * n)
    if groups:
        # one list of cut points per group; groups are features, sides or rounds, never row data
        cuts = freq.groupBy(*groups).agg(sketch.alias("cuts"))
        placed = freq.join(F.broadcast(cuts), list(groups))
    else:
        placed = freq.withColumn("cuts", freq.agg(sketch).scalar())
    # the number of cuts below the value: whole steps of the rising cuts first, then the cuts of the step it falls in
    step = max(1, math.isqrt(n))
    steps = F.col("_steps") * step
    coarse = F.transform(F.sequence(F.lit(step), F.lit(n - 1 - (n - 1) % step), F.lit(step)), lambda i: F.get("cuts", i - 1))
    placed = placed.withColumn("_steps", F.size(F.filter(coarse, lambda c: c < F.col(value))))
    fine = F.filter(F.slice("cuts", steps + 1, F.lit(step)), lambda c: c < F.col(value))
    return placed.withColumn("bucket", steps + F.size(fine)).drop("cuts", "_steps")


def prefix_sums(
    freq: DataFrame, groups: Sequence[str], value: str, sums: Sequence[str], neighbours: bool = False
) -> DataFrame:
    """Adds ``<s>_below`` (sum over smaller values of the group) and ``<s>_total`` for each of ``sums``.

    ``freq`` has one row per (groups, value). With ``neighbours`` it also adds ``previous`` and ``next``: the
    (value, sums…) of the adjacent rows, across bucket borders.
    """
    keys = [*groups, "bucket"]
    freq = _bucketed(written(freq, "frequencies"), groups, value)
    point = F.struct(F.col(value).alias("value"), *[F.col(s) for s in sums])
    folded = [F.sum(s).alias(f"{s}_in") for s in sums]
    if neighbours:
        folded += [F.min(point).alias("first_point"), F.max(point).alias("last_point")]
    per_bucket = freq.groupBy(*keys).agg(*folded)

    by_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    by_bucket = by_group.orderBy("bucket")
    earlier = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    added = [F.coalesce(F.sum(f"{s}_in").over(earlier), F.lit(0)).alias(f"{s}_offset") for s in sums]
    added += [F.sum(f"{s}_in").over(by_group).alias(f"{s}_total") for s in sums]
    if neighbours:
        added += [
            F.lag("last_point").over(by_bucket).alias("bucket_before"),
            F.lead("first_point").over(by_bucket).alias("bucket_after"),
        ]
    # bounded: at most MAX_BUCKETS + 1 rows per group, whatever the size of the table
    offsets = F.broadcast(per_bucket.select(*keys, *added))

    in_bucket = Window.partitionBy(*keys).orderBy(value)
    smaller = in_bucket.rowsBetween(Window.unboundedPreceding, -1)
    local = [F.coalesce(F.sum(s).over(smaller), F.lit(0)).alias(f"{s}_local") for s in sums]
    if neighbours:
        local += [F.lag(point).over(in_bucket).alias("before"), F.lead(point).over(in_bucket).alias("after")]
    out = [*groups, value, *sums]
    out += [(F.col(f"{s}_offset") + F.col(f"{s}_local")).alias(f"{s}_below") for s in sums]
    out += [f"{s}_total" for s in sums]
    if neighbours:
        out += [F.coalesce("before", "bucket_before").alias("previous"), F.coalesce("after", "bucket_after").alias("next")]
    return freq.select(*keys, value, *sums, *local).join(offsets, keys).select(*out)


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "place") -> DataFrame:
    """Adds the row's place from 1 in the order, which must be strict.

    Rows are put into ranges of the order and written with the number of their range, so that the numbers hold
    whatever runs again; places inside a range follow from the rows of the ranges before it (a row per range).
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged = written(ranged, "ranged")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    # bounded: a row per shuffle partition
    placed = ranged.withColumn("_local", local).join(F.broadcast(offsets), "_range")
    return placed.select(*df.columns, (F.col("_offset") + F.col("_local")).alias(name))


def value_counts_by_side(df: DataFrame, columns: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """``(feature, value, sums…)``: the shared frame behind the distribution distances; missing values are left out.

    ``sums`` maps an output name to a 0/1 column of ``df``.
    """
    flags = [e.alias(f"_{n}") for n, e in sums.items()]
    names = [f"_{n}" for n in sums]
    wide = df.select(*flags, *[finite(c).alias(c) for c in columns])
    long = wide.unpivot(names, list(columns), "feature", "value").where(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(*[F.sum(f"_{n}").cast("bigint").alias(n) for n in sums])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles, ``(feature, prob, quantile)``, exact at any size.

    Bucket counts (map-side combined) tell which buckets hold the wanted ranks; only the values in those buckets
    are shuffled and ordered, about one bucket of rows per wanted rank.
    """
    cuts = cut_points(df, columns)

    def within(buckets: DataFrame) -> DataFrame:
        held: dict[str, list[int]] = {}
        for row in buckets.collect():  # at most two rows per column and probability
            held.setdefault(row["feature"], []).append(row["bucket"])
        return bucketed_long(df, {c: cuts[c] for c in columns if c in held} or cuts, held=held)

    return _quantiles_from(bucketed_long(df, cuts), ["feature"], probabilities, within)


def _quantiles_from(
    long: DataFrame,
    groups: list[str],
    probabilities: Sequence[float],
    within: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Quantiles of ``long``; ``within`` gives its rows of some buckets, where that takes less than a join."""
    keys = [*groups, "bucket"]
    counts = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    by_group = Window.partitionBy(*groups)
    earlier = by_group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *keys,
        "n",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
        F.sum("n").over(by_group).alias("total"),
    )
    wanted = counts.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("prob"))
    rank = (F.col("total") - 1) * F.col("prob")
    wanted = wanted.select(
        *keys,
        "offset",
        "n",
        "prob",
        F.floor(rank).alias("low_rank"),
        F.ceil(rank).alias("high_rank"),
        (rank - F.floor(rank)).alias("part"),
    )

    def inside(r: str, start: Column, n: Column) -> Column:
        return (F.col(r) >= start) & (F.col(r) < start + n)

    held = inside("low_rank", F.col("offset"), F.col("n")) | inside("high_rank", F.col("offset"), F.col("n"))
    # at most two rows per group and probability, fetched once for both uses
    wanted = checked_broadcast(wanted.where(held).drop("n"))
    buckets = wanted.select(*keys).distinct()
    kept = within(buckets) if within else long.join(F.broadcast(buckets), keys)
    detail = kept.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    smaller = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    detail = detail.withColumn("local", F.coalesce(F.sum("n").over(smaller), F.lit(0)))
    hit = detail.join(wanted, keys).withColumn("start", F.col("offset") + F.col("local"))
    ends = hit.groupBy(*groups, "prob").agg(
        F.max(F.when(inside("low_rank", F.col("start"), F.col("n")), F.col("value"))).alias("low"),
        F.max(F.when(inside("high_rank", F.col("start"), F.col("n")), F.col("value"))).alias("high"),
        F.max("part").alias("part"),
    )
    return ends.select(*groups, "prob", (F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("quantile"))


def quantile_dict(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, dict[float, float]]:
    """The quantiles on the driver: one number per column and probability."""
    found: dict[str, dict[float, float]] = {c: {} for c in columns}
    for row in exact_quantiles(df, columns, probabilities).collect():
        found[row["feature"]][row["prob"]] = row["quantile"]
    return found
