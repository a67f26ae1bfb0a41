"""Distributions laid out once in parts, so that many small tables can be compared with them.

The distinct values of each feature are cut into parts of equal length in their order. A part is a folder of
(value, count) rows and one row of a small table: what lies before it, its shares at both ends, and the area below its
cumulative curve. Where the other side is constant over a part and its level does not cross the part's own curve, the
distance over the part follows from that row alone; only the other parts are opened.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ordered import bucketed_long, global_rank, prefix_sums
from riskloom.session import work_path, written

#: Distinct values of a part: what a new value makes a comparison read, against the length of the table of parts.
PART_VALUES = 100_000


@dataclass(frozen=True)
class Distribution:
    """``values`` is (feature, value, ref, part), a folder for each part, ``parts`` a row for each part, and ``starts`` the
    first value of every part of a feature, with ``first_part`` the number of its first one."""

    values: DataFrame
    parts: DataFrame
    starts: dict[str, list[float]]
    first_part: dict[str, int]


def lay_out(freq: DataFrame, part_values: int = PART_VALUES) -> Distribution:
    """``freq`` is (feature, value, ref), a row for each value of a feature; without rows no feature has parts."""
    spark = freq.sparkSession
    placed = global_rank(freq, [F.col("feature"), F.col("value")])
    # a row for each feature
    spans = placed.groupBy("feature").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    first_part, rows, parts_before = {}, [], 0
    for r in sorted(spans, key=lambda r: r["feature"]):
        first_part[r["feature"]] = parts_before
        rows.append((r["feature"], r["first"], parts_before))
        parts_before += -(-r["n"] // part_values)
    spans = F.broadcast(spark.createDataFrame(rows, "feature string, first bigint, base bigint"))
    part = F.col("base") + F.floor((F.col("place") - F.col("first")) / part_values)
    cut = placed.join(spans, "feature").select("feature", "value", "ref", part.cast("bigint").alias("part"))
    path = work_path(spark, "reference-values")
    cut.repartition("part").sortWithinPartitions("part", "value").write.partitionBy("part").parquet(path)
    values = spark.read.schema(cut.schema).parquet(path) if rows else cut
    parts = written(_measured(values), "reference-parts")
    starts: dict[str, list[float]] = {c: [] for c in first_part}
    for r in parts.select("feature", "part", "first_value").orderBy("part").collect():  # a number for each part
        starts[r["feature"]].append(r["first_value"])
    return Distribution(values, parts, starts, first_part)


def _measured(values: DataFrame) -> DataFrame:
    keys = ["feature", "part"]
    sums = values.groupBy(*keys).agg(
        F.sum("ref").alias("n_ref"), F.min("value").alias("first_value"), F.max("value").alias("last_value")
    )
    by_part = Window.partitionBy("feature").orderBy("part")
    parts = sums.select(
        "*",
        F.coalesce(F.sum("n_ref").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n_ref").over(Window.partitionBy("feature")).alias("total"),
        F.coalesce(F.lead("first_value").over(by_part), "last_value").alias("end"),
    )
    inside = Window.partitionBy(*keys).orderBy("value")
    reached = F.sum("ref").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    points = values.select(*keys, "value", reached.alias("reached"), F.lead("value").over(inside).alias("next"))
    points = points.join(parts, keys).withColumn("share", (F.col("before") + F.col("reached")) / F.col("total"))
    areas = points.groupBy(*keys).agg(
        F.min("share").alias("first_share"),
        F.max("share").alias("last_share"),
        F.sum(F.col("share") * (F.coalesce("next", "end") - F.col("value"))).alias("area"),
    )
    return parts.select(*keys, "n_ref", "first_value", "last_value", "end").join(areas, keys)


def _placed(reference: Distribution, current: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(feature, part, value, cur)``: the distinct values of ``current`` and the part that each falls in."""
    most = sys.float_info.max
    # a value below the first part belongs to it
    cuts = {c: [-float("inf"), *[min(max(s, -most), most) for s in reference.starts[c]], float("inf")] for c in names}
    first = F.create_map(*[F.lit(x) for c in names for x in (c, reference.first_part[c])])
    part = F.try_element_at(first, F.col("feature")) + F.greatest(F.col("bucket") - 1, F.lit(0))
    long = bucketed_long(current, cuts).select("feature", part.cast("bigint").alias("part"), "value")
    return long.groupBy("feature", "part", "value").agg(F.count(F.lit(1)).alias("cur"))


def part_states(reference: Distribution, counted: DataFrame, names: Sequence[str]) -> DataFrame:
    """The parts of ``names`` with the other side's share before each (``level``), and whether the part must be
    ``opened``: a new value falls in it, or the level crosses its curve. ``level`` is null without new values."""
    per_part = counted.groupBy("feature", "part").agg(F.sum("cur").alias("n_cur"))
    parts = reference.parts.where(F.col("feature").isin(list(names)))
    parts = parts.join(per_part, ["feature", "part"], "left").fillna(0, ["n_cur"])
    earlier = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("n_cur").over(Window.partitionBy("feature"))
    level = F.coalesce(F.sum("n_cur").over(earlier), F.lit(0)) / F.nullif(total, F.lit(0))
    crossed = (F.col("level") > F.col("first_share")) & (F.col("level") < F.col("last_share"))
    unbounded = F.col("area").isNull() | F.isnan("area") | (F.abs("area") == float("inf"))
    opened = F.col("level").isNotNull() & ((F.col("n_cur") > 0) | crossed | unbounded)
    return parts.withColumn("level", level).withColumn("opened", opened)


def distances(reference: Distribution, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, ks, wasserstein, ref_range)`` between the laid-out reference and ``current``; a feature without
    reference values has no row, one without current values nulls. Reads the table of parts and the opened parts."""
    names = [c for c in columns if c in reference.starts]
    if not names:
        return current.sparkSession.createDataFrame([], "feature string, ks double, wasserstein double, ref_range double")
    counted = written(_placed(reference, current, names), "arrived")
    states = written(part_states(reference, counted, names), "part-states")
    opened = [r["part"] for r in states.where("opened").select("part").collect()]  # a number for each part at most
    whole = states.where(~F.col("opened"))

    def side(df: DataFrame, ref: Column, cur: Column, value: str = "value", closed: int = 0) -> DataFrame:
        counts = [ref.cast("bigint").alias("ref"), cur.cast("bigint").alias("cur"), F.lit(closed).alias("closed")]
        return df.select("feature", F.col(value).alias("value"), *counts)

    zero = F.lit(0)
    freq = side(reference.values.where(F.col("part").isin(opened)), F.col("ref"), zero)
    freq = freq.unionByName(side(counted, zero, F.col("cur")))
    # a closed part stands in the order as one point that carries all its rows
    freq = freq.unionByName(side(whole, F.col("n_ref"), zero, "first_value", 1))
    sums = ["ref", "cur", "closed"]
    freq = freq.groupBy("feature", "value").agg(*[F.sum(s).alias(s) for s in sums])
    points = prefix_sums(freq, ["feature"], "value", sums, neighbours=True).where(F.col("closed") == 0)

    def reached(s: str) -> Column:
        return (F.col(f"{s}_below") + F.col(s)) / F.nullif(F.col(f"{s}_total"), F.lit(0))

    gap = F.abs(reached("ref") - reached("cur"))
    width = F.col("next.value") - F.col("value")
    near = points.select("feature", gap.alias("ks"), F.coalesce(gap * width, gap * 0).alias("wasserstein"))
    ends = [F.abs(F.col(s) - F.col("level")) for s in ("first_share", "last_share")]
    below = F.abs(F.col("area") - F.col("level") * (F.col("end") - F.col("first_value")))
    far = whole.select("feature", F.greatest(*ends).alias("ks"), below.alias("wasserstein"))
    found = near.unionByName(far).groupBy("feature").agg(F.max("ks").alias("ks"), F.sum("wasserstein").alias("wasserstein"))
    ranges = states.groupBy("feature").agg((F.max("last_value") - F.min("first_value")).alias("ref_range"))
    return found.join(ranges, "feature")
