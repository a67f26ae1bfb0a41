"""Gapless ranks over a whole table without one task that sees it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import Scratch


def ranked(df: DataFrame, order: list[str], name: str, scratch: Scratch) -> DataFrame:
    """``df`` with a gapless ``name`` from 0 in ``order``, whose columns should tell rows apart; nulls come first.

    Rows are dealt to ranges of the order and sorted there; the number of rows of each range (as many numbers as
    partitions) gives the ranges their offsets.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    local = F.monotonically_increasing_id()
    dealt = scratch.table(dealt.withColumn("__range", F.shiftright(local, 33)).withColumn("__at", local), "ranked")
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted((r[0], r[1]) for r in dealt.groupBy("__range").count().collect())
    offset, total = {}, 0
    for key, count in counts:
        offset[key] = total
        total += count
    if not offset:
        return dealt.withColumn(name, place).drop("__range", "__at")
    offsets = F.broadcast(spark.createDataFrame(list(offset.items()), "__range long, __offset long"))
    return dealt.join(offsets, "__range").withColumn(name, F.col("__offset") + place).drop(
        "__range", "__at", "__offset"
    )
