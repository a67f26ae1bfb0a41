"""Global shuffle of a table into shards: a two-pass external shuffle, in DataFrame operations alone.

Pass one scatters the rows by a seeded hash into buckets small enough for memory. Pass two brings each bucket together in
the order of that hash, runs a Fisher-Yates shuffle over it and writes it. The numbers of rows of the buckets, one each,
then give every row its place in the whole order, and shards are equal stretches of it, so their counts differ by one at
most (law ``rows``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import Scratch, checked_broadcast

SHARDS = 8
BUCKET_BYTES = 8 << 20
SEED = 20_240_611
#: Buckets summed in one window.
PART = 10_000


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(row, shard, slot)``: the columns of ``docs(doc_id, text, …)``, its shard from 0 and its place there from 0.

    - null ids and texts are hashed like values; the text counts 0 bytes toward bucket sizes;
    - repeated rows and hot ids: rows are told apart by their place in the input too, so they scatter like others;
    - a text larger than a bucket makes its bucket larger by that text;
    - fewer rows than shards: some shards are empty; no rows: no rows; column names are free, as rows stay nested.
    """
    spark = docs.sparkSession
    with Scratch(spark, "sharding") as scratch:
        size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
        total = docs.agg(F.sum(size)).first()[0] or 0
        buckets = max(shards, -(-int(total) // bucket_bytes))
        rows = docs.select(F.struct(*docs.columns).alias("row"))
        h = F.xxhash64(F.lit(seed), "row.doc_id", F.monotonically_increasing_id())
        scattered = rows.withColumn("h", h).withColumn("bucket", F.pmod(F.xxhash64(F.lit(~seed), "h"), F.lit(buckets)))
        scattered = scattered.repartition(buckets, "bucket").sortWithinPartitions("bucket", "h")
        drawn = scattered.groupBy("bucket").agg(F.shuffle(F.collect_list("row"), seed).alias("rows"))
        drawn = scratch.table(drawn.select("bucket", F.posexplode("rows").alias("at", "row")), "buckets")

        # running sums in two steps, so that no task orders all buckets
        counts = scratch.table(drawn.groupBy("bucket").count().withColumn("part", F.expr(f"bucket div {PART}")), "counts")
        before = lambda *keys: F.coalesce(
            F.sum("count").over(Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        )
        parts = counts.groupBy("part").agg(F.sum("count").alias("count")).select("part", before("part").alias("start"))
        counts = counts.withColumn("within", before("part", "bucket")).join(F.broadcast(parts), "part")
        counts = counts.select("bucket", (F.col("start") + F.col("within")).alias("before"))
        n = drawn.count()
        place = drawn.join(checked_broadcast(counts), "bucket").select(
            "row", (F.col("before") + F.col("at")).alias("place")
        )
        # shard s holds the places from ceil(s n / shards) on
        shard = F.expr(f"(place * {shards}) div {max(n, 1)}")
        first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
        placed = place.withColumn("shard", shard).withColumn("slot", F.col("place") - first)
        return scratch.result(placed.select("row", F.col("shard").cast("int").alias("shard"), "slot"))
