"""Mixing sources to target weights by repetition rates.

Sizes are summed per source, each source's target divided by its size is its rate, and a document is emitted
``floor(rate)`` times plus once more with the probability of the rest, by a draw that a hash of seed and id decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.ranks import ranked
from riskloom.llm.texts import n_words
from riskloom.session import Scratch, checked_broadcast

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
SEED = "mix-1"


def draw(seed: str, doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of a digest of seed and id, or of the text where the id is null."""
    key = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 8), 16, 10).cast("double") / 2.0**32


def targets(sources: DataFrame, scratch: Scratch, most: int = MOST_REPEATS) -> DataFrame:
    """Add ``target`` to ``sources(source, source_size, weight)``: all sizes shared by weight.

    No target passes ``most`` times its source's size; what is above goes to the others by weight until none is. Each
    round sums over the sources on the executors and brings three numbers back.
    """
    sources = scratch.table(sources.withColumn("most", F.lit(most) * F.col("source_size")), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        above = F.col("most") <= F.lit(level) * F.col("weight")
        capped, count, weight = sources.agg(
            F.sum(F.when(above, F.col("most")).otherwise(0)),
            F.count(F.when(above, 1)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))),
        ).first()
        if not weight or count == full:
            break
        level, full = (total - capped) / weight, count
    share = F.least(F.col("most").cast("double"), F.lit(level) * F.col("weight"))
    return sources.withColumn("target", share).drop("most")


def weights_by_rank(sources: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Weights in turn over the sources by code point, null last."""
    order = sources.withColumn("last", F.col("source").isNull())
    at = F.col("rank") % len(weights) + 1
    numbered = ranked(order, ["last", "source"], "rank", scratch).drop("last")
    return numbered.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), at.cast("int"))).drop("rank")


def rates(docs: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(row, mix)`` for every row of ``docs(doc_id, text, source, …)``: its columns, and
    ``struct(size, source_size, target, copies)``.

    A size is the number of words (null text: 0). The target of a source is its share of all sizes. A rerun draws the
    same copies, as only seed and id decide; rows that repeat an id are drawn together, rows without one by their text.

    - null source: a source of its own, the last; a source of size 0: target 0 and no copies;
    - no rows: no rows; other columns stay as they are in ``row``.
    """
    with Scratch(docs.sparkSession, "mixing") as scratch:
        sizes = docs.groupBy("source").agg(F.sum(n_words(F.col("text"))).alias("source_size"))
        shares = targets(weights_by_rank(scratch.table(sizes, "sizes"), scratch, weights), scratch)
        shares = scratch.result(shares)
    share = F.struct("source_size", "target").alias("share")
    right = checked_broadcast(shares.select(F.struct("source").alias("key"), share))
    rows = docs.select(F.struct("source").alias("key"), F.struct(*docs.columns).alias("row"))
    rows = rows.join(right, "key", "left")
    rate = F.when(F.col("share.source_size") > 0, F.col("share.target") / F.col("share.source_size")).otherwise(0.0)
    again = (draw(seed, F.col("row.doc_id"), F.col("row.text")) < rate - F.floor(rate)).cast("long")
    mix = (n_words(F.col("row.text")).alias("size"), "share.source_size", "share.target")
    return rows.select("row", F.struct(*mix, (F.floor(rate) + again).alias("copies")).alias("mix"))


def emit(docs: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Every document as often as the mix takes it, in the columns of ``docs``."""
    taken = rates(docs, seed, weights).where("mix.copies > 0")
    copies = F.explode(F.array_repeat(F.lit(0), F.col("mix.copies").cast("int")))
    return taken.select("row", copies).select("row.*")
