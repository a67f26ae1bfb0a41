"""The data behind the evaluation curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.metrics import ratio_or_zero, score_frequencies
from riskloom.operators.ordered import exact_quantiles, finite
from riskloom.session import checked_broadcast

SWEEP_START, SWEEP_STEP, SWEEP_POINTS = 0.01, 0.02, 50


def roc_curve(df: DataFrame, label: str, score: str, drop_intermediate: bool = False) -> DataFrame:
    """``(fpr, tpr, threshold)`` per distinct score, with (0, 0) at an infinite threshold.

    ``drop_intermediate`` leaves out the points that continue the line between their neighbours in equal steps.
    """
    freq = score_frequencies(df, label, score, neighbours=True)
    points = freq.select(
        ratio_or_zero(F.col("neg_total") - F.col("neg_below"), F.col("neg_total")).alias("fpr"),
        ratio_or_zero(F.col("pos_total") - F.col("pos_below"), F.col("pos_total")).alias("tpr"),
        F.col("score").alias("threshold"),
        "pos",
        "neg",
        "previous",
        "next",
    )
    start = F.struct(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    own = F.struct("fpr", "tpr", "threshold")
    if drop_intermediate:
        # the step that follows on the way down is the next smaller score
        same_step = (F.col("previous.pos") == F.col("pos")) & (F.col("previous.neg") == F.col("neg"))
        points = points.where(F.col("previous").isNull() | F.col("next").isNull() | ~same_step)
    # the highest score carries the starting point, so the curve needs no second pass
    return points.select(F.inline(F.when(F.col("next").isNull(), F.array(start, own)).otherwise(F.array(own))))


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """``(precision, recall, threshold, baseline)`` per distinct score, ending at (1, 0) without a threshold."""
    freq = score_frequencies(df, label, score, neighbours=True)
    tp = F.col("pos_total") - F.col("pos_below")
    fp = F.col("neg_total") - F.col("neg_below")
    baseline = ratio_or_zero(F.col("pos_total"), F.col("pos_total") + F.col("neg_total")).alias("baseline")
    own = F.struct(
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, F.col("pos_total")).alias("recall"),
        F.col("score").alias("threshold"),
        baseline,
    )
    end = F.struct(
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        F.lit(None).cast("double").alias("threshold"),
        baseline,
    )
    return freq.select(F.inline(F.when(F.col("next").isNull(), F.array(own, end)).otherwise(F.array(own))))


def calibration_curve(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean score and share of defaults per equal-width bin; an edge belongs to the bin below it."""
    p = F.col(score)
    inner = [i * (1.0 / bins) for i in range(1, bins)]
    bin_of = sum(((p > edge).cast("int") for edge in inner[1:]), (p > inner[0]).cast("int"))
    return (
        df.where(p.isNotNull())
        .groupBy(bin_of.alias("bin"))
        .agg(
            F.avg(p).alias("mean_predicted"),
            F.avg(F.col(label).cast("double")).alias("fraction_positive"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )


def equal_width_bin(value: Column, low: Column, high: Column, bins: int | Column) -> Column:
    """Bin number 0 … bins-1 over [low, high]; the last bin is closed, a single-value range uses one middle bin."""
    n = F.lit(bins).cast("int")
    cell = F.floor((value - low) * n.cast("double") / (high - low)).cast("int")
    return F.when(high > low, F.least(cell, n - 1)).otherwise(F.floor(n / 2).cast("int"))


def automatic_bins(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(feature, bins)``: the finer of the widths by Freedman and Diaconis (from the quartiles) and by Sturges (from the
    number of values); without a spread of the quartiles the latter, for a single value one bin."""
    ends = df.select(*[finite(c).alias(c) for c in columns]).unpivot([], columns, "feature", "value")
    ends = ends.where(F.col("value").isNotNull()).groupBy("feature")
    ends = ends.agg(F.count(F.lit(1)).alias("n"), (F.max("value") - F.min("value")).alias("range"))
    quartiles = exact_quantiles(df, columns, [0.25, 0.75]).groupBy("feature")
    spread = quartiles.agg((F.max("quantile") - F.min("quantile")).alias("spread"))
    sturges = F.col("range") / (F.log2("n") + 1)
    narrow = 2 * F.col("spread") / F.pow(F.col("n"), F.lit(1 / 3))
    width = F.when(F.col("spread") > 0, F.least(narrow, sturges)).otherwise(sturges)
    bins = F.when(F.col("range") > 0, F.ceil(F.col("range") / width).cast("int")).otherwise(F.lit(1))
    return ends.join(spread, "feature").select("feature", bins.alias("bins"))


def histogram(
    df: DataFrame, columns: list[str], bins: int | str = "auto", by: str | None = None, range_per_group: bool = False
) -> DataFrame:
    """Counts per equal-width bin: ``(feature[, by], bin, low_edge, high_edge, n_rows, share)``; with ``auto`` each
    feature has the number of bins that ``automatic_bins`` finds.

    Two aggregates: the ranges (one row per feature and group), then the counts. The range is shared by
    all groups unless ``range_per_group``; the share is within the group.
    """
    groups = [by] if by else []
    doubles = df.select(*groups, *[F.col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot(groups, columns, "feature", "value")
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    range_keys = ["feature", *(groups if range_per_group else [])]
    ranges = long.groupBy(*range_keys).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    # a row per feature
    wanted = automatic_bins(df, columns) if bins == "auto" else None
    ranges = ranges.join(wanted, "feature") if wanted is not None else ranges.withColumn("bins", F.lit(bins))
    placed = long.join(checked_broadcast(ranges), range_keys)
    counts = placed.groupBy(
        "feature", *groups, equal_width_bin(F.col("value"), F.col("low"), F.col("high"), F.col("bins")).alias("bin")
    ).agg(F.count(F.lit(1)).alias("n_rows"), *[F.first(c).alias(c) for c in ("low", "high", "bins")])
    # equal ends are widened by one half on both sides, as a one-value histogram has no width of its own
    flat = F.col("high") == F.col("low")
    low = F.when(flat, F.col("low") - 0.5).otherwise(F.col("low"))
    high = F.when(flat, F.col("high") + 0.5).otherwise(F.col("high"))
    width = (high - low) / F.col("bins").cast("double")
    return counts.select(
        "feature",
        *groups,
        "bin",
        (low + F.col("bin") * width).alias("low_edge"),
        (low + (F.col("bin") + 1) * width).alias("high_edge"),
        "n_rows",
        (F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy("feature", *groups))).alias("share"),
    )


def score_histogram(df: DataFrame, label: str, score: str, bins: int = 30) -> DataFrame:
    """Score counts by class; each class is binned over its own range."""
    return histogram(df, [score], bins, by=label, range_per_group=True).drop("feature")


def _thresholds_reached(p: Column) -> Column:
    """How many of the sweep's thresholds a score reaches, by arithmetic and one exact comparison either way."""

    def threshold(k: Column) -> Column:
        return F.lit(SWEEP_START) + k * F.lit(SWEEP_STEP)

    guess = F.floor((p - SWEEP_START) / SWEEP_STEP).cast("int") + 1
    guess = F.greatest(F.lit(0), F.least(F.lit(SWEEP_POINTS), guess))
    return (
        F.when((guess < SWEEP_POINTS) & (threshold(guess) <= p), guess + 1)
        .when((guess > 0) & (threshold(guess - 1) > p), guess - 1)
        .otherwise(guess)
    )


def threshold_sweep(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision, recall, F1 and accuracy at each threshold, from one scan.

    Rows fold into at most 51 buckets (how many thresholds they reach); suffix sums over those give every cut.
    """
    spark = df.sparkSession
    p = F.col(score)
    folded = (
        df.where(p.isNotNull())
        .groupBy(_thresholds_reached(p).alias("reached"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )
    grid = spark.range(0, SWEEP_POINTS + 1, 1, 1).select(F.col("id").cast("int").alias("reached"))
    zero = F.lit(0).cast("bigint")
    full = grid.join(folded, "reached", "left").select(
        "reached", F.coalesce("pos", zero).alias("pos"), F.coalesce("neg", zero).alias("neg")
    )
    # 51 rows, whatever the size of the table
    everything = Window.partitionBy(F.lit(0))
    above = everything.orderBy("reached").rowsBetween(1, Window.unboundedFollowing)
    cells = full.select(
        "reached",
        F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("neg").over(above), F.lit(0)).alias("fp"),
        F.sum("pos").over(everything).alias("pos_total"),
        F.sum("neg").over(everything).alias("neg_total"),
    ).where(F.col("reached") < SWEEP_POINTS)
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("pos_total") - tp, F.col("neg_total") - fp
    return cells.select(
        (F.lit(SWEEP_START) + F.col("reached") * F.lit(SWEEP_STEP)).alias("threshold"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(tp * 2, tp * 2 + fp + fn).alias("f1"),
        ratio_or_zero(tp + tn, F.col("pos_total") + F.col("neg_total")).alias("accuracy"),
    )
