"""Classification metrics; each is one aggregate over counts or over the grouped-score frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordered import prefix_sums

THRESHOLD = 0.5
METRICS = ("auc", "f1", "precision", "recall", "accuracy")


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _counts(
    df: DataFrame, label: str, score: str, threshold: float, groups: Sequence[str], strict: bool = False
) -> DataFrame:
    yes = F.col(score) > threshold if strict else F.col(score) >= threshold
    bad = F.col(label) == 1
    return df.groupBy(*groups).agg(
        F.count_if(~bad & ~yes).alias("tn"),
        F.count_if(~bad & yes).alias("fp"),
        F.count_if(bad & ~yes).alias("fn"),
        F.count_if(bad & yes).alias("tp"),
    )


def _basic(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    return {
        "accuracy": ratio_or_zero(tp + tn, tn + fp + fn + tp),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(tp * 2, tp * 2 + fp + fn),
    }


def _cells() -> list[Column]:
    return [F.col(c) for c in ("tn", "fp", "fn", "tp")]


def _aliased(exprs: dict[str, Column]) -> list[Column]:
    return [e.alias(n) for n, e in exprs.items()]


def confusion_matrix(
    df: DataFrame, label: str, score: str, threshold: float = THRESHOLD, groups: Sequence[str] = ()
) -> DataFrame:
    return _counts(df, label, score, threshold, groups)


def basic_metrics(
    df: DataFrame, label: str, score: str, threshold: float = THRESHOLD, groups: Sequence[str] = ()
) -> DataFrame:
    return _counts(df, label, score, threshold, groups).select(*groups, *_aliased(_basic(*_cells())))


def rate_metrics(
    df: DataFrame, label: str, score: str, threshold: float = THRESHOLD, groups: Sequence[str] = ()
) -> DataFrame:
    tn, fp, fn, tp = _cells()
    rates = {
        "specificity": ratio_or_zero(tn, tn + fp),
        "npv": ratio_or_zero(tn, tn + fn),
        "fpr": ratio_or_zero(fp, fp + tn),
        "fnr": ratio_or_zero(fn, fn + tp),
    }
    return _counts(df, label, score, threshold, groups).select(*groups, *_aliased(rates))


def score_frequencies(
    df: DataFrame, label: str, score: str, groups: Sequence[str] = (), neighbours: bool = False
) -> DataFrame:
    """One row per distinct score with its ``pos`` and ``neg`` counts, the counts below it, and the totals."""
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    freq = rows.groupBy(*groups, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    return prefix_sums(freq, list(groups), "score", ["pos", "neg"], neighbours)


def _auc() -> Column:
    won = F.col("pos") * (F.col("neg_below") + F.col("neg") / F.lit(2.0))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return F.try_divide(F.sum(won), pairs)


def _average_precision() -> Column:
    tp = F.col("pos_total") - F.col("pos_below")
    fp = F.col("neg_total") - F.col("neg_below")
    return F.sum(ratio_or_zero(F.col("pos"), F.col("pos_total")) * ratio_or_zero(tp, tp + fp))


def ranking_metrics(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """AUC (ties count half) and average precision (step rule) from one ordered frame."""
    freq = score_frequencies(df, label, score, groups)
    return freq.groupBy(*groups).agg(_auc().alias("roc_auc"), _average_precision().alias("avg_precision"))


def roc_auc(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    return score_frequencies(df, label, score, groups).groupBy(*groups).agg(_auc().alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    freq = score_frequencies(df, label, score, groups)
    return freq.groupBy(*groups).agg(_average_precision().alias("avg_precision"))


def all_metrics(
    df: DataFrame, label: str, score: str, threshold: float = THRESHOLD, groups: Sequence[str] = ()
) -> DataFrame:
    """Every metric of an evaluation from one pass over the grouped scores, one row per group."""
    freq = score_frequencies(df, label, score, groups)
    yes = F.col("score") >= threshold
    wide = freq.groupBy(*groups).agg(
        _auc().alias("roc_auc"),
        _average_precision().alias("avg_precision"),
        F.sum(F.when(~yes, F.col("neg")).otherwise(0)).alias("tn"),
        F.sum(F.when(yes, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~yes, F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(yes, F.col("pos")).otherwise(0)).alias("tp"),
    )
    tn, fp, fn, tp = _cells()
    rates = {
        "specificity": ratio_or_zero(tn, tn + fp),
        "npv": ratio_or_zero(tn, tn + fn),
        "fpr": ratio_or_zero(fp, fp + tn),
        "fnr": ratio_or_zero(fn, fn + tp),
    }
    counts = {"true_positives": tp, "false_positives": fp, "true_negatives": tn, "false_negatives": fn}
    exprs = _basic(tn, fp, fn, tp) | {"roc_auc": F.col("roc_auc"), "avg_precision": F.col("avg_precision")}
    return wide.select(*groups, *_aliased(exprs | counts | rates))


def monitored_metrics(
    df: DataFrame, label: str, score: str, threshold: float = THRESHOLD, groups: Sequence[str] = ()
) -> DataFrame:
    """The five monitored metrics in long form: ``(groups…, metric, value)``."""
    wide = all_metrics(df, label, score, threshold, groups).withColumnRenamed("roc_auc", "auc")
    names = ["accuracy", "precision", "recall", "f1", "auc"]
    return wide.select(*groups, *names).unpivot(list(groups), names, "metric", "value")


def objective_metric(df: DataFrame, label: str, score: str, metric: str, groups: Sequence[str] = ()) -> DataFrame:
    """The one number a parameter search maximises; here a score must be above one half to count as a default."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; one of {', '.join(METRICS)}")
    if metric == "auc":
        found = roc_auc(df, label, score, groups)
        return found.select(*groups, F.lit(metric).alias("metric"), F.col("roc_auc").alias("value"))
    counts = _counts(df, label, score, THRESHOLD, groups, strict=True)
    return counts.select(*groups, F.lit(metric).alias("metric"), _basic(*_cells())[metric].alias("value"))


def objective_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """All metrics a search may maximise, ``(metric, value)``, from one count of the cells and one ranking."""
    names = [m for m in METRICS if m != "auc"]
    counts = _counts(df, label, score, THRESHOLD, (), strict=True)
    cells = counts.select(*[_basic(*_cells())[m].alias(m) for m in names]).unpivot([], names, "metric", "value")
    return objective_metric(df, label, score, "auc").unionByName(cells)


def classification_report(df: DataFrame, label: str, score: str, threshold: float = THRESHOLD) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages: eight numbers' work
    on a four-cell aggregate, so the rest is arithmetic on one row."""
    tn, fp, fn, tp = _cells()
    n = tn + fp + fn + tp

    def line(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            ratio_or_zero(hit, hit + wrong).alias("precision"),
            ratio_or_zero(hit, hit + missed).alias("recall"),
            ratio_or_zero(hit * 2, hit * 2 + wrong + missed).alias("f1_score"),
            (hit + missed).cast("double").alias("support"),
        )

    classes = _counts(df, label, score, threshold, ()).select(
        n.cast("double").alias("n"),
        ratio_or_zero(tp + tn, n).alias("accuracy"),
        line("0", tn, fn, fp).alias("zero"),
        line("1", tp, fp, fn).alias("one"),
    )
    zero, one = F.col("zero"), F.col("one")
    parts = ("precision", "recall", "f1_score")

    def average(name: str, weigh) -> Column:
        return F.struct(F.lit(name).alias("label"), *[weigh(p).alias(p) for p in parts], F.col("n").alias("support"))

    def macro(p: str) -> Column:
        return (zero[p] + one[p]) / 2

    def weighted(p: str) -> Column:
        return ratio_or_zero(zero[p] * zero["support"] + one[p] * one["support"], F.col("n"))

    # the accuracy line repeats the accuracy in every column, its support included
    accuracy = F.struct(
        F.lit("accuracy").alias("label"),
        *[F.col("accuracy").alias(p) for p in parts],
        F.col("accuracy").alias("support"),
    )
    lines = F.array(zero, one, accuracy, average("macro avg", macro), average("weighted avg", weighted))
    return classes.select(F.inline(lines))
