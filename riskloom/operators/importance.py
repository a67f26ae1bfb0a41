"""Feature importance tables and what is reported from contributions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.split import row_hash

# fixed values: list lengths of the importance reports
TOP_IMPORTANCE, TOP_DEPENDENCE = 20, 5
#: Rows that exchange values with each other; probabilities are kept this far from 0 and 1.
EXCHANGE_ROWS, LEAST_PROBABILITY = 1000, 1e-15


def feature_importance(scores: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, importance, relative_importance)`` for every feature, in percent of the total, most important
    first; a feature without a score has 0. ``scores`` is ``(feature, importance)``, a row per feature."""
    names = scores.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    full = names.join(scores, "feature", "left").fillna(0.0, ["importance"])
    # a row per feature
    total = F.sum("importance").over(Window.partitionBy(F.lit(0)))
    relative = F.try_divide(F.col("importance"), total) * 100
    return full.select("feature", "importance", relative.alias("relative_importance")).orderBy(
        F.col("importance").desc(), "feature"
    )


def permutation_importance(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    keys: Sequence[str],
    score: Callable[[DataFrame, Sequence[str]], DataFrame],
    seed: int = 42,
    exchange_rows: int = EXCHANGE_ROWS,
) -> DataFrame:
    """How much the mean logistic loss rises when one column's values are exchanged between rows, as a
    ``feature_importance`` table; 0 where it does not rise.

    ``score`` takes rows and the names of columns to keep and returns these and ``p``. Rows are dealt by a hash of their
    ``keys``, which must be unique, into buckets of about ``exchange_rows`` and ordered by that hash; the j-th feature takes the
    value of the row j places on, around the bucket. All features are scored in one pass over features + 1 versions of
    each row, after one shuffle of the rows. Rows without a label are left out; an empty table gives 0 for every feature.
    """
    labelled = df.where(F.col(label).isNotNull())
    buckets = max(1, -(-labelled.count() // exchange_rows))
    row = F.struct(
        row_hash(keys, seed).alias("h"),
        F.col(label).cast("double").alias("label"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
    )
    dealt = labelled.select(row.alias("row"))
    bucket = F.conv(F.substring("row.h", 1, 7), 16, 10).cast("bigint") % buckets
    groups = dealt.groupBy(bucket.alias("bucket")).agg(F.sort_array(F.collect_list("row")).alias("rows"))
    n = F.size("rows")

    def partner(i: Column, j: int) -> Column:
        shift = F.when(n > 1, 1 + F.lit(j) % F.nullif(n - 1, F.lit(0))).otherwise(0)
        return F.get("rows", ((i + shift) % n).cast("int"))

    others = F.transform(
        "rows", lambda r, i: F.struct(r.label, r.x, F.array(*[F.get(partner(i, j).x, F.lit(j)) for j in range(len(features))]))
    )
    exchanged = groups.select(F.inline(others).alias("label", "x", "other"))
    versions = exchanged.select("*", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))).alias("version"))
    cells = [
        F.when(F.col("version") == j, F.get("other", F.lit(j))).otherwise(F.get("x", F.lit(j))).alias(c)
        for j, c in enumerate(features)
    ]
    scored = score(versions.select(F.col("label").alias("_label"), F.col("version").alias("_version"), *cells), ["_label", "_version"])
    p = F.greatest(F.lit(LEAST_PROBABILITY), F.least(F.lit(1 - LEAST_PROBABILITY), F.col("p")))
    loss = -F.when(F.col("_label") == 1, F.ln(p)).otherwise(F.ln(1 - p))
    # a row for each version from here on
    losses = scored.groupBy("_version").agg(F.avg(loss).alias("loss"))
    whole = F.max(F.when(F.col("_version") == -1, F.col("loss"))).over(Window.partitionBy(F.lit(0)))
    names = F.array(*[F.lit(c) for c in features])
    rises = losses.select("_version", F.greatest(F.col("loss") - whole, F.lit(0.0)).alias("importance"))
    rises = rises.where(F.col("_version") >= 0).select(F.get(names, F.col("_version")).alias("feature"), "importance")
    return feature_importance(rises, features)


def topk_importance(importance: DataFrame, k: int = TOP_IMPORTANCE) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), "feature").limit(k)


def shap_summary(contributions: DataFrame) -> DataFrame:
    """Mean absolute contribution and rank per feature. ``contributions`` has (id, feature, value, contribution)."""
    per_feature = contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))
    # a row per feature
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("mean_abs").desc(), F.col("feature")))
    return per_feature.withColumn("rank", rank)


def shap_dependence(contributions: DataFrame, k: int = TOP_DEPENDENCE) -> DataFrame:
    """(value, contribution) pairs of the ``k`` features that contribute most."""
    top = shap_summary(contributions).where(F.col("rank") <= k).select("feature", "rank")
    return contributions.join(F.broadcast(top), "feature").select("id", "feature", "rank", "value", "contribution")
