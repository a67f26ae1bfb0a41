"""Feature selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.schema import numeric_columns

# fixed value: the variance a column must exceed
MIN_VARIANCE = 0.01


def variance_threshold(
    df: DataFrame, columns: Sequence[str] | None = None, threshold: float = MIN_VARIANCE
) -> DataFrame:
    """``(feature, variance, kept)``: population variance, kept when strictly above the threshold."""
    names = list(columns) if columns is not None else numeric_columns(df)
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    long = doubles.unpivot([], names, "feature", "value").where(~F.isnan("value"))
    variances = long.groupBy("feature").agg(F.var_pop("value").alias("variance"))
    return variances.withColumn("kept", F.coalesce(F.col("variance") > threshold, F.lit(False)))


def kept_columns(selection: DataFrame, columns: Sequence[str]) -> list[str]:
    """The kept names in table order."""
    kept = {r["feature"] for r in selection.where("kept").collect()}
    return [c for c in columns if c in kept]


def at_least_median(importance: DataFrame) -> DataFrame:
    """``(feature, importance, threshold, kept)``: kept when no less important than the median feature."""
    # a row per feature
    cut = importance.agg(F.percentile("importance", 0.5)).scalar()
    marked = importance.select("feature", "importance", cut.alias("threshold"))
    return marked.withColumn("kept", F.col("importance") >= F.col("threshold"))


def feature_counts(before: DataFrame, after: DataFrame, target: str) -> DataFrame:
    """Input features, engineered features and rows."""
    return after.agg(F.count(F.lit(1)).alias("n_samples")).select(
        F.lit(len([c for c in before.columns if c != target])).alias("n_input_features"),
        F.lit(len([c for c in after.columns if c != target])).alias("n_engineered_features"),
        "n_samples",
    )
