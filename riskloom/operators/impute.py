"""Filling missing values. A fit is one aggregate whose few numbers come to the driver; applying is a projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordered import finite, quantile_dict
from riskloom.schema import numeric_columns, string_columns


def fit_mean(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, float]:
    """Column means; a column without any value is left out."""
    names = list(columns) if columns is not None else numeric_columns(df)
    if not names:
        return {}
    row = df.agg(*[F.avg(finite(c)).alias(f"m{i}") for i, c in enumerate(names)]).first()
    return {c: row[i] for i, c in enumerate(names) if row[i] is not None}


def fit_median(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, float]:
    """Exact column medians; a column without any value is left out."""
    names = list(columns) if columns is not None else numeric_columns(df)
    found = quantile_dict(df, names, [0.5]) if names else {}
    return {c: q[0.5] for c, q in found.items() if q}


def fit_mode(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """The most frequent string of each column, the smallest of them on a tie."""
    names = list(columns) if columns is not None else string_columns(df)
    if not names:
        return {}
    long = df.select(*names).unpivot([], names, "feature", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(F.min(F.struct(-F.col("n"), F.col("value").alias("value"))).alias("best"))
    return {r["feature"]: r["best"]["value"] for r in best.collect()}


def fill(df: DataFrame, fitted: dict[str, float] | dict[str, str], columns: Sequence[str]) -> DataFrame:
    """Fill ``columns``; those the fit left out had no value at all and are dropped."""
    numeric = set(numeric_columns(df))
    rules = {
        c: F.coalesce(finite(c) if c in numeric else F.col(c), F.lit(fitted[c])) for c in columns if c in fitted
    }
    empty = [c for c in columns if c not in fitted]
    return (df.withColumns(rules) if rules else df).drop(*empty)


def impute_mean(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return fill(df, fit_mean(df if fit_on is None else fit_on, columns), columns)


def impute_median(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return fill(df, fit_median(df if fit_on is None else fit_on, columns), columns)


def impute_mode(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return fill(df, fit_mode(df if fit_on is None else fit_on, columns), columns)
