"""Column statistics and table profiles.

Columns are unpivoted to (feature, value), so the plan keeps its size however wide the table is; every aggregate
combines before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.curves import histogram as histogram  # noqa: PLC0414  (part of this module's API)
from riskloom.operators.ordered import exact_quantiles
from riskloom.schema import numeric_columns, string_columns

# fixed values: the percentiles a column is summarised by, and how many categories are listed
PERCENTILES = [1, 5, 25, 50, 75, 95, 99]
TOP_CATEGORIES = 10


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value)`` with NaN as null; null rows stay, since the missing share counts them."""
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot([], list(columns), "feature", "value")
    return long.select("feature", F.when(~F.isnan("value"), F.col("value")).alias("value"))


def _strings(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    texts = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot(list(keep), list(columns), "feature", "value")


def _dtypes(df: DataFrame, columns: Sequence[str]) -> Column:
    known = dict(df.dtypes)
    return F.create_map(*[F.lit(x) for c in columns for x in (c, known[c])])


def _pivot_quantiles(quantiles: DataFrame, names: dict[float, str]) -> DataFrame:
    picked = [F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in names.items()]
    return quantiles.groupBy("feature").agg(*picked)


def _approx_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    sketch = F.percentile_approx("value", [float(p) for p in probabilities], 10_000)
    per_feature = _numbers(df, columns).groupBy("feature").agg(sketch.alias("q"))
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probabilities]).alias("prob"), F.col("q").alias("quantile"))
    return per_feature.select("feature", F.inline(pairs).alias("prob", "quantile"))


def numeric_stats(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Mean, median, sample deviation, range, missing share and percentiles per numeric column.

    ``approximate`` answers the percentiles from a sketch in the same kind of single pass instead of exactly.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    basic = (
        _numbers(df, names)
        .groupBy("feature")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            (F.count_if(F.col("value").isNull()) / F.count(F.lit(1))).alias("missing"),
        )
    )
    probabilities = [p / 100 for p in PERCENTILES]
    quantiles = (_approx_quantiles if approximate else exact_quantiles)(df, names, probabilities)
    wide = _pivot_quantiles(quantiles, {p / 100: f"p{p}" for p in PERCENTILES})
    # one row per column on both sides
    joined = basic.join(F.broadcast(wide), "feature", "left")
    return joined.select(
        "feature",
        F.try_element_at(_dtypes(df, names), F.col("feature")).alias("dtype"),
        "mean",
        F.col("p50").alias("median"),
        "std",
        "min",
        "max",
        "missing",
        *[f"p{p}" for p in PERCENTILES],
    )


def category_frequencies(
    df: DataFrame, columns: Sequence[str], groups: Sequence[str] = (), top: int | None = TOP_CATEGORIES
) -> DataFrame:
    """``(groups…, feature, value, n, freq, n_distinct)``: shares of the non-null rows, most frequent first.

    With ``top`` only that many values per column are kept; ties go to the smaller value. The row-number filter is
    planned as a group limit, so each task passes on at most ``top`` rows per column.
    """
    keys = [*groups, "feature"]
    counts = (
        _strings(df, columns, groups)
        .where(F.col("value").isNotNull())
        .groupBy(*keys, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))
    if top is not None:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("n").desc(), F.col("value")))
        counts = counts.withColumn("place", place).where(F.col("place") <= top).drop("place")
    return counts.join(F.broadcast(totals), keys).select(
        *keys, "value", "n", (F.col("n") / F.col("n_rows")).alias("freq"), "n_distinct"
    )


def categorical_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct count, missing share and the ten most frequent values with their shares, per string column."""
    names = list(columns) if columns is not None else string_columns(df)
    missing = (
        _strings(df, names)
        .groupBy("feature")
        .agg((F.count_if(F.col("value").isNull()) / F.count(F.lit(1))).alias("missing"))
    )
    listed = (
        category_frequencies(df, names)
        .groupBy("feature")
        .agg(
            F.max("n_distinct").alias("unique_count"),
            F.map_from_entries(F.collect_list(F.struct("value", "freq"))).alias("top_categories"),
        )
    )
    return missing.join(listed, "feature", "left").select(
        "feature",
        F.try_element_at(_dtypes(df, names), F.col("feature")).alias("dtype"),
        F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
        "missing",
        "top_categories",
    )


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns) if columns is not None else df.columns
    flags = df.select(*[F.col(c).isNull().cast("int").alias(c) for c in names])
    long = flags.unpivot([], names, "feature", "missing")
    return long.groupBy("feature").agg(
        F.sum("missing").alias("missing_values"), F.count(F.lit(1)).alias("n_rows")
    )


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values, most first."""
    counts = missing_counts(df, columns)
    share = (F.col("missing_values") / F.col("n_rows") * 100).alias("percentage")
    return (
        counts.where(F.col("missing_values") > 0)
        .select("feature", "missing_values", share)
        .orderBy(F.col("missing_values").desc(), "feature")
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, range and exact quartiles per numeric column."""
    names = list(columns) if columns is not None else numeric_columns(df)
    basic = (
        _numbers(df, names)
        .groupBy("feature")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    quartiles = _pivot_quantiles(exact_quantiles(df, names, [0.25, 0.5, 0.75]), {0.25: "p25", 0.5: "p50", 0.75: "p75"})
    return basic.join(F.broadcast(quartiles), "feature", "left").select(
        "feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def schema_report(df: DataFrame) -> DataFrame:
    """Name, type, non-null count and table shape, one row per column in table order."""
    order = F.create_map(*[F.lit(x) for i, c in enumerate(df.columns) for x in (c, i)])
    return missing_counts(df).select(
        F.try_element_at(order, F.col("feature")).alias("position"),
        "feature",
        F.try_element_at(_dtypes(df, df.columns), F.col("feature")).alias("dtype"),
        (F.col("n_rows") - F.col("missing_values")).alias("non_null"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
    )


def table_profile(df: DataFrame) -> DataFrame:
    """A short profile of every column: missing, distinct, zeros, and the numeric summary where there is one.

    Distinct values are counted exactly, by grouping on (column, value).
    """
    numeric = [c for c in numeric_columns(df)]
    zero = _strings(df, df.columns)
    distinct = (
        zero.where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n_distinct"), F.max("n").alias("n_most_frequent"))
    )
    out = schema_report(df).join(distinct, "feature", "left")
    if numeric:
        summary = (
            _numbers(df, numeric)
            .groupBy("feature")
            .agg(
                F.count_if(F.col("value") == 0).alias("n_zeros"),
                F.count_if(F.col("value") < 0).alias("n_negative"),
                F.avg("value").alias("mean"),
                F.stddev_samp("value").alias("std"),
                F.min("value").alias("min"),
                F.max("value").alias("max"),
            )
        )
        out = out.join(summary, "feature", "left")
    return out.withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts and percentages of the non-null values."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.select(F.col(column).alias("value"), "n_rows", (F.col("n_rows") / total * 100).alias("percentage"))
