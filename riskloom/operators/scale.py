"""Scaling numeric columns: a fit gives two numbers per column, applying is a projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordered import finite, quantile_dict
from riskloom.session import written

Scales = dict[str, tuple[float, float]]


def _unit(width: float) -> float:
    """A column without spread is only centred."""
    return width if width else 1.0


def _pairs(df: DataFrame, columns: Sequence[str], first, second) -> dict[str, tuple[float, float]]:
    aggregates = [f(finite(c)) for c in columns for f in (first, second)]
    row = df.agg(*[a.alias(f"v{i}") for i, a in enumerate(aggregates)]).first()
    found = {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(columns)}
    return {c: p for c, p in found.items() if p[0] is not None}


def fit_standard(df: DataFrame, columns: Sequence[str]) -> Scales:
    """Mean and population deviation."""
    return {c: (m, _unit(s)) for c, (m, s) in _pairs(df, columns, F.avg, F.stddev_pop).items()}


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> Scales:
    return {c: (lo, _unit(hi - lo)) for c, (lo, hi) in _pairs(df, columns, F.min, F.max).items()}


def fit_robust(df: DataFrame, columns: Sequence[str]) -> Scales:
    """Exact median and interquartile range."""
    found = quantile_dict(df, columns, [0.25, 0.5, 0.75])
    return {c: robust(q) for c, q in found.items() if q}


def robust(quantiles: dict[float, float]) -> tuple[float, float]:
    return quantiles[0.5], _unit(quantiles[0.75] - quantiles[0.25])


def apply_scales(df: DataFrame, scales: Scales) -> DataFrame:
    rules = {c: (finite(c) - F.lit(centre)) / F.lit(width) for c, (centre, width) in scales.items()}
    return df.withColumns(rules) if rules else df


def scale_standard(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return apply_scales(df, fit_standard(df if fit_on is None else fit_on, columns))


def scale_minmax(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return apply_scales(df, fit_minmax(df if fit_on is None else fit_on, columns))


def scale_robust(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return apply_scales(df, fit_robust(df if fit_on is None else fit_on, columns))


# --- Yeo-Johnson -------------------------------------------------------------------------------

CELLS = 16
#: Powers are whole multiples of 1 / POWER_STEPS, so that every engine finds the same one.
POWER_STEPS = 1_000
START = (-4 * POWER_STEPS, 4 * POWER_STEPS)
MOST_POWER = 1_000


def yeo_johnson(x: Column, power: Column) -> Column:
    """The Yeo-Johnson transform of ``x`` for one power."""
    low, high = F.abs(power) < 1e-12, F.abs(power - 2) < 1e-12
    positive = F.when(low, F.log1p(x)).otherwise((F.pow(x + 1, power) - 1) / F.when(~low, power))
    negative = F.when(high, -F.log1p(-x)).otherwise(-(F.pow(1 - x, 2 - power) - 1) / F.when(~high, 2 - power))
    return F.when(x >= 0, positive).otherwise(negative)


def _best_steps(values: DataFrame, moments: DataFrame, grids: dict[str, range]) -> dict[str, int]:
    """The likeliest of a few powers for every column in one pass over the distinct values."""
    tried = [(c, step, step / POWER_STEPS) for c, grid in grids.items() for step in grid]
    powers = values.sparkSession.createDataFrame(tried, "feature string, step int, power double")
    # distances from the transformed mean, as squares of large numbers would cancel; a row per column and power
    powers = powers.join(moments, "feature").withColumn("centre", yeo_johnson(F.col("mean"), F.col("power")))
    met = values.join(F.broadcast(powers), "feature")
    met = met.select("feature", "step", "power", "log_sum", "total", "n", (yeo_johnson(F.col("value"), F.col("power")) - F.col("centre")).alias("t"))
    # the rows a value multiplies into are combined before the shuffle
    sums = met.groupBy("feature", "step", "power", "log_sum", "total").agg(
        F.sum(F.col("n") * F.col("t")).alias("s1"), F.sum(F.col("n") * F.col("t") * F.col("t")).alias("s2")
    )
    var = (F.col("s2") - F.col("s1") * F.col("s1") / F.col("total")) / F.col("total")
    scored = sums.withColumn("var", var).where((F.col("var") > 0) & (F.col("var") < float("inf")))
    likelihood = -F.col("total") / 2 * F.ln("var") + (F.col("power") - 1) * F.col("log_sum")
    best = scored.groupBy("feature").agg(F.max(F.struct(likelihood, -F.col("step"))).alias("best"))
    return {r["feature"]: -r["best"][1] for r in best.collect()}


def fit_yeo_johnson(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """The maximum-likelihood power per column, to three digits.

    Each column is folded to its distinct values and their counts once; all columns are searched together over that
    table. The likelihood has one peak: a best point on the border of the first window moves and widens the window, and once the
    best point lies inside, each pass keeps the two cells beside it. A column without spread has the power 1.
    """
    wide = df.select(*[finite(c).alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "feature", "value").where(F.col("value").isNotNull())
    values = written(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")), "values")
    weight = F.col("n").cast("double")
    folded = values.groupBy("feature").agg(
        F.sum("n").cast("double").alias("total"),
        (F.sum(weight * F.col("value")) / F.sum(weight)).alias("mean"),
        F.sum(weight * F.signum("value") * F.log1p(F.abs("value"))).alias("log_sum"),
        (F.max("value") > F.min("value")).alias("spread"),
    ).collect()
    found = {r["feature"]: 1.0 for r in folded}
    moments = df.sparkSession.createDataFrame(
        [(r["feature"], r["total"], r["mean"], r["log_sum"]) for r in folded],
        "feature string, total double, mean double, log_sum double",
    )
    windows = {r["feature"]: START for r in folded if r["spread"]}
    inside: set[str] = set()
    while windows:
        grids = {}
        for c, (low, high) in windows.items():
            if max(abs(low), abs(high)) > MOST_POWER * POWER_STEPS:
                raise ValueError(f"no likeliest power below {MOST_POWER} for {c}")
            step = max(1, -(-(high - low) // CELLS))
            grids[c] = range(low, high + step, step)
        best = _best_steps(values.where(F.col("feature").isin(list(windows))), moments, grids)
        for c, grid in grids.items():
            if c not in best:  # no finite spread under any power
                del windows[c]
                continue
            at, width = best[c], windows[c][1] - windows[c][0]
            if c not in inside and at in (grid[0], grid[-1]):
                windows[c] = (at - width, at + width)
                continue
            inside.add(c)
            found[c] = at / POWER_STEPS
            if grid.step == 1:
                del windows[c]
            else:
                windows[c] = (max(grid[0], at - grid.step), min(grid[-1], at + grid.step))
    return found


def scale_yeo_johnson(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, powers: dict[str, float] | None = None
) -> DataFrame:
    """Transform with the fitted powers, then centre and divide by the population deviation."""
    base = df if fit_on is None else fit_on
    powers = powers or fit_yeo_johnson(base, columns)
    rules = {c: yeo_johnson(finite(c), F.lit(p)) for c, p in powers.items()}
    return apply_scales(df.withColumns(rules), fit_standard(base.withColumns(rules), list(rules)))
