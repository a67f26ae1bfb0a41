"""Drift between a reference and a current table: data, concept and importance."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.operators import laid_out
from riskloom.operators.ordered import prefix_sums, value_counts_by_side
from riskloom.operators.stats import TOP_CATEGORIES, category_frequencies, numeric_stats
from riskloom.schema import numeric_columns, string_columns
from riskloom.session import checked_broadcast, written

# fixed values: thresholds, weights and list lengths of the drift reports
DRIFT_THRESHOLD = 0.1
IMPORTANCE_THRESHOLD = 0.2
KL_THRESHOLD = 0.2
DISTANCE_WEIGHT, KS_WEIGHT = 0.4, 0.6
MEAN_WEIGHT, STD_WEIGHT = 0.7, 0.3
IMPORTANCE_FLOOR = 0.1
TOP_DRIFTED, TOP_CHANGED = 5, 10


def _both(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The two tables under one another with a ``side`` column."""
    left = reference.select(F.lit("ref").alias("side"), *columns)
    return left.unionByName(current.select(F.lit("cur").alias("side"), *columns))


def shared_features(reference: DataFrame, current: DataFrame) -> dict[str, list[str]]:
    """Features by how they compare: numeric, categorical, mismatched type, or missing from the current table."""
    ref_types, cur_types = dict(reference.dtypes), dict(current.dtypes)
    shared = [c for c in reference.columns if c in cur_types]
    same = {c for c in shared if ref_types[c] == cur_types[c]}
    numeric = set(numeric_columns(reference))
    return {
        "numeric": [c for c in shared if c in same and c in numeric],
        "categorical": [c for c in shared if c in same and c not in numeric],
        "mismatched": [c for c in shared if c not in same],
        "missing": [c for c in reference.columns if c not in cur_types],
    }


def distribution_distances(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """``(feature, ks, wasserstein, wasserstein_norm)`` for all features at once, from one ordered frame.

    Missing values are left out on each side. The distance is divided by the reference range (0 when that is 0).
    """
    names = list(columns) if columns is not None else shared_features(reference, current)["numeric"]
    both = _both(reference, current, names)
    sides = {"ref": (F.col("side") == "ref").cast("int"), "cur": (F.col("side") == "cur").cast("int")}
    return _distances(value_counts_by_side(both, names, sides))


def _distances(freq: DataFrame) -> DataFrame:
    """The distances from ``(feature, value, ref, cur)``, a row per value."""
    points = prefix_sums(freq, ["feature"], "value", ["ref", "cur"], neighbours=True)

    def reached(side: str) -> Column:
        return (F.col(f"{side}_below") + F.col(side)) / F.nullif(F.col(f"{side}_total"), F.lit(0))

    gap = F.abs(reached("ref") - reached("cur"))
    in_ref = F.when(F.col("ref") > 0, F.col("value"))
    out = points.groupBy("feature").agg(
        F.max(gap).alias("ks"),
        F.sum(F.coalesce(gap * (F.col("next.value") - F.col("value")), gap * 0)).alias("wasserstein"),
        (F.max(in_ref) - F.min(in_ref)).alias("ref_range"),
    )
    return _normalised(out)


def _normalised(out: DataFrame) -> DataFrame:
    norm = F.when(F.col("ref_range") > 0, F.col("wasserstein") / F.col("ref_range")).otherwise(F.lit(0.0))
    return out.select("feature", "ks", "wasserstein", norm.alias("wasserstein_norm"))


def ks_statistic(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return distribution_distances(reference, current, columns).select("feature", "ks")


def wasserstein(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return distribution_distances(reference, current, columns).select("feature", "wasserstein", "wasserstein_norm")


def _capped(score: Column) -> Column:
    return F.least(score, F.lit(1.0))


def numeric_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Weighted sum of the normalised distance and the KS statistic, at most 1; nothing to compare gives 0."""
    return _numeric_scores(distribution_distances(reference, current, columns))


def _numeric_scores(d: DataFrame) -> DataFrame:
    score = F.lit(DISTANCE_WEIGHT) * F.col("wasserstein_norm") + F.lit(KS_WEIGHT) * F.col("ks")
    return d.select("feature", _capped(F.coalesce(score, F.lit(0.0))).alias("drift_score"))


def _moments(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot([], list(columns), "feature", "value").where(~F.isnan("value"))
    return long.groupBy("feature").agg(
        F.avg("value").alias(f"{side}_mean"), F.stddev_samp("value").alias(f"{side}_std")
    )


def moment_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drift from means and deviations only, for when the reference rows are gone; at most 1."""
    names = list(columns) if columns is not None else shared_features(reference, current)["numeric"]
    return moment_drift_from_stats(_moments(reference, names, "ref"), _moments(current, names, "cur"))


def moment_drift_from_stats(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """``ref`` has (feature, ref_mean, ref_std) and ``cur`` (feature, cur_mean, cur_std); a zero deviation divides
    nothing, a moment that a side does not have (no value, or one value alone) gives 0."""
    both = ref.join(cur, "feature")
    unit = F.when(F.col("ref_std") > 0, F.col("ref_std")).otherwise(F.lit(1.0))
    moved = F.abs(F.col("cur_mean") - F.col("ref_mean")) / unit
    spread = F.abs(F.col("cur_std") - F.col("ref_std")) / unit
    score = F.lit(MEAN_WEIGHT) * moved + F.lit(STD_WEIGHT) * spread
    return both.select("feature", _capped(F.coalesce(score, F.lit(0.0))).alias("drift_score"))


def _paired_categories(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The ten most frequent values of each side, joined; a value not among a side's ten has frequency 0 there."""
    return _paired(category_frequencies(_both(reference, current, columns), columns, ["side"]))


def _paired(both: DataFrame) -> DataFrame:
    return both.groupBy("feature", "value").agg(
        F.coalesce(F.max(F.when(F.col("side") == "ref", F.col("freq"))), F.lit(0.0)).alias("ref_freq"),
        F.coalesce(F.max(F.when(F.col("side") == "cur", F.col("freq"))), F.lit(0.0)).alias("cur_freq"),
    )


def categorical_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Half the summed frequency differences over both sides' ten most frequent values."""
    names = list(columns) if columns is not None else shared_features(reference, current)["categorical"]
    return _category_scores(_paired_categories(reference, current, names))


def _category_scores(pairs: DataFrame) -> DataFrame:
    score = F.sum(F.abs(F.col("ref_freq") - F.col("cur_freq"))) / 2
    return pairs.groupBy("feature").agg(_capped(score).alias("drift_score"))


def type_mismatch_drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """One row per feature whose type changed: full drift. A feature the current table lacks is left out."""
    ref_types, cur_types = dict(reference.dtypes), dict(current.dtypes)
    rows = [(c, ref_types[c], cur_types[c], 1.0) for c in shared_features(reference, current)["mismatched"]]
    return reference.sparkSession.createDataFrame(
        rows, "feature string, ref_type string, cur_type string, drift_score double"
    )


def feature_drift(
    reference: DataFrame, current: DataFrame, threshold: float = DRIFT_THRESHOLD
) -> DataFrame:
    """``(feature, kind, drift_score, drifted)`` over every feature both tables have."""
    return _scored_features(reference, current, threshold, numeric_drift, categorical_drift)


@dataclass(frozen=True)
class GroupedReference:
    """All that ``grouped_feature_drift`` needs of a reference: ``numbers``, the distinct numbers with their counts laid
    out in parts, and ``leading`` (feature, value, freq), the most frequent strings of each column."""

    schema: StructType
    numbers: laid_out.Distribution
    leading: DataFrame


def group_reference(reference: DataFrame, part_values: int = laid_out.PART_VALUES) -> GroupedReference:
    """The reference grouped once and written, for comparing many tables with it."""
    numeric = numeric_columns(reference)
    others = [c for c in reference.columns if c not in set(numeric)]
    values = value_counts_by_side(reference, numeric, {"ref": F.lit(1)}) if numeric else _no_rows(
        reference, "feature string, value double, ref bigint"
    )
    leading = category_frequencies(reference, others).select("feature", "value", "freq") if others else _no_rows(
        reference, "feature string, value string, freq double"
    )
    numbers = laid_out.lay_out(values, part_values)
    return GroupedReference(reference.schema, numbers, written(leading, "reference-leading"))


def _no_rows(df: DataFrame, schema: StructType | str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def grouped_feature_drift(
    reference: GroupedReference, current: DataFrame, threshold: float = DRIFT_THRESHOLD
) -> DataFrame:
    """``feature_drift`` against a grouped reference, whose rows are not read again: of its numbers only the parts that
    ``current`` falls in or whose curve it crosses."""

    def numeric(_: DataFrame, rows: DataFrame, names: Sequence[str]) -> DataFrame:
        return _numeric_scores(_normalised(laid_out.distances(reference.numbers, rows, names)))

    def categorical(_: DataFrame, rows: DataFrame, names: Sequence[str]) -> DataFrame:
        old = reference.leading.where(F.col("feature").isin(list(names))).withColumn("side", F.lit("ref"))
        new = category_frequencies(rows, names).select("feature", "value", "freq", F.lit("cur").alias("side"))
        return _category_scores(_paired(old.unionByName(new)))

    return _scored_features(_no_rows(current, reference.schema), current, threshold, numeric, categorical)


Scores = Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame]


def _scored_features(
    reference: DataFrame, current: DataFrame, threshold: float, numeric: Scores, categorical: Scores
) -> DataFrame:
    kinds = shared_features(reference, current)
    parts = []
    for kind, scored in (("numeric", numeric), ("categorical", categorical)):
        if kinds[kind]:
            names = reference.sparkSession.createDataFrame([(c,) for c in kinds[kind]], "feature string")
            # a feature with no values at all has no row in the ordered frame; it scores 0
            scores = names.join(scored(reference, current, kinds[kind]), "feature", "left").fillna(0.0, ["drift_score"])
            parts.append(scores.select("feature", F.lit(kind).alias("kind"), "drift_score"))
    if kinds["mismatched"]:
        scores = type_mismatch_drift(reference, current)
        parts.append(scores.select("feature", F.lit("type").alias("kind"), "drift_score"))
    if not parts:
        return reference.sparkSession.createDataFrame(
            [], "feature string, kind string, drift_score double, drifted boolean"
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("drifted", F.col("drift_score") > threshold)


def overall_drift(scores: DataFrame, importance: DataFrame | None = None) -> DataFrame:
    """One row: has_drift, the importance-weighted mean score, and how many features drifted.

    ``importance`` has (feature, relative_importance); a feature it does not list weighs 0, and when nothing has
    weight the plain mean is used. Both inputs have one row per feature.
    """
    if importance is None:
        weighted = scores.withColumn("weight", F.lit(0.0))
    else:
        weights = importance.select("feature", F.col("relative_importance").alias("weight"))
        weighted = scores.join(weights, "feature", "left").fillna(0.0, ["weight"])
    total = F.sum("weight")
    mean = F.when(total > 0, F.sum(F.col("drift_score") * F.col("weight")) / total).otherwise(F.avg("drift_score"))
    return weighted.agg(
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("has_drift"),
        F.coalesce(mean, F.lit(0.0)).alias("drift_score"),
        F.count_if("drifted").alias("n_drifted"),
        F.count(F.lit(1)).alias("n_features"),
    )


def metric_compare(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Shared metrics side by side; both inputs are ``(metric, value)``."""
    left = reference.select("metric", F.col("value").alias("reference"))
    right = current.select("metric", F.col("value").alias("current"))
    both = left.join(right, "metric")
    return both.withColumn("difference", F.col("current") - F.col("reference")).orderBy("metric")


def metric_changes(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Relative change of each shared metric; from a reference of 0 the current value itself."""
    change = F.when(
        F.col("reference") != 0, F.col("difference") / F.abs("reference")
    ).otherwise(F.col("current"))
    return metric_compare(reference, current).withColumn("relative_change", change)


def concept_drift(
    reference: DataFrame, current: DataFrame | None, threshold: float = DRIFT_THRESHOLD
) -> DataFrame:
    """One row ``(drift_score, has_drift)``: the relative loss of AUC, or of precision and recall without an AUC.

    Without current metrics (no labels yet) there is no drift and the score is 0.
    """
    if current is None:
        return reference.sparkSession.createDataFrame([(0.0, False)], "drift_score double, has_drift boolean")

    def change(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("relative_change")))

    fallback = (F.coalesce(change("precision"), F.lit(0.0)) + F.coalesce(change("recall"), F.lit(0.0))) / 2
    loss = -F.coalesce(change("auc"), fallback)
    changes = metric_changes(reference, current).agg(F.greatest(loss, F.lit(0.0)).alias("drift_score"))
    return changes.withColumn("has_drift", F.col("drift_score") > threshold)


def importance_drift(
    reference: DataFrame, current: DataFrame, threshold: float = IMPORTANCE_THRESHOLD
) -> DataFrame:
    """Change of each feature's relative importance; a feature one side lacks counts as 0 there."""
    left = reference.select("feature", F.col("relative_importance").alias("ref"))
    right = current.select("feature", F.col("relative_importance").alias("cur"))
    both = left.join(right, "feature", "full_outer").fillna(0.0, ["ref", "cur"])
    moved = F.col("cur") - F.col("ref")
    relative = moved / F.greatest("ref", F.lit(IMPORTANCE_FLOOR))
    return both.select(
        "feature",
        F.col("ref").alias("relative_importance_ref"),
        F.col("cur").alias("relative_importance_cur"),
        moved.alias("absolute_change"),
        relative.alias("relative_change"),
        (F.abs(relative) > threshold).alias("changed"),
    )


def topk_drifted(scores: DataFrame, k: int = TOP_DRIFTED) -> DataFrame:
    """The most drifted features, of those that did drift."""
    return scores.where("drifted").orderBy(F.col("drift_score").desc(), "feature").limit(k)


def topk_changed(changes: DataFrame, k: int = TOP_CHANGED) -> DataFrame:
    """The features whose importance moved most, either way."""
    return changes.orderBy(F.abs("absolute_change").desc(), "feature").limit(k)


def category_compare(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None, top: int = TOP_CATEGORIES
) -> DataFrame:
    """Each value's share on both sides, for every value, or for the union of both sides' most frequent ``top``
    when a column has more than ``top`` of them."""
    names = list(columns) if columns is not None else shared_features(reference, current)["categorical"]
    # both sides are grouped once; the frequencies are over all values, so a listed value shows its true share
    freq = category_frequencies(_both(reference, current, names), names, ["side"], top=None)
    sided = freq.groupBy("feature", "value").agg(
        *[F.coalesce(F.max(F.when(F.col("side") == s, F.col(c))), F.lit(0)).alias(f"{s}_{c}")
          for s in ("ref", "cur") for c in ("freq", "n")],
    )
    sided = written(sided, "categories")
    distinct = sided.groupBy("feature").agg(F.count(F.lit(1)).alias("n_values"))
    short = sided.join(F.broadcast(distinct.where(F.col("n_values") <= top)), "feature", "left_semi")
    long = sided.join(F.broadcast(distinct.where(F.col("n_values") > top)), "feature", "left_semi")
    # at most `top` values of a feature and side, found by a limit for each group
    leading = [
        long.where(F.col(f"{s}_n") > 0)
        .withColumn("place", F.row_number().over(Window.partitionBy("feature").orderBy(F.col(f"{s}_n").desc(), "value")))
        .where(F.col("place") <= top)
        .drop("place")
        for s in ("ref", "cur")
    ]
    shown = short.unionByName(leading[0].unionByName(leading[1]).distinct())
    return shown.select("feature", "value", "ref_freq", "cur_freq")


def kl_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int = 20,
    smoothing: float = 1e-6,
    threshold: float = KL_THRESHOLD,
) -> DataFrame:
    """Kullback-Leibler divergence of the current from the reference distribution over equal-width bins."""
    from riskloom.operators.curves import equal_width_bin

    names = list(columns) if columns is not None else shared_features(reference, current)["numeric"]
    both = _both(reference, current, names)
    doubles = both.select("side", *[F.col(c).cast("double").alias(c) for c in names])
    long = doubles.unpivot(["side"], names, "feature", "value")
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    ranges = long.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    placed = long.join(checked_broadcast(ranges), "feature")
    counts = placed.groupBy(
        "feature", equal_width_bin(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin")
    ).agg(F.count_if(F.col("side") == "ref").alias("ref"), F.count_if(F.col("side") == "cur").alias("cur"))
    totals = counts.groupBy("feature").agg(F.sum("ref").alias("ref_total"), F.sum("cur").alias("cur_total"))
    # at most `bins` rows per feature from here on
    p = F.col("cur") / F.col("cur_total") + F.lit(smoothing)
    q = F.col("ref") / F.col("ref_total") + F.lit(smoothing)
    usable = totals.where((F.col("ref_total") > 0) & (F.col("cur_total") > 0))
    terms = counts.join(F.broadcast(usable), "feature")
    out = terms.groupBy("feature").agg(F.sum(p * F.ln(p / q)).alias("kl"))
    return out.withColumn("drifted", F.col("kl") > threshold)


def drift_alert(data: DataFrame, concept: DataFrame, importance: DataFrame) -> DataFrame:
    """One row: any of the three drift flags, with their details.

    ``data`` is a ``feature_drift`` table, ``concept`` the one-row concept result and ``importance`` an
    ``importance_drift`` table.
    """
    found = concept.select(F.struct("has_drift", "drift_score")).scalar()
    changed = importance.agg(
        F.struct(
            F.coalesce(F.bool_or("changed"), F.lit(False)).alias("any"),
            F.array_sort(F.collect_list(F.when(F.col("changed"), F.col("feature")))).alias("features"),
        )
    ).scalar()
    row = data.agg(
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("data_drift"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature")))).alias("drifted_features"),
    ).select("*", found.alias("concept"), changed.alias("importance"))
    flags = [F.col("data_drift"), F.col("concept.has_drift"), F.col("importance.any")]
    return row.select(
        (flags[0] | flags[1] | flags[2]).alias("alert"),
        "data_drift",
        "drifted_features",
        F.col("concept.has_drift").alias("concept_drift"),
        F.col("concept.drift_score").alias("concept_drift_score"),
        F.col("importance.any").alias("importance_drift"),
        F.col("importance.features").alias("changed_features"),
    )


def reference_stats(df: DataFrame) -> dict[str, DataFrame]:
    """The statistics a snapshot keeps, for numeric and for string columns."""
    from riskloom.operators.stats import categorical_stats

    out = {}
    if numeric_columns(df):
        out["numeric_stats"] = numeric_stats(df)
    if string_columns(df):
        out["categorical_stats"] = categorical_stats(df)
    return out
