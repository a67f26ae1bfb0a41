"""The whole batch run as one chain of operators: clean, split, derive, preprocess, select, train, calibrate, evaluate,
and later compare new loans with what the model was built on.

Tables that several steps read are written once as versioned Parquet, so each step starts from a scan and types
survive. Everything fitted (bounds, fills, scales, categories, selection) is fitted on the training rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import calibrate, clean, curves, drift, gates, generate, metrics, select, snapshot, split, train
from riskloom.operators.preprocess import Preprocessor
from riskloom.schema import MAX_LOAN_AMOUNT, MIN_LOAN_AMOUNT, TARGET, numeric_columns
from riskloom.sources import tables


#: Fixed value: the relative loss of performance that counts as drift in the task's configuration.
PERFORMANCE_THRESHOLD = 0.05


@dataclass(frozen=True)
class Settings:
    as_of: str
    key: str = "id"
    target: str = TARGET
    low: float = MIN_LOAN_AMOUNT
    high: float = MAX_LOAN_AMOUNT
    test_size: float = 0.2
    val_size: float = 0.25
    stratum: str | None = None
    seed: int = 42
    generate: bool = True
    select: bool = True
    imputation: str = "knn"
    scaling: str = "robust"
    trials: int = 0
    metric: str = "auc"
    calibration: str | None = "isotonic"
    params: train.TreeParams = field(default_factory=train.TreeParams)
    drift_threshold: float = drift.DRIFT_THRESHOLD
    performance_threshold: float = PERFORMANCE_THRESHOLD
    importance_threshold: float = drift.IMPORTANCE_THRESHOLD
    max_snapshots: int = tables.KEPT_VERSIONS


@dataclass(frozen=True)
class Built:
    features: list[str]
    model: GBTClassificationModel
    calibrator: calibrate.Calibrator | None
    reports: dict[str, DataFrame]
    generator: generate.FeatureGeneratorModel | None = None
    preprocessor: Preprocessor | None = None


def _stored(df: DataFrame, base: str, name: str) -> DataFrame:
    return tables.scan_table(df.sparkSession, base, name, tables.sink_table(df, base, name))


def _part(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name)


def save_built(built: Built, base: str) -> None:
    """Store everything that scoring new raw loans takes, below ``base``."""
    built.preprocessor.save(base, "preprocessor")
    model = f"{base}/model"
    built.model.write().overwrite().save(f"{model}/trees")
    if built.generator:
        built.generator.write().overwrite().save(f"{model}/generator")
    if built.calibrator:
        built.calibrator.save(model)
    state = json.dumps({
        "features": built.features,
        "calibration": built.calibrator.method if built.calibrator else None,
        "generator": built.generator is not None,
    })
    spark = SparkSession.active()
    tables.sink_table(spark.createDataFrame([(state,)], "state string"), base, "model_state")


def load_built(spark: SparkSession, base: str) -> Built:
    state = json.loads(tables.scan_table(spark, base, "model_state").first()[0])
    model = f"{base}/model"
    return Built(
        state["features"],
        GBTClassificationModel.load(f"{model}/trees"),
        calibrate.Calibrator.load(model, state["calibration"]) if state["calibration"] else None,
        {},
        generate.FeatureGeneratorModel.load(f"{model}/generator") if state["generator"] else None,
        Preprocessor.load(spark, base, "preprocessor"),
    )


def ready(built: Built, raw: DataFrame, s: Settings) -> DataFrame:
    """Raw loans as the model wants them, by what was fitted; unlabelled loans all stay."""
    labelled = s.target in raw.columns
    cleaned = clean.clean(raw, s.as_of, s.low, s.high, s.target) if labelled else clean.clean_features(raw, s.as_of)
    return built.preprocessor.transform(built.generator.transform(cleaned) if built.generator else cleaned)


def score_new(built: Built, raw: DataFrame, s: Settings) -> DataFrame:
    """``(key, probability)`` of default for raw loans."""
    scored = train.score_table(built.model, ready(built, raw, s), built.features, [s.key], "probability")
    if not built.calibrator:
        return scored
    return built.calibrator.transform(scored, "probability").select(s.key, F.col("calibrated").alias("probability"))


def prepare(raw: DataFrame, base: str, s: Settings):
    """Cleaned, split, derived and preprocessed rows, stored as ``features``; the fitted generator and preprocessing."""
    cleaned = _stored(clean.clean(raw, s.as_of, s.low, s.high, s.target), base, "clean")
    parts = split.split_rows(cleaned, [s.key], s.seed, s.test_size, s.val_size, s.stratum)
    parts = _stored(parts, base, "split")
    generator = generate.FeatureGenerator().fit(_part(parts, "train")) if s.generate else None
    parts = generator.transform(parts) if generator else parts
    fitted = Preprocessor(s.key, s.imputation, s.scaling, s.target, keep=("split",)).fit(_part(parts, "train"))
    return _stored(fitted.transform(parts), base, "features"), generator, fitted


def choose_features(rows: DataFrame, s: Settings) -> list[str]:
    names = [c for c in numeric_columns(rows) if c not in (s.key, s.target)]
    if not s.select:
        return names
    names = select.kept_columns(select.variance_threshold(rows, names), names)
    return select.kept_columns(train.select_by_importance(rows, names, s.target, seed=s.seed), names)


def build(raw: DataFrame, base: str, s: Settings) -> Built:
    """Everything up to the promotion decision; reports are stored, too."""
    rows, generator, preprocessor = prepare(raw, base, s)
    fit_rows, held = _part(rows, "train"), _part(rows, "val")
    features = choose_features(fit_rows, s)
    reports: dict[str, DataFrame] = {}
    params = s.params
    if s.trials:
        reports["search"] = train.hyperparam_search(
            fit_rows, held, features, s.target, s.trials, s.metric, s.seed, replace(params, rounds=train.MOST_ROUNDS)
        )
        params = train.best_params(reports["search"], params)
    model = train.train_gbt(fit_rows, features, s.target, params, held)
    scores = _stored(train.score_table(model, rows, features, [s.key, s.target, "split"], "raw"), base, "scores")
    calibrator = None
    shown = "raw"
    if s.calibration:
        calibrator = calibrate.fit_calibrator(_part(scores, "val"), s.target, "raw", s.calibration)
        scores, shown = calibrator.transform(scores, "raw"), "calibrated"
    test = _part(scores, "test")
    found = metrics.all_metrics(test, s.target, shown)
    reports |= {
        "split": split.split_report(rows, s.target),
        "metrics": found,
        "gate": gates.promotion_gate(found),
        "classes": metrics.classification_report(test, s.target, shown),
        "roc": curves.roc_curve(test, s.target, shown),
        "precision_recall": curves.pr_curve(test, s.target, shown),
        "calibration": curves.calibration_curve(test, s.target, shown),
        "thresholds": curves.threshold_sweep(test, s.target, shown),
        "importance": train.model_importance(model, features),
    }
    for name, report in reports.items():
        tables.sink_report(report, base, f"report_{name}")
    snapshot.save_snapshot(
        f"{base}/reference",
        fit_rows.select(*features),
        reports["importance"],
        metrics.monitored_metrics(_part(scores, "train"), s.target, shown),
        s.max_snapshots,
    )
    built = Built(features, model, calibrator, reports, generator, preprocessor)
    save_built(built, base)
    return built


def monitor(built: Built, base: str, current: DataFrame, s: Settings) -> dict[str, DataFrame]:
    """Compare new, preprocessed rows with the stored reference; importance is found by a refit on them.

    Without labels in ``current`` there is only data drift to report.
    """
    spark = current.sparkSession
    reference = snapshot.load_snapshot(spark, f"{base}/reference")
    scores = drift.feature_drift(reference["data"], current.select(*built.features), s.drift_threshold)
    out = {"features": scores, "overall": drift.overall_drift(scores, reference["importance"])}
    if s.target not in current.columns:
        out["concept"] = drift.concept_drift(reference["metrics"], None)
        return out
    scored = train.score_table(built.model, current, built.features, [s.target], "raw")
    shown = "raw"
    if built.calibrator:
        scored, shown = built.calibrator.transform(scored, "raw"), "calibrated"
    now = metrics.monitored_metrics(scored, s.target, shown)
    refit = train.train_gbt(current, built.features, s.target, s.params)
    out["concept"] = drift.concept_drift(reference["metrics"], now, s.performance_threshold)
    out["changes"] = drift.metric_changes(reference["metrics"], now)
    found = train.model_importance(refit, built.features)
    out["importance"] = drift.importance_drift(reference["importance"], found, s.importance_threshold)
    out["alert"] = drift.drift_alert(scores, out["concept"], out["importance"])
    return out
