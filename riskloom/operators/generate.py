"""Derived features as DataFrame operators and as a fitted ML stage."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import derive


def ratio_features(df: DataFrame) -> DataFrame:
    return df.withColumns(derive.ratios(df.columns))


def interaction_features(df: DataFrame) -> DataFrame:
    return df.withColumns(derive.interactions(df.columns))


def squared_features(df: DataFrame) -> DataFrame:
    return df.withColumns(derive.squares(df.columns))


def fit_risk_bounds(df: DataFrame) -> dict[str, tuple[float | None, float | None]]:
    """Smallest and largest value of each risk column that is present: one aggregate, one row."""
    used = [c for c in derive.RISK_COLUMNS if c in df.columns]
    if not used:
        return {}
    aggregates = [f(c).cast("double") for c in used for f in (F.min, F.max)]
    row = df.agg(*[a.alias(f"v{i}") for i, a in enumerate(aggregates)]).first()
    return {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(used)}


def composite_risk_score(
    df: DataFrame, bounds: dict[str, tuple[float | None, float | None]] | None = None
) -> DataFrame:
    score = derive.risk_score(fit_risk_bounds(df) if bounds is None else bounds)
    return df if score is None else df.withColumn("composite_risk_score", score)


def generated_feature_names(before: DataFrame, after: DataFrame) -> DataFrame:
    known = set(before.columns)
    rows = [(i, c, c not in known) for i, c in enumerate(after.columns)]
    return before.sparkSession.createDataFrame(rows, "position int, name string, generated boolean")


class _FeatureFlags(Params):
    enableRatios = Param(Params._dummy(), "enableRatios", "add the ratio features", TypeConverters.toBoolean)
    enableInteractions = Param(
        Params._dummy(), "enableInteractions", "add the interaction features", TypeConverters.toBoolean
    )

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(enableRatios=True, enableInteractions=True)


class FeatureGenerator(Estimator, _FeatureFlags, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the risk-score bounds; the model then adds every derived feature in one projection."""

    @keyword_only
    def __init__(self, *, enableRatios: bool = True, enableInteractions: bool = True) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "FeatureGeneratorModel":
        model = FeatureGeneratorModel()
        model._set(
            enableRatios=self.getOrDefault(self.enableRatios),
            enableInteractions=self.getOrDefault(self.enableInteractions),
            riskBounds=json.dumps(fit_risk_bounds(dataset)),
        )
        return model


class FeatureGeneratorModel(Model, _FeatureFlags, DefaultParamsReadable, DefaultParamsWritable):
    riskBounds = Param(Params._dummy(), "riskBounds", "fitted bounds as JSON", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(riskBounds="{}")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        present = dataset.columns
        new = {}
        if self.getOrDefault(self.enableRatios):
            new |= derive.ratios(present)
        if self.getOrDefault(self.enableInteractions):
            new |= derive.interactions(present)
        new |= derive.squares(present)
        bounds = {c: tuple(b) for c, b in json.loads(self.getOrDefault(self.riskBounds)).items() if c in present}
        score = derive.risk_score(bounds)
        if score is not None:
            new["composite_risk_score"] = score
        return dataset.withColumns(new) if new else dataset
