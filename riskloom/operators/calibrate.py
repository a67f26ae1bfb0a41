"""Score calibration on held-out scores.

Both methods fit on one row per distinct score, so ties are pooled and the data shrinks before the fit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Calibrator:
    method: str
    model: Model

    def transform(self, df: DataFrame, score: str, name: str = "calibrated") -> DataFrame:
        order = df.columns
        if self.method == "isotonic":
            out = self.model.transform(df.withColumn("_x", F.col(score).cast("double")))
            value = F.col("_y")
        else:
            out = self.model.transform(VectorAssembler(inputCols=[score], outputCol="_x").transform(df))
            value = vector_to_array("_y")[1]
        # interpolation may end a rounding error outside the unit interval
        return out.select(*order, F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)).alias(name))


    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/{self.method}")

    @classmethod
    def load(cls, path: str, method: str) -> "Calibrator":
        kind = {"isotonic": IsotonicRegressionModel, "sigmoid": LogisticRegressionModel}[method]
        return cls(method, kind.load(f"{path}/{method}"))


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    return rows.groupBy(F.col(score).cast("double").alias("_x")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )


def fit_isotonic(df: DataFrame, label: str, score: str) -> Calibrator:
    """A non-decreasing step fit, linear between its points and flat outside."""
    n = F.col("pos") + F.col("neg")
    points = _by_score(df, label, score).select(
        "_x", (F.col("pos") / n).alias("share"), n.cast("double").alias("weight")
    )
    isotonic = IsotonicRegression(featuresCol="_x", labelCol="share", weightCol="weight", predictionCol="_y")
    return Calibrator("isotonic", isotonic.fit(points))


def fit_sigmoid(df: DataFrame, label: str, score: str) -> Calibrator:
    """Logistic fit of the score on smoothed targets: a positive counts (P+1)/(P+2), a negative 1/(N+2)."""
    by_score = _by_score(df, label, score)
    totals = by_score.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    high, low = (totals["p"] + 1.0) / (totals["p"] + 2.0), 1.0 / (totals["n"] + 2.0)
    ones = F.col("pos") * high + F.col("neg") * low
    zeros = F.col("pos") * (1 - high) + F.col("neg") * (1 - low)
    sides = F.array(
        F.struct(F.lit(1.0).alias("target"), ones.alias("weight")),
        F.struct(F.lit(0.0).alias("target"), zeros.alias("weight")),
    )
    rows = by_score.select("_x", F.inline(sides)).where(F.col("weight") > 0)
    rows = VectorAssembler(inputCols=["_x"], outputCol="x").transform(rows)
    logistic = LogisticRegression(
        featuresCol="x", labelCol="target", weightCol="weight", probabilityCol="_y", rawPredictionCol="_raw",
        predictionCol="_class", regParam=0.0, standardization=False, maxIter=100, tol=1e-9,
    )
    model = logistic.fit(rows)
    return Calibrator("sigmoid", model.setFeaturesCol("_x"))


METHODS = {"isotonic": fit_isotonic, "sigmoid": fit_sigmoid}


def fit_calibrator(df: DataFrame, label: str, score: str, method: str = "isotonic") -> Calibrator:
    if method not in METHODS:
        raise ValueError(f"unknown calibration method {method!r}")
    return METHODS[method](df, label, score)


def isotonic_points(calibrator: Calibrator) -> DataFrame:
    """The fitted map as a table: ``(score, calibrated)`` at each of its corners."""
    from pyspark.sql import SparkSession

    model = calibrator.model
    pairs = list(zip(model.boundaries.toArray().tolist(), model.predictions.toArray().tolist()))
    return SparkSession.active().createDataFrame(pairs, "score double, calibrated double")
