"""Decisions on top of the metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed value: the AUC a model must reach on the test rows
PROMOTION_AUC = 0.80


def promotion_gate(metrics: DataFrame, minimum: float = PROMOTION_AUC) -> DataFrame:
    """``metrics`` has a ``roc_auc`` column; an undefined AUC does not promote."""
    return metrics.select(
        "roc_auc",
        F.lit(minimum).alias("minimum"),
        F.coalesce(F.col("roc_auc") >= minimum, F.lit(False)).alias("promote"),
    )
