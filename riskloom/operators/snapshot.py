"""The stored reference a current table is compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators import drift
from riskloom.sources import tables

PARTS = ("data", "numeric_stats", "categorical_stats", "importance", "metrics")


def save_snapshot(
    base: str,
    data: DataFrame,
    importance: DataFrame | None = None,
    metrics: DataFrame | None = None,
    keep: int = tables.KEPT_VERSIONS,
) -> dict[str, int]:
    """Write the reference rows, their statistics, and importance and metric tables when there are any.

    Each part is a versioned table; only the newest ``keep`` versions stay.
    """
    parts = {"data": data, **drift.reference_stats(data)}
    if importance is not None:
        parts["importance"] = importance
    if metrics is not None:
        parts["metrics"] = metrics
    return {name: tables.sink_table(df, base, name, keep=keep) for name, df in parts.items()}


def load_snapshot(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The latest version of every part that was stored."""
    return {name: tables.scan_table(spark, base, name) for name in PARTS if tables.versions(spark, base, name)}
