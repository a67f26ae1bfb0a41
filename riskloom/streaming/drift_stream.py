"""Drift scores for batches of rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators import drift
from riskloom.session import scope


def stream_drift(
    reference: drift.GroupedReference,
    arriving: DataFrame,
    out_path: str,
    checkpoint: str,
    threshold: float = drift.DRIFT_THRESHOLD,
) -> StreamingQuery:
    """Compare every micro-batch of ``arriving`` with ``reference`` (from ``drift.group_reference``) and store its feature
    scores. A batch reads itself and the grouped reference only.

    A batch writes its own ``batch_id=N`` directory in overwrite mode, so a batch that runs again after a failure
    replaces its earlier result.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            with scope(batch.sparkSession):
                rows = batch.select(*reference.schema.names)
                scores = drift.grouped_feature_drift(reference, rows, threshold)
                scores.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (
        arriving.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drift_history(spark: SparkSession, out_path: str) -> DataFrame:
    """All stored scores, with the number of the batch they belong to."""
    return spark.read.parquet(out_path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
