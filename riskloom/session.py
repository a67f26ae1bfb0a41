"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
SPREAD_SPLITS = 8
#: The open scope of the running thread or task, as the list of what was made in it.
_scope: ContextVar[list[str] | None] = ContextVar("riskloom_scope", default=None)


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates: ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own, since every task runs on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="riskloom-")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the work folder; two runs never share one. It goes with the ``scope`` around the call."""
    path = f"{work_root(spark)}/riskloom/{name}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system its path names; a missing one is fine."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: computed once, lineage cut, safe against lost executors.

    It stays until the ``scope`` around it ends, or for good where there is none.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession):
    """Delete every table and folder that was made below the work folder inside; consume the results before it ends.

    A scope belongs to its thread, so scopes of several threads, or of streams, keep out of each other's tables.
    """
    made: list[str] = []
    outer = _scope.get()
    _scope.set(made)
    try:
        yield
    finally:
        if _scope.get() is made:
            _scope.set(outer)
        for path in made:
            delete_folder(spark, path)


class Scratch:
    """Tables of one operator run, in one shared folder that goes when the block ends; results are kept with ``result``.

    Inside, Spark drops the shuffle files of each finished write, and Arrow batches stay small in rows and bytes.
    """

    SETTINGS = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    }

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.root = work_path(spark, name)
        self._before: dict[str, str | None] = {}

    def __enter__(self) -> Scratch:
        for key, value in self.SETTINGS.items():
            self._before[key] = self.spark.conf.get(key, None)
            self.spark.conf.set(key, value)
        return self

    def __exit__(self, *_) -> None:
        for key, value in self._before.items():
            if value is None:
                self.spark.conf.unset(key)
            else:
                self.spark.conf.set(key, value)
        delete_folder(self.spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame) -> DataFrame:
        """``df`` written outside the folder, so it outlives the block."""
        return written(df, self.name)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative estimators cut their lineage; keeps a folder that is already set."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{work_root(spark)}/checkpoints")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a scan of very few splits over the cores, so one small file does not keep all work in one task.

    A scan with more than ``SPREAD_SPLITS`` splits is left alone: what moves is bounded by that many split sizes.
    """
    splits = df.rdd.getNumPartitions()
    cores = df.sparkSession.sparkContext.defaultParallelism
    if splits > SPREAD_SPLITS or splits >= cores:
        return df
    return df.repartition(min(cores, 4 * SPREAD_SPLITS), *keys)


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` as a broadcast table if it has at most ``max_rows`` rows, else ``df`` itself for a shuffled join.

    The check fetches no more than ``max_rows + 1`` rows; when they are all of it they are reused, not recomputed.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
