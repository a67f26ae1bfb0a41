"""Versioned tables and report files.

A table is a directory ``base/name/version=N`` of Parquet files; the highest version is the latest.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEPT_VERSIONS = 10


def _folder(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def versions(spark: SparkSession, base: str, name: str) -> list[int]:
    """Complete versions, oldest first."""
    fs, path = _folder(spark, f"{base}/{name}")
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        label = status.getPath().getName()
        done = _folder(spark, f"{base}/{name}/{label}/_SUCCESS")[1]
        if label.startswith("version=") and fs.exists(done):
            found.append(int(label.split("=", 1)[1]))
    return sorted(found)


def _publish(spark: SparkSession, draft: str, target: str, mark: str) -> bool:
    """Rename a finished draft to ``target`` unless that exists; whether it became the target.

    Some stores move a folder into an existing one instead of failing, so the draft's own mark must be seen in place.
    """
    fs, source = _folder(spark, draft)
    _, goal = _folder(spark, target)
    if fs.exists(goal):
        return False
    fs.rename(source, goal)
    if fs.exists(_folder(spark, f"{target}/{mark}")[1]):
        return True
    astray = _folder(spark, f"{target}/{source.getName()}")[1]
    if fs.exists(astray):
        fs.rename(astray, source)
    if not fs.exists(source):
        raise OSError(f"{draft} is gone and {target} is not its table")
    return False


def sink_table(df: DataFrame, base: str, name: str, fmt: str = "parquet", keep: int | None = None) -> int:
    """Write the next version and return its number; with ``keep``, drop all but the newest ``keep`` versions.

    The rows go to a draft of its own first. The draft then claims the next number by a rename that does not replace
    anything, and tries the one after if another writer was faster: every writer ends with a version of its own, and
    readers see whole versions only. The store must rename folders (object stores without that need a committer).
    """
    spark = df.sparkSession
    label = uuid.uuid4().hex
    draft, mark = f"{base}/{name}/_draft-{label}", f"_writer-{label}"
    writer = df.write.mode("errorifexists").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(draft)
    fs, marked = _folder(spark, f"{draft}/{mark}")
    fs.create(marked).close()
    version = (versions(spark, base, name) or [0])[-1] + 1
    while not _publish(spark, draft, f"{base}/{name}/version={version}", mark):
        version += 1
    if keep is not None:
        for old in versions(spark, base, name)[:-keep]:
            fs, path = _folder(spark, f"{base}/{name}/version={old}")
            fs.delete(path, True)
    return version


def scan_table(
    spark: SparkSession,
    base: str,
    name: str,
    version: int | None = None,
    columns: list[str] | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """A version of a table, the latest by default."""
    if version is None:
        known = versions(spark, base, name)
        if not known:
            raise FileNotFoundError(f"no version of {name} below {base}")
        version = known[-1]
    reader = spark.read.format(fmt)
    reader = reader.schema(schema) if schema is not None else reader
    reader = reader.option("header", True) if fmt == "csv" else reader
    df = reader.load(f"{base}/{name}/version={version}")
    return df.select(*columns) if columns else df


def sink_report(df: DataFrame, base: str, name: str, fmt: str = "json") -> int:
    """Write a report as JSON lines, or as CSV with nested values as JSON text."""
    if fmt == "csv":
        nested = (T.ArrayType, T.MapType, T.StructType)
        df = df.select(
            *[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema]
        )
    return sink_table(df, base, name, fmt)
