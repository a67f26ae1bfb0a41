"""Encoding string columns against their sorted distinct values."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import BROADCAST_ROWS, checked_broadcast, ensure_checkpoint_dir

#: Columns that one string column may become.
MOST_DENSE = 10_000
UNKNOWN = -1


def ordered_codes(values: DataFrame, column: str) -> DataFrame:
    """``(column, code)``: each distinct value with its place in sorted order, from 0, for any number of values.

    A global sort leaves consecutive ids inside each partition; partition sizes (a few rows) turn them into places.
    The sorted table is checkpointed, so both reads of it see the same partitions.
    """
    ensure_checkpoint_dir(values.sparkSession)
    ids = values.orderBy(column).withColumn("id", F.monotonically_increasing_id()).checkpoint()
    ids = ids.select(column, F.shiftright("id", 33).alias("part"), F.expr("id & 8589934591").alias("place"))
    sizes = ids.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # one row per partition of the sort
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    return ids.join(F.broadcast(starts), "part").select(column, (F.col("start") + F.col("place")).alias("code"))


def fit_categories(df: DataFrame, column: str, max_collected: int = BROADCAST_ROWS) -> DataFrame:
    """``(column, code)`` of a column's values. Up to ``max_collected`` values are numbered on the driver and
    broadcast; beyond that they are numbered by a distributed sort and joined by a shuffle."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    rows = values.limit(max_collected + 1).collect()
    if len(rows) > max_collected:
        return ordered_codes(values, column)
    # binary order, the same order the engine sorts strings in
    ranked = sorted((r[0] for r in rows), key=lambda v: v.encode("utf-8"))
    schema = f"`{column}` string, code bigint"
    return F.broadcast(df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(ranked)], schema))


def fit_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value, code)``: the codes of several columns as one table that can be stored."""
    found = df.sparkSession.createDataFrame([], "feature string, value string, code bigint")
    for c in columns:
        codes = fit_categories(df, c)
        found = found.unionByName(codes.select(F.lit(c).alias("feature"), codes[0].alias("value"), "code"))
    return found


def apply_codes(df: DataFrame, columns: Sequence[str], codes: DataFrame) -> DataFrame:
    """Values -> their codes of ``fit_codes``; a value the fit has not seen, or null, becomes -1."""
    order = df.columns
    for c in columns:
        own = codes.where(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        joined = df.join(checked_broadcast(own), F.col(quoted(c)) == F.col("_value"), "left")
        code = F.coalesce("_code", F.lit(UNKNOWN)).cast("int")
        df = joined.select(*[code.alias(o) if o == c else F.col(quoted(o)) for o in order])
    return df


def encode_ordinal(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Values -> 0, 1, 2 … in sorted order; a value the fit has not seen, or null, becomes -1."""
    return apply_codes(df, columns, fit_codes(df if fit_on is None else fit_on, columns))


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def onehot_name(column: str, value: str) -> str:
    """A name that no other column and value share and that needs no quoting: what is not a letter, digit or blank of the
    value is percent-encoded, underscores included."""
    safe = quote(value, safe=" ")
    for c in "_.-~":
        safe = safe.replace(c, f"%{ord(c):02X}")
    return f"{column}_{safe}"


def fit_onehot(df: DataFrame, columns: Sequence[str], most: int = MOST_DENSE) -> dict[str, list[str]]:
    """The sorted values of each column. More than ``most`` values in a column are an error, never another encoding."""
    found = {}
    for c in columns:
        name = quoted(c)
        rows = df.where(F.col(name).isNotNull()).select(name).distinct().limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{c} has more than {most} values; encode it by its order (encode_ordinal) instead")
        found[c] = sorted((r[0] for r in rows), key=lambda v: v.encode("utf-8"))
    return found


def apply_onehot(df: DataFrame, fitted: dict[str, list[str]]) -> DataFrame:
    """One 0/1 column per value of ``fit_onehot`` in place of each column; unknown values and nulls are all zeros.

    A column that is not encoded but named like a flag is an error.
    """
    flags = {}
    for c, values in fitted.items():
        for v in values[1:] if len(values) == 2 else values:
            flags[onehot_name(c, v)] = F.coalesce((F.col(quoted(c)) == v).cast("double"), F.lit(0.0))
    rest = [o for o in df.columns if o not in fitted]
    if clash := sorted(set(rest) & set(flags)):
        raise ValueError(f"columns named like one-hot columns: {clash}")
    return df.select(*[F.col(quoted(o)) for o in rest], *[f.alias(n) for n, f in flags.items()])


def encode_onehot(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, most: int = MOST_DENSE
) -> DataFrame:
    """One 0/1 column per value, named by ``onehot_name``, in place of each column; two values give one column, for the
    larger. Unknown values and nulls are all zeros. The form is the same at every size."""
    return apply_onehot(df, fit_onehot(df if fit_on is None else fit_on, columns, most))
