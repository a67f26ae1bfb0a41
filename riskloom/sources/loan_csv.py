"""Raw loan files: CSV with a banner line above the header and note lines among the rows, plain or zipped."""

from __future__ import annotations

import io
import re
import shutil
import uuid
import zipfile
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schema import LOAN_COLUMNS, string_schema

ZIP_BATCH = 10_000
#: Rows of a written loan file, some 60 MB of text: files are compressed, so one is the unit of parallelism.
FILE_ROWS = 200_000
PIECE = 1 << 20
_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _header_line(spark: SparkSession, path: str, skip_rows: int) -> list[str]:
    """Column names from the first file; a top-k read of a few lines."""
    first = spark.read.text(path).select("value").head(skip_rows + 1)[-1][0]
    return next(iter(pd.read_csv(io.StringIO(first), header=None, dtype=str).values.tolist()))


def scan_loan_csv(
    spark: SparkSession, path: str, skip_rows: int = 1, columns: list[str] | None = None
) -> DataFrame:
    """All columns as strings, from files that each start with ``skip_rows`` (0 or 1) banner lines and a header.

    The reader's own header handling drops the first line of every file at its first split, so files stay
    splittable. With a banner that first line is the banner, and the header line left behind is filtered by value.
    """
    if skip_rows not in (0, 1):
        raise ValueError("skip_rows must be 0 or 1")
    names = columns or _header_line(spark, path, skip_rows)
    reader = spark.read.schema(string_schema(names)).option("header", True).option("enforceSchema", True)
    df = reader.csv(path)
    if skip_rows == 0:
        return df
    is_header = F.lit(True)
    for c in names[:3]:
        is_header = is_header & F.col(c).eqNullSafe(F.lit(c))
    return df.where(~is_header)


def member_rows(stream: BinaryIO, name: str, skip_rows: int) -> Iterator[pd.DataFrame]:
    """The rows of the first ``*.csv`` member of a zip archive, in batches.

    Only the directory at the end of the stream and the member itself are read, and the member is inflated piece by
    piece, so memory depends on the batch and not on the archive. A member without a header has no rows.
    """
    with zipfile.ZipFile(stream) as archive:
        members = sorted(m for m in archive.namelist() if m.lower().endswith(".csv"))
        if not members:
            raise ValueError(f"no CSV file in {name}")
        with archive.open(members[0]) as lines:
            try:
                chunks = pd.read_csv(
                    lines, skiprows=skip_rows, dtype=str, keep_default_na=False, chunksize=ZIP_BATCH, na_values=[""]
                )
            except pd.errors.EmptyDataError:  # Spark writes an empty file where the first task has no rows
                return
            yield from chunks


def scan_zip_csv(
    spark: SparkSession, path: str, skip_rows: int = 1, columns: list[str] | None = None
) -> DataFrame:
    """The first ``*.csv`` member of each zip archive, one task per archive, read as a stream in batches.

    A zip archive cannot be split, so files are the unit of parallelism. Archives may be of any size; they must be in a
    store that ``pyarrow.fs`` knows.
    """
    names = columns or LOAN_COLUMNS
    schema = string_schema(names)

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for name in batch["path"]:
                store, place = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", name))
                with store.open_input_file(place) as stream:
                    for chunk in member_rows(stream, name, skip_rows):
                        yield chunk.reindex(columns=names).astype(object).where(lambda d: d.notna(), None)

    # the path alone: the reader does not open the files
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path")
    return archives.repartition(_tasks(spark), "path").mapInPandas(unzip, schema)


def pack_stream(source: BinaryIO, out: BinaryIO, member: str) -> None:
    """``source`` as the one member of a zip archive written to ``out``, piece by piece."""
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive, archive.open(member, "w", force_zip64=True) as packed:
        shutil.copyfileobj(source, packed, PIECE)


def pack_files(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Zip every ``*.txt`` file below ``path``, plain or ``*.txt.gz``, into an archive of its own in the shared folder
    ``target``; running the returned table of archive names does the work. Files are streams, so memory does not depend on
    their size."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(target)
        store.create_dir(folder)
        for batch in batches:
            names = []
            for name in batch["path"]:
                files, place = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", name))
                stem = re.sub(r"\.txt(\.gz)?$", "", name.rsplit("/", 1)[-1])
                names.append(f"{target}/{stem}.zip")
                # written under a name of its own first, so a task that runs twice leaves one whole archive
                draft = f"{folder}/{stem}.{uuid.uuid4().hex}"
                with files.open_input_stream(place, compression="detect") as source, store.open_output_stream(draft) as out:
                    pack_stream(source, out, f"{stem}.csv")
                store.move(draft, f"{folder}/{stem}.zip")
            yield pd.DataFrame({"archive": names})

    # the path alone: the reader does not open the files
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt{,.gz}").load(path).select("path")
    return files.repartition(_tasks(spark), "path").mapInPandas(pack, "archive string")


def _tasks(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def drop_note_rows(df: DataFrame, mode: str = "data", amount: str = "loan_amnt") -> DataFrame:
    """Drop what is not a loan.

    ``data`` keeps the rows with a numeric amount. ``literal`` keeps the rows whose first column is present, which on
    files without ids is the reverse; it is there to reproduce tables made that way.
    """
    if mode == "literal":
        return df.where(F.col(df.columns[0]).isNotNull())
    if mode == "data":
        return df.where(F.col(amount).try_cast("double").isNotNull())
    raise ValueError(f"unknown mode {mode!r}")


def write_loan_files(
    loans: DataFrame, path: str, notes: DataFrame | None = None, file_rows: int = FILE_ROWS
) -> None:
    """Write a loan table in the raw layout: per file a banner line, the header, then at most ``file_rows`` rows.

    Files are compressed (``*.txt.gz``), as most cells are empty. ``notes`` is a one-column table of note lines; they go to
    files of their own.
    """
    have = set(loans.columns)
    cells = [(F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c) for c in LOAN_COLUMNS]
    # blanks belong to the values
    rows = loans.select(F.to_csv(F.struct(*cells), _KEEP_BLANKS).alias("line"))
    if notes is not None:
        empty = "," * (len(LOAN_COLUMNS) - 1)
        rows = rows.unionByName(notes.toDF("line").select(F.concat(F.to_csv(F.struct("line")), F.lit(empty)).alias("line")))
    start = "Loan records of the period, all amounts in USD\n" + ",".join(LOAN_COLUMNS) + "\n"
    # a task starts a file with its first row and again after every ``file_rows`` rows
    first = F.expr(f"(monotonically_increasing_id() & 8589934591) % {file_rows}") == 0
    lines = rows.select(F.when(first, F.concat(F.lit(start), "line")).otherwise(F.col("line")))
    out = lines.write.option("maxRecordsPerFile", file_rows).option("compression", "gzip")
    out.option("zlib.compress.level", "BEST_SPEED").text(path)
