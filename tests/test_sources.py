"""Versions by several writers, archives as streams, strata by the hundred thousand."""

import gzip
import io
import re
import threading
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ordered, split
from riskloom.sources import loan_csv, tables


def test_concurrent_writers_get_a_version_each(spark, tmp_path):
    base, got = f"file:{tmp_path}", []
    gate = threading.Barrier(4)

    def write(n):
        df = spark.range(n + 1)
        gate.wait(60)
        got.append((tables.sink_table(df, base, "t"), n + 1))

    threads = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(v for v, _ in got) == tables.versions(spark, base, "t") == [1, 2, 3, 4]
    assert all(tables.scan_table(spark, base, "t", version=v).count() == n for v, n in got)


def test_a_taken_number_is_left_alone(spark, tmp_path, monkeypatch):
    """A writer that saw an older listing takes the next free number, also where a rename moves into a folder."""
    base = f"file:{tmp_path}"
    assert tables.sink_table(spark.range(3), base, "t") == 1
    real = tables.versions
    monkeypatch.setattr(tables, "versions", lambda *a: [])
    assert tables.sink_table(spark.range(5), base, "t") == 2
    monkeypatch.setattr(tables, "versions", real)
    assert [tables.scan_table(spark, base, "t", version=v).count() for v in (1, 2)] == [3, 5]


class Watched(io.BytesIO):
    """A stream that forbids large reads and counts what is read."""

    seen = 0

    def read(self, size=-1):
        data = super().read(size)
        assert len(data) <= 1 << 20, "a full read"
        self.seen += len(data)
        return data


def test_archives_are_read_as_streams():
    rng = np.random.default_rng(1)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("a.bin", rng.bytes(8 << 20))
        archive.writestr("loans.csv", "banner\nx,y\n" + "".join(f"{i},{i % 7}\n" for i in range(25_000)))
    stream = Watched(packed.getvalue())
    batches = list(loan_csv.member_rows(stream, "loans.zip", 1))
    assert [len(b) for b in batches] == [10_000, 10_000, 5_000] and batches[2]["x"].iloc[-1] == "24999"
    assert stream.seen < 1 << 20
    with pytest.raises(ValueError, match="no CSV"):
        empty = io.BytesIO()
        zipfile.ZipFile(empty, "w").close()
        list(loan_csv.member_rows(empty, "empty.zip", 1))


def test_an_archive_without_lines_has_no_rows(spark, tmp_path):
    """The first task writes its file also when it has no rows."""
    for text in ("", "banner\n"):
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            archive.writestr("loans.csv", text)
        assert list(loan_csv.member_rows(packed, "loans.zip", 1)) == []
    rows = spark.range(0, 4, 1, 4).where("id > 0").selectExpr("cast(id as string) as id", "id * 2 as loan_amnt")
    files, archives = f"file:{tmp_path}/files", f"file://{tmp_path}/zip"
    loan_csv.write_loan_files(rows, files)
    assert any(not gzip.open(p).read() for p in (tmp_path / "files").glob("*.txt.gz"))
    assert loan_csv.pack_files(spark, files, archives).count() == 4
    got = loan_csv.scan_zip_csv(spark, archives).select("id", "loan_amnt").collect()
    assert sorted(map(tuple, got)) == [("1", "2"), ("2", "4"), ("3", "6")]


def test_global_rank_with_nulls_and_no_rows(spark):
    rows = [(f"s{i * 37 % 500:03d}",) for i in range(500)] + [(None,)]
    df = spark.createDataFrame(rows, "s string")
    got = {r.s: r.place for r in ordered.global_rank(df, [F.col("s").asc_nulls_first()]).collect()}
    assert got[None] == 1 and all(got[f"s{i:03d}"] == i + 2 for i in range(500))
    assert ordered.global_rank(df.limit(0), [F.col("s").asc()]).count() == 0


def test_many_strata(spark):
    """As many strata as fit no single task's window: totals are exact and each stratum gets its floor or one more."""
    n = 300_000
    df = spark.range(n).select("id", F.when(F.col("id") % 1000 != 0, F.concat(F.lit("s"), (F.col("id") % 200_001).cast("string"))).alias("s"))
    sizes = df.groupBy(F.col("s").alias("stratum")).agg(F.count(F.lit(1)).alias("n"))
    quotas = split._quotas(sizes, "drawn", 0.2)
    assert "SinglePartition" not in quotas.select("stratum")._jdf.queryExecution().toString()
    exact = F.col("n") * 0.2
    seen = quotas.agg(
        F.sum("drawn").alias("drawn"), F.count(F.lit(1)).alias("strata"),
        F.count_if((F.col("drawn") < F.floor(exact)) | (F.col("drawn") > F.floor(exact) + 1)).alias("bad"),
    ).first()
    assert (seen.drawn, seen.bad) == (60_000, 0) and seen.strata == sizes.count()
    labelled = split.split_rows(df, ["id"], seed=7, stratum="s").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in labelled} == split.expected_sizes(n, 0.2, 0.25)


def test_loan_files_are_bounded_and_packed_as_streams(spark, tmp_path):
    """Every file of a task has its banner and few rows, takes less room than its text, and no row holds a whole file."""
    df = spark.range(0, 1000, 1, 2).select(F.concat(F.lit(" r"), "id").alias("id"), (F.col("id") * 3).alias("loan_amnt"))
    raw, packed = f"file:{tmp_path}/raw", f"file:{tmp_path}/zip"
    loan_csv.write_loan_files(df, raw, spark.createDataFrame([("Total",)], "note string"), file_rows=150)
    files = sorted((tmp_path / "raw").glob("*.txt.gz"))
    texts = [gzip.decompress(f.read_bytes()).decode() for f in files]
    assert len(files) == 9 and all(t.startswith("Loan records") and t.count("\n") <= 152 for t in texts)
    assert sum(f.stat().st_size for f in files) < sum(map(len, texts)) / 3
    want = sorted((r.id, str(r.loan_amnt)) for r in df.collect())
    work = loan_csv.pack_files(spark, raw, packed)
    assert re.search(r"FileScan binaryFile \[path#\d+\]", work._jdf.queryExecution().executedPlan().toString())
    assert work.count() == 9
    for rows in (loan_csv.scan_loan_csv(spark, raw), loan_csv.scan_zip_csv(spark, packed)):
        assert rows.count() == 1001
        assert sorted(tuple(r) for r in loan_csv.drop_note_rows(rows).select("id", "loan_amnt").collect()) == want


def test_archives_are_written_as_streams():
    text = b"banner\nx,y\n" + b"".join(b"%d,%d\n" % (i, i % 7) for i in range(400_000))
    source, out = Watched(text), io.BytesIO()
    loan_csv.pack_stream(source, out, "loans.csv")
    assert source.seen == len(text) > 3 << 20
    assert zipfile.ZipFile(out).read("loans.csv") == text
