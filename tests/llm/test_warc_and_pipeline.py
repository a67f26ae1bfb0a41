"""Round trips of web archives, and the stages of the pipeline on their own inputs."""

import gzip
import hashlib
from collections import Counter

import pytest
from llm_words import words
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import minhash, suffixes, warc
from riskloom.session import Scratch

SF = "/root/testdata/sf0.001"
EXTRA = "digest string, first int, record_id int, bytes int"


@pytest.fixture
def pages(spark):
    long_page = words(200_000, 8)  # over a chunk
    page = "<p>" + "x" * 120
    rows = [
        (1, "http://a", page), (2, None, page), (3, "http://b\r\nX-Evil: 1", page), (None, "u", page),
        (4, "http://c", None), (5, "http://c", ""), (6, "http://d", "short"), (7, "http://d", "short"),
        (8, "http://é", long_page), (9, "http://e", long_page), (9, "http://e", long_page),
        (10, "http://f", "a\r\n\r\nWARC/1.1\r\n\r\n" * 9), (11, "u", "é" * 50), (12, "u", "é" * 50),
        (13, "u", "y" * 99), (14, "u", "y" * 99), (15, "u", "own"), (15, "u", "own"),
        (20, "u", page + "!"), (20, "u", page + "!"),
    ]
    return spark.createDataFrame([r + ("d", 1, 2, 3) for r in rows], f"page_id long, url string, html string, {EXTRA}")


def brute(pages):
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    out = Counter()
    for page_id, raw in rows:
        same = [i for i, other in rows if other == raw and i is not None]
        first = min(same) if len(raw) >= 100 and same else None
        revisit = first is not None and first != page_id
        digest = hashlib.sha256(raw).hexdigest()
        out[page_id, len(raw), digest, "revisit" if revisit else "response", first if revisit else None] += 1
    return out


@pytest.mark.parametrize("archive_bytes", [1, 64 << 20])
def test_round_trip(pages, archive_bytes):
    got = warc.round_trip(pages.repartition(3), archive_bytes).collect()
    assert all(r.intact for r in got)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == brute(pages)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_chunks_and_format(spark, pages):
    with Scratch(spark, "test") as scratch:
        files = warc.write_archives(pages, scratch.path("archives"), scratch)
        rows = warc.read_archives(files).collect()
        paths = [r.file for r in files.collect()]
        records = {(p, i): m for p in paths for i, m in enumerate(_members(p.removeprefix("file:")))}
    assert len(records) == pages.count()
    payloads = {}
    for r in sorted(rows, key=lambda r: (r.file, r.record, r.chunk)):
        payload = payloads.setdefault((r.file, r.record), b"")
        assert r.at == len(payload) and len(r.data) <= warc.CHUNK_BYTES
        payloads[r.file, r.record] = payload = payload + r.data
        assert hashlib.sha256(payload).hexdigest() == r.digest
    assert max(r.chunk for r in rows) > 1
    for key, (head, body) in records.items():
        assert body.startswith(warc.HTTP_HEAD) and len(body) == int(head["Content-Length"])
        assert payloads[key] == body[len(warc.HTTP_HEAD) :]
    assert "X-Evil" not in {name for head, _ in records.values() for name in head}


def _members(path):
    """Records by the standard library: header fields and block."""
    data = gzip.open(path).read()
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        yield fields, rest[:n]
        data = rest[n + 4 :]


# pipeline


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name


def test_stages_of_odd_rows(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0, name
    for (_, stage), n in zip(corpus_pipeline.STAGES[1:3], (None, odd_docs.count())):
        df = stage(spark, odd_docs.withColumn("n_chars", F.length("text")), SF)
        assert n is None or df.count() == n


def test_one_document_of_each_group_stays(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text", "lang", "source")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted((r.doc_id for r in kept if r.doc_id), key=int) == [1, 2, 3, 4, 6, 8, 9, 9, 10, 11]
    assert all(r.doc_id is not None for r in kept)  # those without an id are near copies of document 9
    found = minhash.near_duplicates(spark.createDataFrame(kept, docs.schema), percent=corpus_pipeline.NEAR_PERCENT)
    assert found.where("not kept").count() == 0


def test_cut_passages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cut = {r.doc_id: r for r in corpus_pipeline.cut_repeated_passages(spark, docs, SF).collect()}
    want = {r.doc_id: r for r in suffixes.repeated_bytes(docs).collect()}
    for r in docs.collect():
        raw, edges = r.text.encode(), want[r.doc_id].spans
        edges = [0, *edges, len(raw)]
        kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
        assert cut[r.doc_id].text == kept.decode("utf-8", "ignore")
        assert cut[r.doc_id].n_chars == (r.n_chars if cut[r.doc_id].text == r.text else len(cut[r.doc_id].text))


def test_run_packs_what_the_stages_leave(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    packed = corpus_pipeline.run(spark, SF)
    assert Counter(r.doc_id for r in packed.where("piece = 0").collect()) == Counter(r.doc_id for r in docs.collect())
