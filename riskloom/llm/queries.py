"""A query for each operator over its whole table, and its SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import (
    alignment, language, lexical, minhash, mixing, neighbours, packing, secretscan, sharding, suffixes, tokencounts, topk, warc,
)
from riskloom.llm.oracle import ORACLE

TOKENIZERS = corpus_pipeline.TOKENIZERS
PIECES = str(Path(TOKENIZERS) / "piece_bpe_32k.model")
WORDS = str(Path(TOKENIZERS) / "word_bpe_49k.json")
BYTES = str(Path(TOKENIZERS) / "byte_bpe_50k.json")

__all__ = ["ORACLE", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(_table(spark, sf_dir, "documents"), PIECES)


def op2_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(_table(spark, sf_dir, "embeddings"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.learn(docs)
    found = docs.select(
        "doc_id",
        language.held_out(F.col("doc_id")).alias("held_out"),
        language.identify(F.col("text"), model).alias("found"),
    )
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.rates(_table(spark, sf_dir, "documents"))
    taken = (F.col("mix.copies") * F.col("mix.size")).alias("taken")
    return mixed.select("row.doc_id", "mix.size", "mix.source_size", "mix.target", taken)


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated_bytes(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shuffled(_table(spark, sf_dir, "documents"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return placed.select(
        F.col("row.doc_id").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), WORDS)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.scan(_table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in secretscan.KINDS])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x.kind], x.start, x.end)), ",")

    base = F.filter("spans", lambda x: x.kind < 3)
    counts = [F.size(F.filter("spans", lambda x: x.kind == i)).cast("long").alias(f"n_{k}") for i, k in enumerate(secretscan.KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = alignment.aligned(_table(spark, sf_dir, "documents"), BYTES, PIECES, digest=True)
    return docs.withColumnRenamed("groups", "groups_sha256")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_top_products, op3_language, op4_near_duplicates, op5_mixing, op6_near_vectors,
        op7_repeated_bytes, op8_sharding, op9_warc, op10_packing, op11_secret_scan, op12_alignment, op13_lexical_search,
    )
} | {"pipeline": corpus_pipeline.run}
