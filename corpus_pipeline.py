"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again for the next one.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import language, minhash, mixing, packing, suffixes
from riskloom.llm.texts import fingerprint
from riskloom.session import written

#: Folder of the public tokenizer files.
TOKENIZERS = "/opt/tokenizers"
NEAR_PERCENT = 80

#: The stages compress, hash and sort in ways that SQL does not state; tests compare each with a brute-force version.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart, by what the labelled ones among them teach."""
    return language.in_known_language(docs, language.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: a row of the smallest id.

    Where several rows of a group have that id, or none has an id, one text of them is taken, and one row of it.
    Documents without words are no copies of each other and all stay.
    """
    names = docs.columns
    found = minhash.near_duplicates(docs, percent=NEAR_PERCENT).where("kept").withColumnRenamed("doc_id", "id")
    blank = found.where("component is null").select("id", "k1", "k2", F.lit(1).cast("long").alias("copies")).distinct()
    texts = found.where("component is not null").groupBy("component", "id", "k1", "k2").agg(F.count("*").alias("copies"))
    first = texts.groupBy("component").agg(F.min(F.struct("id", "k1", "k2", "copies")).alias("first"))
    stay = blank.union(first.select("first.*")).toDF("id", "t1", "t2", "copies")

    rows = docs.select(F.struct(*names).alias("row"), F.col("doc_id").cast("long").alias("doc"), *fingerprint(F.col("text")))
    same = F.col("doc").eqNullSafe(F.col("id")) & (F.col("k1") == F.col("t1")) & (F.col("k2") == F.col("t2"))
    kept = rows.join(stay, same)
    once = kept.where("copies > 1").groupBy("doc", "k1", "k2").agg(F.first("row").alias("row"))
    return kept.where("copies = 1").select("row").union(once.select("row")).select("row.*")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the byte strings it shares with others or repeats; ``n_chars`` follows the text."""
    cut = suffixes.cut_texts(docs).select("k1", "k2", "n_removed", "kept_text")
    changed = cut.where("n_removed > 0").select(F.col("k1").alias("t1"), F.col("k2").alias("t2"), "kept_text")
    rows = docs.select(F.struct(*docs.columns).alias("row"), *fingerprint(F.col("text")))
    rows = rows.join(changed, (F.col("k1") == F.col("t1")) & (F.col("k2") == F.col("t2")), "left")
    text = F.coalesce("kept_text", "row.text")
    fresh = {"text": text, "n_chars": F.when(F.col("kept_text").isNull(), F.col("row.n_chars")).otherwise(F.length(text))}
    return rows.select(*[fresh[c].alias(c) if c in fresh else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out until the sources have their weights."""
    return mixing.emit(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its sequence and its place there."""
    return packing.pack(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the ``documents`` below ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
