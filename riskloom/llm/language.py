"""Language identification by compression.

A language is a raw-content zstandard dictionary of sample texts. A text's letters, lower-cased, are cut in chunks, each
chunk compressed with each dictionary, and the language with the least total size wins. The margin to the second is the
score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_DOCUMENTS = 300
SAMPLE_CHARS = 1_000
DICTIONARY_BYTES = 96 << 10
MAX_LANGUAGES = 500
CHUNK_BYTES = 4 << 10
LEVEL = 6
MIN_MARGIN = 0.002
UNDETERMINED = "und"

Model = dict[str, bytes]

_NO_LETTERS = re.compile(r"[\W\d_]+")


def _letters(text: str) -> str:
    return _NO_LETTERS.sub(" ", text.lower())


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from; false for a null id, which is not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(
    docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, sample_chars: int = SAMPLE_CHARS
) -> Model:
    """A dictionary for each language of ``docs(doc_id, text, lang)`` outside the held-out fold.

    At most ``sample_documents`` texts a language, picked by a hash of the id, at most ``sample_chars`` characters of
    each, at most ``DICTIONARY_BYTES`` in all: that much comes to the driver, however large the table. Null texts and
    null languages teach nothing; an empty table gives an empty model. Over ``MAX_LANGUAGES`` labels is an error.
    """
    taught = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    taught = taught.where(F.col("text").rlike(r"\p{L}"))
    taught = taught.select("lang", F.xxhash64("doc_id").alias("h"), F.substring("text", 1, sample_chars).alias("text"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    rows = taught.withColumn("rank", first).where(F.col("rank") <= sample_documents)
    names = [r[0] for r in taught.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the model would not be small")
    samples: dict[str, dict[str, None]] = {name: {} for name in sorted(names)}
    for r in sorted(rows.collect(), key=lambda r: (r.lang, r.rank)):
        samples[r.lang][r.text] = None
    # the end of a dictionary is the cheapest to refer to, its start is what a cut loses
    return {k: "\n".join(map(_letters, v)).encode("utf-8", "replace")[-DICTIONARY_BYTES:] for k, v in samples.items()}


class Sizes:
    """Compressed sizes of a text under each language."""

    def __init__(self, model: Model):
        self.names = list(model)
        self.compressors = []
        for content in model.values():
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False
                )
            )

    def best(self, text: str | None) -> tuple[str, float]:
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        raw = _letters(text).encode("utf-8", "replace")
        chunks = [raw[i : i + CHUNK_BYTES] for i in range(0, len(raw), CHUNK_BYTES)]
        totals = [sum(len(c.compress(chunk)) for chunk in chunks) for c in self.compressors]
        order = sorted(range(len(totals)), key=totals.__getitem__)
        if len(order) == 1:
            return self.names[0], 1.0
        least, second = totals[order[0]], totals[order[1]]
        return self.names[order[0]], 1.0 - least / second


def identify(text: Column, model: Model) -> Column:
    """``struct(lang, score)`` of a text: the language and its relative margin in bytes over the second, 0 to 1.

    Null, empty and letterless texts are ``und`` with score 0, and so is every text under an empty model; ties go to the
    first language by code point with score 0; a single learned language scores 1. Whole texts of any length are read.
    """

    @F.pandas_udf("lang string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sizes = Sizes(model)
        for texts in batches:
            yield pd.DataFrame([sizes.best(t) for t in texts], columns=["lang", "score"])

    return predicted(text)


def in_known_language(docs: DataFrame, model: Model, min_margin: float = MIN_MARGIN) -> DataFrame:
    """Rows of ``docs`` whose language is told apart by at least ``min_margin``; columns and repeated rows stay."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    marked = inner.withColumn("found", identify(F.col(f"c{names.index('text')}"), model))
    sure = (F.col("found.lang") != UNDETERMINED) & (F.col("found.score") >= min_margin)
    return marked.where(sure).drop("found").toDF(*names)
